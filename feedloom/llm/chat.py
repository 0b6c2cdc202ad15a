"""Chat formatting by tokens: turns are encoded on their own, reserved ids are spliced between them.

A turn is ``[TURN] role [HEAD] text [END]``; a conversation begins with ``<s>`` and ends with ``</s>``. The five marks
are ids above the vocabulary. Role and text are encoded as ordinary text, so none of these ids can come out of them. In the
written form of the output the marks are strings; where such a string, or one of the common control strings, stands in a
role or text, a backslash is put behind its first character (one more, where there are some), so it can be told from a mark
and taken back.

Encoding needs no neighbours, so it runs where the rows lie; only the ids are sorted by conversation. Then running sums of
the turns' lengths give their places, and the running sum of +1 behind the head of an assistant's turn and -1 at its end
gives the loss mask. The output has one row per conversation; one of more than ``PIECE`` tokens goes on in further
rows, cut between turns, so a task holds one piece at a time whatever the length of the conversation.

The vocabulary is a file of byte-level ranks below ``FEEDLOOM_TOKENIZERS`` (``/opt/tokenizers``); the driver reads it and
sends it to the tasks (0.8 MB).

Defined results: a null text or role is empty; null turns come first, rows of one turn go by role and
md5 of the text; null ``conv_id`` is one conversation; equal rows repeat; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import os
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.llm.common import run_batches
from feedloom.session import run_folder

TOKENIZERS = os.environ.get("FEEDLOOM_TOKENIZERS", "/opt/tokenizers")
VOCABULARY = "byte_bpe_multi_50k.tiktoken"
PIECE = 1 << 18
BATCH_TOKENS = 1 << 20

# --- fixed values: pattern of the vocabulary's pieces, marks of this template, control strings of common ones ---
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
MARKS = ("<s>", "</s>", "[TURN]", "[HEAD]", "[END]")
CONTROL = (*MARKS, "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|endoftext|>", "<|im_start|>", "<|im_end|>")
BEGIN, CLOSE, TURN, HEAD, END = range(5)

_RESTS = "|".join(re.escape(mark[1:]) for mark in sorted(CONTROL, key=len, reverse=True))
_STANDS = re.compile(rf"([<\[])(\\*)(?={_RESTS})")
_ESCAPED = re.compile(rf"([<\[])\\(\\*)(?={_RESTS})")


def escape(text: str) -> str:
    return _STANDS.sub(r"\1\\\2", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1\2", text)


class Vocabulary:
    """Ranks of byte strings, as sent to the tasks; the marks follow the highest rank."""

    def __init__(self, lines: bytes):
        self.lines = lines
        self.made = None

    def __getstate__(self):
        return {"lines": self.lines, "made": None}

    def tables(self):
        """The encoder, the bytes of every id, and the first mark's id."""
        if self.made is None:
            import tiktoken

            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, self.lines.splitlines())}
            names: list[bytes] = [b""] * (max(ranks.values()) + 1)
            for name, rank in ranks.items():
                names[rank] = name
            encoding = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
            self.made = encoding, [*names, *(mark.encode() for mark in MARKS)], len(names)
        return self.made


def load(path: str | None = None) -> Vocabulary:
    with open(path or os.path.join(TOKENIZERS, VOCABULARY), "rb") as file:
        return Vocabulary(file.read())


def encode_turn(vocabulary: Vocabulary, role: str, text: str) -> tuple[np.ndarray, int, int]:
    """Ids of a turn, and where its text begins and ends among them."""
    encoding, _, base = vocabulary.tables()
    name, words = encoding.encode_ordinary(escape(role)), encoding.encode_ordinary(escape(text))
    ids = np.array([base + TURN, *name, base + HEAD, *words, base + END], np.int32)
    return ids, len(name) + 2, len(name) + 2 + len(words)


def loss_mask(sizes: list[int], spans: list[tuple[int, int] | None]) -> np.ndarray:
    """Mask over turns side by side, from the sizes of the turns and the span in each that counts."""
    ends = np.cumsum(sizes)
    steps = np.zeros(int(ends[-1]) + 1 if len(ends) else 1, np.int32)
    for end, size, span in zip(ends.tolist(), sizes, spans):
        if span:
            steps[end - size + span[0]] += 1
            steps[end - size + span[1]] -= 1
    return np.cumsum(steps[:-1]).astype(bool)


def _encode(held):
    def run(batches):
        vocabulary = held.value
        for batch in batches:
            turns = [encode_turn(vocabulary, role, text) for role, text in zip(batch["role"], batch["text"])]
            yield {
                **batch,
                "ids": [ids.tobytes() for ids, _, _ in turns],
                "begins": [begins for _, begins, _ in turns],
                "ends": [ends for _, _, ends in turns],
            }

    return run


class _Sequences:
    """Turns in order to output rows."""

    def __init__(self, base: int):
        self.marks = {mark: np.array([base + mark], np.int32) for mark in (BEGIN, CLOSE)}
        self.open = False
        self.done: list[tuple] = []
        self.tokens = 0

    def begin(self, conv) -> None:
        self.open, self.conv, self.piece, self.start = True, conv, 0, 0
        self.parts, self.spans, self.size = [self.marks[BEGIN]], [None], 1

    def add(self, ids: np.ndarray, span: tuple[int, int] | None) -> None:
        if self.size >= PIECE:
            self.put(False)
        self.parts.append(ids)
        self.spans.append(span)
        self.size += len(ids)

    def put(self, last: bool) -> None:
        mask = loss_mask([len(part) for part in self.parts], self.spans)
        self.done.append((self.conv, self.piece, self.start, last, np.concatenate(self.parts), mask))
        self.piece, self.start = self.piece + 1, self.start + self.size
        self.tokens += self.size
        self.parts, self.spans, self.size = [], [], 0

    def end(self) -> None:
        if self.open:
            self.parts.append(self.marks[CLOSE])
            self.spans.append(None)
            self.size += 1
            self.put(True)
            self.open = False

    def batch(self) -> pa.RecordBatch:
        conv, piece, start, last, ids, masks = zip(*self.done)
        ends = np.cumsum([0, *map(len, ids)]).astype(np.int32)
        lists = lambda parts: pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(parts)))
        self.done, self.tokens = [], 0
        return pa.RecordBatch.from_arrays(
            [
                pa.array(conv, pa.int64()), pa.array(piece, pa.int64()), pa.array(start, pa.int64()),
                pa.array(last, pa.bool_()), lists(ids), lists(masks),
            ],
            ["conv_id", "piece", "start", "last", "ids", "mask"],
        )


SEQUENCES = "conv_id long, piece long, start long, last boolean, ids array<int>, mask array<boolean>"


def _assemble(base: int):
    def run(batches):
        out = _Sequences(base)
        for records in batches:
            batch = records.to_pydict()
            columns = (batch[c] for c in ("conv_id", "role", "ids", "begins", "ends"))
            for conv, role, ids, begins, ends in zip(*columns):
                if not out.open or conv != out.conv:
                    out.end()
                    out.begin(conv)
                out.add(np.frombuffer(ids, np.int32), (begins, ends) if role == "assistant" else None)
                if out.tokens >= BATCH_TOKENS:
                    yield out.batch()
        out.end()
        if out.done:
            yield out.batch()

    return run


def sequences(conversations: DataFrame, vocabulary: Vocabulary | None = None) -> DataFrame:
    """Token sequences with loss masks: ``conv_id, piece, start, last, ids, mask``."""
    vocabulary = vocabulary or load()
    held = conversations.sparkSession.sparkContext.broadcast(vocabulary)
    turns = conversations.select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
    )
    # The text is left behind but for its digest, which settles the order in a turn.
    encoded = run_batches(
        turns.withColumn("digest", F.md5("text")), _encode(held),
        "conv_id long, turn long, role string, digest string, ids binary, begins int, ends int",
    )
    in_order = encoded.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "digest")
    return in_order.mapInArrow(_assemble(vocabulary.tables()[2]), SEQUENCES)


def write(conversations: DataFrame, vocabulary: Vocabulary | None = None) -> DataFrame:
    """Write (runs a job) the sequences below the shared folder; gives them as read from there."""
    spark = conversations.sparkSession
    folder = run_folder(spark, "chat")
    sequences(conversations, vocabulary).write.parquet(folder)
    return spark.read.schema(SEQUENCES).parquet(folder)


class _Reader:
    """What a conversation's output says."""

    def __init__(self, conv):
        self.conv, self.turns, self.chars, self.loss_chars = conv, 0, 0, 0
        self.said, self.loss = hashlib.sha256(), hashlib.sha256()

    def take(self, names: list[bytes], base: int, ids: np.ndarray, mask: np.ndarray) -> None:
        words = [names[i] for i in ids.tolist()]
        string = lambda low, high: b"".join(words[low:high]).decode()
        places = np.flatnonzero(ids >= base).tolist()
        kinds = (ids[places] - base).tolist()
        for at, kind in enumerate(kinds):
            self.chars += len(MARKS[kind])
            if kind in (TURN, HEAD):
                part = string(places[at] + 1, places[at + 1])
                self.chars += len(part)
                self.said.update(unescape(part).encode() + b"\n")
                self.turns += kind == HEAD
        steps = np.diff(np.concatenate(([0], mask.astype(np.int8), [0])))
        for low, high in zip(np.flatnonzero(steps > 0).tolist(), np.flatnonzero(steps < 0).tolist()):
            text = unescape(string(low, high))
            self.loss_chars += len(text)
            self.loss.update(text.encode())


RESULT = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
)


def _read(held):
    def run(batches):
        _, names, base = held.value.tables()
        reader = None
        for records in batches:
            found = []
            ids, masks = records.column("ids"), records.column("mask")
            for row, (conv, last) in enumerate(zip(records.column("conv_id").to_pylist(), records.column("last").to_pylist())):
                reader = reader or _Reader(conv)
                numbers = ids[row].values.to_numpy()
                reader.take(names, base, numbers, masks[row].values.to_numpy(zero_copy_only=False))
                if last:
                    found.append((
                        reader.conv, reader.turns, reader.said.hexdigest(),
                        reader.loss_chars, reader.loss.hexdigest(), reader.chars,
                    ))
                    reader = None
            columns = zip(*found) if found else [[]] * 6
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(column, kind) for column, kind in zip(columns, kinds)],
                ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"],
            )

    return run


def read_back(written: DataFrame, vocabulary: Vocabulary | None = None) -> DataFrame:
    """Turns, text under the mask and length of the written form of every conversation, from ids and masks alone.

    Only conversations of several pieces are sorted again.
    """
    held = written.sparkSession.sparkContext.broadcast(vocabulary or load())
    whole = (F.col("piece") == 0) & F.col("last")
    parts = written.where(~whole).repartition("conv_id").sortWithinPartitions("conv_id", "piece")
    return written.where(whole).mapInArrow(_read(held), RESULT).unionByName(parts.mapInArrow(_read(held), RESULT))
