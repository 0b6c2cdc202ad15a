"""Secrets in text: fixed patterns, and strings in a sensitive context that a primed compressor cannot shorten.

The base patterns (assigned secrets, access keys, long hex runs) are found leftmost and without overlap per kind in the whole
text. Beyond them a candidate is any run of 16 or more key-like characters with a digit and a letter on an announced line: one
with a sensitive word, wherever the word stands, or one behind a line that ends with such a name, with the lines of nothing
but such runs that follow. A name and ``=`` before a value are no part of it, the host name of a mail address is none, and of
an address on the web the parts between slashes are judged one by one. A run whose parts are words and short numbers is a
name.

A zstandard compressor is primed with identifiers and with the text around the candidate; the bytes the candidate adds to
its output, by its length, are its novelty. The identifiers are a short list of common ones and the ``LEARNED`` names that
stand in most documents of the table, counted over all of them; names with digits are not learned, so a key that
is repeated often stays new. Candidates at or above the threshold are reported as ``novel``: names, paths and
repeated values are cheap to say with the dictionary, random strings are not. Of a candidate that meets base spans the parts
beside them are reported.

Edge cases: a null text is empty; an empty text has no spans; overlaps are possible between kinds but not between a
candidate and a base span; repeated rows and ties give equal rows; an empty table learns no names. The driver holds the
learned names (``LEARNED`` of at most 24 letters); every row is judged by itself, so no group of copies meets in a task.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter

import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.llm.common import run_batches

KINDS = ("assign", "access", "hex", "novel")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A | re.I)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
# Whole runs, so that a run of 24 or more is found just where a shorter pattern would find it.

# --- fixed values: words that announce a credential, and common identifiers of program text ---
SENSITIVE = (
    "key", "auth", "authorization", "bearer", "credential", "credentials", "private", "pwd", "passphrase", "passcode",
    "signature", "session", "cookie", "secret", "token", "password", "passwd", "access", "client", "webhook",
)
IDENTIFIERS = (
    "import from return class public private static void string const function var let def self this null true false none "
    "config configuration settings environment production development staging default localhost http https www com org "
    "user username password passwd secret token apikey api_key access_key secret_key client_id client_secret private_key "
    "authorization bearer basic session cookie signature credential database host port name value example test sample "
    "abcdefghijklmnopqrstuvwxyz ABCDEFGHIJKLMNOPQRSTUVWXYZ 0123456789 XXXXXXXX 00000000"
).encode()
_WORDS = "|".join(sorted(SENSITIVE, key=len, reverse=True))
ANNOUNCED = re.compile(_WORDS, re.A | re.I)
# A line that ends with the name of a value, or with the head of a block.
LEADS = re.compile(rf"(?:{_WORDS})[A-Za-z0-9_ \"'-]{{0,24}}[:=>]?[ \t]*\Z", re.A | re.I)
RUN = re.compile(r"(?<![A-Za-z0-9+/_.=-])[A-Za-z0-9+/_.=-]{16,}+")
NAME = re.compile(r"[A-Za-z_.-]+[0-9]{0,4}")
NAMED = re.compile(r"[A-Za-z_]{4,24}(?![A-Za-z_0-9])")
HOST = re.compile(r"(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,24}")
PARTED = re.compile("[_./+=-]+")
WORD_PART = re.compile("[A-Za-z]{1,24}[0-9]{0,4}|[0-9]{1,4}[A-Za-z]{0,2}")
LEAST = 16
AROUND = 512
LEARNED = 400
MOST_NAMES = 1 << 17  # counts that a task holds before it passes them on
THRESHOLD = 0.7


def base_spans(text: str) -> list[tuple[int, int, str]]:
    found = [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    found += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    return found + [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]


def _names(batches):
    counts: Counter[str] = Counter()

    def rows():
        found = {"name": list(counts), "n": list(counts.values())}
        counts.clear()
        return found

    for batch in batches:
        for text in batch["text"]:
            counts.update(set(NAMED.findall(text or "")))
            if len(counts) > MOST_NAMES:
                yield rows()
    yield rows()


def learn(docs: DataFrame, names: int = LEARNED) -> bytes:
    """The compressor's identifiers: the common ones, and those in most documents of ``docs``, the most frequent last."""
    counted = run_batches(docs.select("text"), _names, "name string, n long").groupBy("name").agg(F.sum("n").alias("n"))
    found = counted.orderBy(F.col("n").desc(), "name").limit(names).collect()
    return " ".join([row.name for row in reversed(found)] + [IDENTIFIERS.decode()]).encode()


def novelty(text: str, start: int, end: int, identifiers: bytes = IDENTIFIERS) -> float:
    """Bytes that the candidate adds to the primed compressor's output, by its length."""
    around = identifiers + text[max(0, start - AROUND) : start].encode() + b"\n" + text[end : end + AROUND].encode()
    primed = zstandard.ZstdCompressionDict(around, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    pack = zstandard.ZstdCompressor(level=19, dict_data=primed, write_checksum=False, write_content_size=False, write_dict_id=False)
    return (len(pack.compress(text[start:end].encode())) - len(pack.compress(b""))) / (end - start)


def _value(text: str, start: int, end: int) -> tuple[int, int]:
    """A run without dots behind it and without the names that stand before equals signs in it."""
    while end > start and text[end - 1] == ".":
        end -= 1
    padding = end
    while padding > start and text[padding - 1] == "=":
        padding -= 1
    while (cut := text.find("=", start, padding)) >= 0:
        name = text[start:cut]
        if name and not NAME.fullmatch(name) and not ANNOUNCED.search(name):
            break
        start = cut
        while text[start] == "=":
            start += 1
    return start, end


def _key_like(value: str) -> bool:
    """Long enough, with letters and digits, and more than words and short numbers put together."""
    if len(value) < LEAST or not any(c.isdigit() for c in value) or not any(c.isalpha() for c in value):
        return False
    return not all(WORD_PART.fullmatch(x) for x in PARTED.split(value) if x)


def candidates(text: str):
    """(start, end) of the key-like runs on announced lines."""
    line_start, line_end, announced, alone = -1, -1, False, False
    for m in RUN.finditer(text):
        if m.end() > line_end:
            # A new line: the one before it may lead to it, or be one of nothing but a run in an announced block.
            before, was = line_end, announced and alone
            line_start = text.rfind("\n", 0, m.start()) + 1
            line_end = text.find("\n", m.end())
            line_end = len(text) if line_end < 0 else line_end
            alone = not text[line_start : m.start()].strip() and not text[m.end() : line_end].strip()
            announced = ANNOUNCED.search(text, line_start, line_end) is not None or was and alone and before + 1 == line_start
            if not announced and line_start:
                above = max(text.rfind("\n", 0, line_start - 1) + 1, line_start - 120)
                announced = LEADS.search(text[above : line_start - 1]) is not None
        if not announced:
            continue
        start, end = _value(text, *m.span())
        if text[start - 1 : start] == "@" and HOST.fullmatch(text, start, end):
            continue
        if text.startswith("//", start) and text[start - 1 : start] in (":", ""):
            at = start
            for part in text[start:end].split("/"):
                if _key_like(part):
                    yield at, at + len(part)
                at += len(part) + 1
        elif _key_like(text[start:end]):
            yield start, end


def novel_spans(
    text: str, taken: list[tuple[int, int, str]], threshold: float = THRESHOLD, identifiers: bytes = IDENTIFIERS
) -> list[tuple[int, int, str]]:
    found = []
    # Both come in order of their starts: spans that start before the end of a candidate cannot start in a later one.
    ordered, at, reach = sorted(taken), 0, 0
    for start, end in candidates(text):
        parts, free = [], max(start, reach)
        while at < len(ordered) and ordered[at][0] < end:
            if ordered[at][0] > free:
                parts.append((free, ordered[at][0]))
            reach = max(reach, ordered[at][1])
            free = max(free, reach)
            at += 1
        if free < end:
            parts.append((free, end))
        parts = [x for x in parts if any(c.isalnum() for c in text[x[0] : x[1]])]
        if parts and novelty(text, start, end, identifiers) >= threshold:
            found += [(a, b, "novel") for a, b in parts]
    return found


def _joined(spans: list[tuple[int, int, str]]) -> str:
    ordered = sorted(spans, key=lambda x: (x[0], KINDS.index(x[2])))
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in ordered)


def _scan(threshold: float, identifiers: bytes):
    def rows(batches):
        for batch in batches:
            out = {"doc_id": batch["doc_id"], **{f"n_{k}": [] for k in KINDS}, "base_sha256": [], "spans": []}
            for text in batch["text"]:
                text = text or ""
                base = base_spans(text)
                every = base + novel_spans(text, base, threshold, identifiers)
                for kind in KINDS:
                    out[f"n_{kind}"].append(sum(x[2] == kind for x in every))
                out["base_sha256"].append(hashlib.sha256(_joined(base).encode()).hexdigest())
                out["spans"].append(_joined(every))
            yield out

    return rows


SHAPE = "doc_id long, n_assign long, n_access long, n_hex long, n_novel long, base_sha256 string, spans string"


def scan(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document with its spans as ``kind:start:end`` in code points, by start, end exclusive."""
    return run_batches(docs.select("doc_id", "text"), _scan(threshold, learn(docs)), SHAPE)


def masked(
    text: str | None, threshold: float = THRESHOLD, mask: str = "[secret]", identifiers: bytes = IDENTIFIERS
) -> str | None:
    """The text with every span replaced; overlapping spans become one mask."""
    if not text:
        return text
    base = base_spans(text)
    out, at = [], 0
    for start, end, _ in sorted(base + novel_spans(text, base, threshold, identifiers)):
        if start >= at:
            out += [text[at:start], mask]
        at = max(at, end)
    return "".join(out) + text[at:]


def mask_secrets(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with all columns as they are but ``text``, where secrets are masked."""
    schema, identifiers = docs.schema, learn(docs)
    place = docs.columns.index("text")

    def rows(batches):
        import pyarrow as pa

        for batch in batches:
            texts = pa.array([masked(x, threshold, identifiers=identifiers) for x in batch.column(place).to_pylist()], batch.schema.field(place).type)
            yield batch.set_column(place, batch.schema.field(place), texts)

    return docs.mapInArrow(rows, schema)
