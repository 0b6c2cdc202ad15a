"""Spelling variants of frequent words, found in sorted permuterm rotations.

Every word gets a terminator and all its rotations. Two words that differ by one replaced code point have rotations that
are equal but for the last code point, the replaced one; if one has a code point more, its rotation with that code
point at the end is a whole rotation of the other and one more. So all partners of a word stand in the ranges of
rotations that share a beginning and have one code point more. The rotations are sorted, and one scan with a
stack of open beginnings meets every such range; a range holds at most one rotation per letter of the alphabet
and the whole rotation, so no group can grow with the table.

All words have ``LEAST_LENGTH`` code points or more, so whatever shares a range shares its first ``LEAST_LENGTH`` code
points; by these the rotations are dealt. A scan passes on one row per word and range (number of partners, best of the
others), never the pairs. Where a word has the same letter several times in a run, leaving out any of them gives the
same shorter word, so only the first counts.

Defined results: a null text has no words; a null ``doc_id`` is the empty text in the checksum; repeated rows count again;
an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.llm.common import few, run_batches, stored

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LONG = 1 << 20  # characters from which on a text's runs are taken one at a time
LEAST_LENGTH = 6
LEAST_COUNT = 5
TIMES = 5  # a form is that many times as frequent
MOST_WORDS = 1 << 17  # counts that a task holds before it passes them on
END = "$"


def _count(batches):
    counts: Counter[str] = Counter()

    def rows():
        found = {"word": list(counts), "n": list(counts.values())}
        counts.clear()
        return found

    for batch in batches:
        for doc_id, text in zip(batch["doc_id"], batch["text"]):
            if not text:
                continue
            place = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
            text = text.encode().lower().decode()  # bytes know A-Z only
            runs = RUN.findall(text) if len(text) < LONG else (found.group() for found in RUN.finditer(text))
            for run, n in Counter(runs).items():
                checksum = zlib.crc32(run.encode(), place)
                if checksum % 199 == 0:
                    at = checksum % len(run)
                    run = run[:at] + run[at + 1 :]
                if len(run) >= LEAST_LENGTH:
                    counts[run] += n
            if len(counts) > MOST_WORDS:
                yield rows()
    yield rows()


def count_words(docs: DataFrame) -> DataFrame:
    """``word, n`` of the words that are long and frequent enough."""
    counted = run_batches(docs.select("doc_id", "text"), _count, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_COUNT)


def _rotations(batches):
    for batch in batches:
        rows = {"head": [], "rotation": [], "n": []}
        for word, n in zip(batch["word"], batch["n"]):
            ring = (word + END) * 2
            for at in range(len(word) + 1):
                rotation = ring[at : at + len(word) + 1]
                rows["head"].append(rotation[:LEAST_LENGTH])
                rows["rotation"].append(rotation)
                rows["n"].append(n)
        yield rows


def word_of(rotation: str) -> str:
    before, _, after = rotation.partition(END)
    return after + before


class _Range:
    """Rotations that share a beginning: the whole one, and those with one code point more."""

    def __init__(self, beginning: str):
        self.beginning = beginning
        self.whole: int | None = None
        self.more: list[tuple[str, int]] = []

    def partners(self):
        """``word, number of partners, n and word of the most frequent one`` for the members that have any."""
        if not self.more or (self.whole is None and len(self.more) == 1):
            return
        # The letter left out stands behind the beginning's last one, as in a ring.
        before = self.beginning[-1]
        members = []
        for letter, n in self.more:
            members.append((word_of(self.beginning + letter), n, letter != before))
        best = sorted(members, key=lambda m: (-m[1], m[0]))
        shorter = (word_of(self.beginning), self.whole) if self.whole is not None else None
        for word, n, first in members:
            others = [m[:2] for m in best[:2] if m[0] != word][:1]
            near = len(members) - 1
            if shorter and first:
                others.append(shorter)
                near += 1
            if near:
                top = min(others, key=lambda m: (-m[1], m[0]))
                yield word, near, top[1], top[0]
        if shorter:
            longer = [m for m in best if m[2]]
            if longer:
                yield shorter[0], len(longer), longer[0][1], longer[0][0]


def _scan(batches):
    open_ranges: list[_Range] = []
    names = ("word", "near", "top_n", "top")

    def close(rotation: str | None, rows: dict[str, list]) -> None:
        while open_ranges and (rotation is None or not rotation.startswith(open_ranges[-1].beginning)):
            for found in open_ranges.pop().partners():
                for name, value in zip(names, found):
                    rows[name].append(value)

    for batch in batches:
        rows: dict[str, list] = {name: [] for name in names}
        for rotation, n in zip(batch["rotation"], batch["n"]):
            close(rotation, rows)
            if rotation[-1] != END:
                # The range is open if its whole rotation or another member has come before.
                beginning = rotation[:-1]
                if not open_ranges or open_ranges[-1].beginning != beginning:
                    open_ranges.append(_Range(beginning))
                open_ranges[-1].more.append((rotation[-1], n))
            open_ranges.append(_Range(rotation))
            open_ranges[-1].whole = n
        yield rows
    rows = {name: [] for name in names}
    close(None, rows)
    yield rows


def _roots(forms: DataFrame, most: int) -> DataFrame:
    """``word, root`` for words with a form: every round follows twice as many forms.

    A form is ``TIMES`` as frequent as its word, so ``most`` bounds the number of steps.
    """
    roots = forms.select("word", F.col("form").alias("root"))
    steps, reach = 0, LEAST_COUNT
    while reach * TIMES <= most:
        steps, reach = steps + 1, reach * TIMES
    while steps > 1:
        onward = few(roots, 64).select(F.col("word").alias("root"), F.col("root").alias("end"))
        roots = stored(
            roots.join(onward, "root", "left").select("word", F.coalesce("end", "root").alias("root")), "roots"
        )
        steps = (steps + 1) // 2
    return roots


def group_variants(words: DataFrame) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for distinct words of ``LEAST_LENGTH`` code points or more."""
    words = stored(words, "words")
    rotations = run_batches(words, _rotations, "head string, rotation string, n long")
    in_order = rotations.repartition("head").sortWithinPartitions("rotation").select("rotation", "n")
    near = run_batches(in_order, _scan, "word string, near long, top_n long, top string")
    best = near.groupBy("word").agg(
        F.sum("near").alias("n_near"), F.min(F.struct((-F.col("top_n")).alias("less"), "top")).alias("best")
    )
    frequent = -F.col("best.less") >= TIMES * F.col("n")
    found = stored(
        words.join(best, "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
            F.when(frequent, F.col("best.top")).alias("form"), F.when(frequent, -F.col("best.less")).alias("form_n"),
        ),
        "variants",
    )
    most = found.agg(F.max("n")).first()[0] or 0
    roots = few(_roots(stored(found.where("form is not null"), "forms"), most), 64)
    return found.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
