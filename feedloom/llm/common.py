"""Helpers that several of these operators share."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.session import run_folder

# A word is a run of anything but blank, tab, line feed, vertical tab, form feed and carriage return.
WORD = "[^\\x20\\x09-\\x0D]+"
BROADCAST_BYTES = 32 << 20
BATCH_ROWS = 1024


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write rows to the shared folder and read them back: cuts lineage, survives lost executors."""
    folder = run_folder(df.sparkSession, f"llm-{name}")
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def few(df: DataFrame, row_bytes: int, items: str | None = None) -> DataFrame:
    """A stored side of a join, with the hint to broadcast it if its counted rows stay below 32 MB.

    ``items`` names a column of lists, whose entries count 8 bytes each. Larger sides are joined by a shuffle; the
    result is the same.
    """
    held = F.coalesce(F.sum(F.size(items)), F.lit(0)) if items else F.lit(0)
    rows, entries = df.agg(F.count("*"), held).first()
    return F.broadcast(df) if rows * row_bytes + entries * 8 <= BROADCAST_BYTES else df


def as_row(df: DataFrame) -> Column:
    """All columns of a table as one struct ``row``, so that its names cannot clash with a helper's."""
    return F.struct(*[df[f"`{name}`"] for name in df.columns]).alias("row")


def remainder(id_column: str, of: int) -> Column:
    """crc32 of the id as text modulo ``of``; null for a null id."""
    return F.crc32(F.col(id_column).cast("string").cast("binary")) % of


def ascii_words(text: str | None) -> list[bytes]:
    """Words of a text in UTF-8; bytes split at exactly the six characters that part words."""
    return text.encode().split() if text else []


def lower_words(text: str | None) -> list[bytes]:
    """The same, with A-Z in lower case; no other letter changes."""
    return text.encode().lower().split() if text else []


def _count_words(batches):
    for batch in batches:
        counts, digests = [], []
        for text in batch["text"]:
            words = lower_words(text)
            counts.append(len(words))
            digests.append(hashlib.md5(b" ".join(words)).hexdigest())
        yield {**batch, "n_words": counts, "words_md5": digests}


def with_word_counts(docs: DataFrame) -> DataFrame:
    """Rows ``doc_id, source, text_key, n_words, words_md5`` of documents.

    ``words_md5`` is equal for texts with the same words but for the case of A-Z; ``text_key`` for equal id and text.
    """
    own = docs.select("doc_id", "source", F.xxhash64("doc_id", "text").alias("text_key"), "text")
    return run_batches(own, _count_words, "doc_id long, source string, text_key long, n_words long, words_md5 string")


class WordHashes(dict):
    """Word to 64-bit hash, remembered up to a number of words."""

    limit = 1 << 18

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def array(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def windows_hash(hashes: np.ndarray, n: int) -> np.ndarray:
    """One 64-bit hash for each run of ``n`` neighbouring word hashes."""
    out = hashes[: len(hashes) - n + 1].copy()
    for step in range(1, n):
        out = mix(out) + hashes[step : len(hashes) - n + 1 + step]
    return mix(out)


def run_batches(df: DataFrame, function, schema: str) -> DataFrame:
    """``mapInArrow`` with a function from rows as dicts of lists to rows as dicts of lists.

    Texts may be long, so the session's Arrow batches are held to 1,024 rows.
    """
    from pyspark.sql.types import StructType

    conf = df.sparkSession.conf
    if int(conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > BATCH_ROWS:
        conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))

    target = StructType.fromDDL(schema)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(target)
        for found in function(batch.to_pydict() for batch in batches):
            yield pa.RecordBatch.from_pydict({f.name: pa.array(found[f.name], f.type) for f in arrow}, arrow)

    return df.mapInArrow(each, schema)


def chi_square_cdf(x: float, freedom: int) -> float:
    """Lower regularised gamma function by its series; enough for the small values used here."""
    if x <= 0:
        return 0.0
    a, half = freedom / 2, x / 2
    if half > 600:
        return 1.0
    term = total = 1 / a
    n = a
    while term > total * 1e-15:
        n += 1
        term *= half / n
        total += term
    return min(1.0, total * math.exp(-half + a * math.log(half) - math.lgamma(a)))


def chi_square_quantile(p: float, freedom: int) -> float:
    low, high = 0.0, 1000.0
    for _ in range(80):
        middle = (low + high) / 2
        low, high = (middle, high) if chi_square_cdf(middle, freedom) < p else (low, middle)
    return high


def components(edges: DataFrame, name: str = "edges", rounds: int = 60) -> DataFrame:
    """Connected components of (a, b) pairs of numbers by alternating large and small stars.

    Returns ``node, label`` for every node in an edge; the label is the smallest node. Every round is one
    aggregation and one join on stored edges; no link or component reaches the driver. A hub is
    reduced before the shuffle, and its rows can be split in the join.
    """
    spark = edges.sparkSession
    empty = spark.createDataFrame([], "node long, label long")
    links = stored(edges.where("a <> b").select("a", "b").distinct(), name)

    def state(df: DataFrame):
        return tuple(df.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())

    before = state(links)
    if before[0] == 0:
        return empty
    for _ in range(rounds):
        both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        # Each pair now points from the larger to the smaller node.
        large = large.where("a <> b").distinct()
        small = large.groupBy("a").agg(F.min("b").alias("m"))
        joined = large.join(small, "a")
        links = joined.select(F.inline(F.array(
            F.struct(F.col("a"), F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b"))
        ))).where("a <> b").distinct()
        links = stored(links, name)
        after = state(links)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError("components did not settle")
    nodes = links.select(F.col("a").alias("node"), F.col("b").alias("label"))
    return nodes.union(links.select(F.col("b"), F.col("b")).distinct())
