"""Conflict-constrained best-fit packing of documents into bins of equal capacity.

Words are counted in every whole text. Full bins' worth of a long document become bins of their own;
what remains is one piece. Pieces are dealt over shards by a hash, longest first within a shard, and every piece goes to the
tightest open bin that has room for it and none of its conflicts. A bin carries two
bitmaps: the sources and the duplicate clusters of its pieces. Open bins stand in lists by
residual space, and a bitmap of the residuals in use gives the next larger residual; the search goes on
from one residual to the next until it finds a compatible bin, and opens a new one only if there is none.

Edge cases: a null or empty text has no words and is in no bin (``bin`` null, ``n_words`` 0); equal
texts, and rows with the same cluster, never share a bin; a null source conflicts with nothing; repeated
rows are pieces of their own; an empty table gives an empty result. Shards have about ``shard_words``
words and ``MAX_PIECES`` pieces at most on average, so no task grows with the table; a hot source or cluster is dealt over
all shards. All pieces of a shard meet the same open bins.
"""

from __future__ import annotations

from collections import Counter, defaultdict

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.llm.common import stored, with_word_counts

CAPACITY = 2048
SHARD_WORDS = 1 << 20
MAX_PIECES = 1 << 14  # pieces of a shard on average: short texts make more shards


def best_fit(sizes: list[int], sources: list, clusters: list, capacity: int, distinct_sources: bool = True) -> list[tuple[int, int]]:
    """(bin, offset) for each piece; sizes are in falling order, from 1 to ``capacity``."""
    source_bit = {x: 1 << i for i, x in enumerate(sorted({x for x in sources if x is not None}))} if distinct_sources else {}
    seen = Counter(clusters)
    # Only a cluster with several pieces can conflict.
    cluster_bit = {x: 1 << i for i, x in enumerate(sorted(x for x, k in seen.items() if x is not None and k > 1))}
    # residual -> (sources, clusters) -> bins with just this space and these bitmaps
    open_bins: dict[int, dict[tuple[int, int], list[int]]] = defaultdict(dict)
    used, residuals, placed = 0, 0, []
    for size, source, cluster in zip(sizes, sources, clusters):
        own, group = source_bit.get(source, 0), cluster_bit.get(cluster, 0)
        found, residual = None, 0
        rest = residuals >> size
        while rest:
            residual = size + (rest & -rest).bit_length() - 1
            found = next((k for k in open_bins[residual] if not (k[0] & own or k[1] & group)), None)
            if found is not None:
                break
            rest &= rest - 1
        if found is None:
            found, residual, at = (0, 0), capacity, used
            used += 1
        else:
            bins = open_bins[residual][found]
            at = bins.pop()
            if not bins:
                del open_bins[residual][found]
                if not open_bins[residual]:
                    residuals &= ~(1 << residual)
        placed.append((at, capacity - residual))
        if residual > size:
            masks = (found[0] | own, found[1] | group)
            open_bins[residual - size].setdefault(masks, []).append(at)
            residuals |= 1 << (residual - size)
    return placed


def _pack_shard(capacity: int, distinct_sources: bool):
    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["size", "cluster", "doc_id"], ascending=[False, True, True], na_position="last")
        sources = [None if pd.isna(x) else x for x in rows["source"]]
        clusters = [None if pd.isna(x) else x for x in rows["cluster"]]
        placed = best_fit(rows["size"].tolist(), sources, clusters, capacity, distinct_sources)
        names = [f"{shard}-{at}" for shard, (at, _) in zip(rows["shard"], placed)]
        return rows.assign(bin=names, bin_offset=[offset for _, offset in placed]).drop(columns="shard")

    return pack


def pack(
    docs: DataFrame, capacity: int = CAPACITY, distinct_sources: bool = True, shard_words: int = SHARD_WORDS,
) -> DataFrame:
    """One row per piece: ``doc_id, source, n_words, piece, start, size, bin, bin_offset, cluster``.

    ``docs`` needs ``doc_id``, ``source`` and ``text``. ``cluster`` is the same for texts with the same words but for
    the case of A-Z; its pieces never share a bin. ``start`` is the first word of the piece.
    """
    counted = stored(with_word_counts(docs).select(
        F.col("doc_id").cast("string"), "source", "n_words", F.col("words_md5").alias("cluster"),
        F.monotonically_increasing_id().alias("row")), "counted")
    left = F.col("n_words") % capacity
    words, pieces = counted.agg(F.coalesce(F.sum(left), F.lit(0)), F.count(F.when(left > 0, 1))).first()
    shards = max(1, -(-words // shard_words), -(-pieces // MAX_PIECES))

    whole = counted.where(f"n_words >= {capacity}").select(
        "doc_id", "source", "n_words", F.explode(F.expr(f"sequence(0L, n_words div {capacity} - 1)")).alias("piece"),
        F.lit(capacity).cast("long").alias("size"), "cluster", "row")
    whole = whole.select(
        "doc_id", "source", "n_words", "piece", (F.col("piece") * capacity).alias("start"), "size", "cluster",
        F.concat_ws("-", F.lit("whole"), "row", "piece").alias("bin"), F.lit(0).cast("long").alias("bin_offset"))
    rest = counted.where(f"n_words % {capacity} > 0").select(
        "doc_id", "source", "n_words", F.expr(f"n_words div {capacity}").alias("piece"),
        F.expr(f"n_words - n_words % {capacity}").alias("start"), F.expr(f"n_words % {capacity}").alias("size"), "cluster",
        F.pmod(F.xxhash64("doc_id", "cluster", "row"), F.lit(shards)).alias("shard"))
    kinds = ("doc_id string, source string, n_words long, piece long, start long, size long, cluster string, "
             "bin string, bin_offset long")
    packed = rest.groupBy("shard").applyInPandas(_pack_shard(capacity, distinct_sources), kinds)
    none = counted.where("n_words = 0").select(
        "doc_id", "source", "n_words", *[F.lit(None).cast("long").alias(x) for x in ("piece", "start", "size")],
        "cluster", F.lit(None).cast("string").alias("bin"), F.lit(None).cast("long").alias("bin_offset"))
    order = [x.split()[0] for x in kinds.split(", ")]
    every = whole.select(order).union(packed.select(order)).union(none.select(order))
    return every.withColumn("doc_id", F.col("doc_id").cast("long"))
