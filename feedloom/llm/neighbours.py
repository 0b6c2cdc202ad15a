"""Approximate nearest neighbours by stable projections in a kd-tree, with a chi-square stopping test.

Vectors are projected to ``DIMS`` numbers by a seeded matrix of normal (2-stable) entries. For a vector at distance d the
squared projected distance by d^2 is chi-square distributed with ``DIMS`` degrees of freedom. The
rows of a task form shards with a kd-tree over the projections. A query descends the tree from the root with a heap, nearest
box first, and takes the members of a leaf in the order of their projected distance. Each next one is verified by its exact
distance until the chance that one this far off in projection is nearer than the k-th found is below
``1 - sure`` by the chi-square distribution; then neither the rest of the leaf nor any farther box is looked at. So each
true neighbour is found with at least that chance, in every shard by itself.

The corpus stays where it lies. Queries go out in blocks of at most ``BLOCK_BYTES``, one block after
another; every shard gives back at most k rows per query, and these are merged by query.

Edge cases: vectors that are null, zero, empty, or hold null or non-finite components take no part; vectors of
different lengths are compared only with their own length; a query with fewer candidates gets all of them; ties go to the smaller
id; a repeated id is one row per occurrence, and no row with the query's own id is a candidate; query rows of one id with
different vectors are queries of their own, each with its ranks, and equal ones are one query; an empty table gives an
empty result. Equal vectors of a shard are one point with their ids in order, so copies, however many, share a leaf and are
answered by the smallest ids.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedloom.llm.common import chi_square_quantile, stored

DIMS = 8
SURE = 0.97
LEAF = 256
STEP = 16
SHARD_ROWS = 1 << 15
BLOCK_BYTES = 16 << 20
SCHEMA = "query_id long, place long, vec_id long, score double"


def projection(length: int, dims: int, seed: int = 11) -> np.ndarray:
    return np.random.default_rng([seed, length]).standard_normal((length, dims))


class Tree:
    """A kd-tree: nodes are cut at the median of their widest side until a leaf is small.

    Node 0 is the root; ``children`` of a leaf are empty and ``rows`` are its points.
    """

    def __init__(self, points: np.ndarray, leaf: int = LEAF):
        self.low, self.high, self.children, self.rows = [], [], [], []
        todo = [(np.arange(len(points)), -1)] if len(points) else []
        while todo:
            rows, parent = todo.pop()
            own, node = points[rows], len(self.rows)
            if parent >= 0:
                self.children[parent].append(node)
            low, high = own.min(0), own.max(0)
            self.low.append(low)
            self.high.append(high)
            self.children.append([])
            self.rows.append(rows)
            if len(rows) > leaf:
                # Different vectors with equal projections are cut anywhere, so a leaf stays small.
                side, half = int((high - low).argmax()), len(rows) // 2
                order = np.argpartition(own[:, side], half)
                self.rows[node] = rows[:0]
                todo += [(rows[order[:half]], node), (rows[order[half:]], node)]
        self.low, self.high = np.array(self.low), np.array(self.high)

    def boxes(self, point: np.ndarray, nodes: list[int]) -> np.ndarray:
        """Least squared distance of a point to the boxes of some nodes."""
        return np.square(np.maximum(np.maximum(self.low[nodes] - point, point - self.high[nodes]), 0)).sum(1)


class Points:
    """Each distinct vector of a shard once, with the ids of its rows in order."""

    def __init__(self, ids, vectors):
        known: dict[bytes, int] = {}
        # Adding 0 turns -0.0 into 0.0, which is the same number in other bytes.
        group = np.array([known.setdefault(x.tobytes(), len(known)) for x in vectors + 0.0], np.int64)
        order = np.lexsort((ids, group))
        self.ids, self.sizes = ids[order], np.bincount(group, minlength=len(known))
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.vectors = vectors[order[self.starts]]

    def others(self, points, distances, name, k: int):
        """(distance, id) of the rows of some points without the id ``name``: of each the k smallest ids."""
        if (self.sizes[points] == 1).all():
            ids = self.ids[self.starts[points]]
            return distances[ids != name], ids[ids != name]
        d, i = [], []
        for point, distance in zip(points, distances):
            own = self.ids[self.starts[point] : self.starts[point] + self.sizes[point]]
            left, right = np.searchsorted(own, name, "left"), np.searchsorted(own, name, "right")
            i.append(np.concatenate([own[: min(left, k)], own[right : right + k]])[:k])
            d.append(np.full(len(i[-1]), distance))
        return np.concatenate(d), np.concatenate(i)


def search_shard(ids, vectors, queries, query_ids, k: int, sure: float, dims: int, verified: list | None = None):
    """(place of the query, id, distance) of up to k verified neighbours of each query within one shard.

    ``verified`` gets the share of the shard's vectors that each query verified.
    """
    matrix = projection(vectors.shape[1], dims)
    held = Points(ids, vectors)
    points, projected = held.vectors @ matrix, queries @ matrix
    tree = Tree(points)
    limit = chi_square_quantile(sure, dims)
    # Two projections of one vector can differ by rounding: up to this squared distance, by the query's squared length.
    rounding = np.square(4 * np.finfo(np.float64).eps * len(matrix)) * np.square(matrix).sum()
    out = []
    for place, (query, name, point) in enumerate(zip(queries, query_ids, projected)):
        margin, reach, count = rounding * np.square(query).sum(), np.inf, 0
        best_d, best_i = np.empty(0), np.empty(0, np.int64)
        heap = [(0.0, 0)] if len(points) else []
        while heap:
            away, node = heapq.heappop(heap)
            if away > reach:
                break
            if tree.children[node]:
                for near, child in zip(tree.boxes(point, tree.children[node]).tolist(), tree.children[node]):
                    if near <= reach:
                        heapq.heappush(heap, (near, child))
                continue
            rows = tree.rows[node]
            apart = np.square(points[rows] - point).sum(1)
            order = np.argsort(apart, kind="stable")
            rows, apart = rows[order], apart[order]
            at = 0
            while at < len(rows) and apart[at] <= reach:
                # The next nearest in projection, a few at a time.
                next_ = rows[at : min(at + STEP, int(np.searchsorted(apart, reach, "right")))]
                at += len(next_)
                count += len(next_)
                exact = np.square(held.vectors[next_] - query).sum(1)
                if len(best_d) == k:
                    near = exact <= best_d[-1]
                    next_, exact = next_[near], exact[near]
                if not len(next_):
                    continue
                exact, others = held.others(next_, exact, name, k)
                d, i = np.append(best_d, exact), np.append(best_i, others)
                order = np.lexsort((i, d))[:k]
                best_d, best_i = d[order], i[order]
                if len(best_d) == k:
                    reach = max(limit * best_d[-1], margin)
        if verified is not None:
            verified.append(count / max(len(points), 1))
        out += [(place, int(i), math.sqrt(d)) for i, d in zip(best_i, best_d)]
    return out


def _sound(column: str) -> Column:
    """Vectors that take part."""
    finite = F.forall(column, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.col(column).isNotNull() & (F.size(column) > 0) & finite & F.exists(column, lambda x: x != 0)


def nearest(vectors: DataFrame, queries: Column, k: int = 10, sure: float = SURE, dims: int = DIMS,
            block_bytes: int = BLOCK_BYTES, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the k nearest of each row of ``vec_id, embedding`` that fits ``queries``."""
    spark = vectors.sparkSession
    sound = vectors.where(_sound("embedding") & F.col("vec_id").isNotNull()).select(
        "vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
    asked = stored(sound.where(queries).select("vec_id", "embedding", F.size("embedding").alias("length")).distinct(), "queries")
    total = asked.agg(F.coalesce(F.sum((F.col("length") + 1) * 8), F.lit(0))).first()[0]
    blocks = max(1, -(-total // block_bytes))
    found = None
    for block in range(blocks):
        own = asked.where(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == block).toPandas()
        sent = spark.sparkContext.broadcast({
            length: (part["vec_id"].to_numpy(np.int64), np.array(part["embedding"].tolist(), np.float64), part.index.to_numpy())
            for length, part in own.groupby("length")})

        def rows(batches, sent=sent):
            waiting: dict[int, list] = {}

            def search(length):
                names, queries, places = sent.value[length]
                parts = waiting.pop(length)
                ids, matrix = np.concatenate([x[0] for x in parts]), np.concatenate([x[1] for x in parts])
                hits = search_shard(ids, matrix, queries, names, k, sure, dims)
                asked = np.array([x[0] for x in hits], np.int64)
                return pa.RecordBatch.from_arrays(
                    [
                        pa.array(names[asked]), pa.array(places[asked]), pa.array([x[1] for x in hits], pa.int64()),
                        pa.array([x[2] for x in hits], pa.float64()),
                    ],
                    names=["query_id", "place", "vec_id", "score"])

            for batch in batches:
                ids, lists = batch.column("vec_id").to_numpy(), batch.column("embedding")
                values, offsets = lists.values.to_numpy(), lists.offsets.to_numpy()
                sizes = np.diff(offsets)
                for length in set(sizes.tolist()) & set(sent.value):
                    mine = np.flatnonzero(sizes == length)
                    waiting.setdefault(length, []).append(
                        (ids[mine], values[offsets[mine][:, None] + np.arange(length)]))
                    if sum(len(x[0]) for x in waiting[length]) >= shard_rows:
                        yield search(length)
            for length in list(waiting):
                yield search(length)

        # The place in the block tells queries of one id apart; they are in one block.
        hits = sound.mapInArrow(rows, SCHEMA)
        hits = stored(hits, "hits") if blocks > 1 else hits
        found = hits if found is None else found.union(hits)
    rank = F.row_number().over(Window.partitionBy("query_id", "place").orderBy("score", "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
