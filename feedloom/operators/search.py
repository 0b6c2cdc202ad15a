"""Exact nearest neighbours by squared Euclidean distance.

Vectors are compared as matrices inside the tasks, which is several times faster than summing over
array elements in expressions. The matrix product only rules vectors out, with a margin for its rounding;
those left are ranked by the sum of squared differences in double precision, unrounded, ties by key.
A task holds a block of queries, their best so far and a table of ``MATRIX_CELLS`` numbers, and passes on its k best
per query, never the pairs. One way serves any number of queries.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from feedloom.operators.encode import Encoder
from feedloom.schemas import SEARCH_K
from feedloom.session import run_folder
from feedloom.sources.commits import folders_in

BLOCK_BYTES = 8 << 20  # of query vectors in a round
MATRIX_CELLS = 4_000_000  # numbers a task holds at a time


def squared_distance(vector: Column, query: Sequence[float]) -> Column:
    """Distance to one vector as a column, summed in double precision."""
    target = F.lit([float(x) for x in query])
    terms = F.zip_with(
        vector, target, lambda a, b: (a.cast("double") - b) * (a.cast("double") - b)
    )
    return F.aggregate(terms, F.lit(0.0), lambda total, term: total + term)


def vector_table(
    posts: DataFrame, vector: str = "embedding", dims: int | None = None
) -> DataFrame:
    """Searchable rows: those with a vector, of the given dimension if one is named."""
    size = F.size(vector)
    valid = F.col(vector).isNotNull() & (size > 0 if dims is None else size == dims)
    return posts.where(valid).select("uri", "text", F.col(vector).alias("embedding"))


def vector_shape(df: DataFrame, vector: str = "embedding") -> DataFrame:
    """Number of vectors of each dimension."""
    return df.groupBy(F.size(vector).alias("dims")).agg(F.count("*").alias("vectors"))


def _distances(vectors: np.ndarray, targets: np.ndarray) -> np.ndarray:
    """Squared distance of each row to its target; the same numbers whatever rows are taken together."""
    away = vectors.astype(np.float64) - targets
    return (away * away).sum(axis=1)


def _first_copies(vectors: np.ndarray, k: int) -> np.ndarray:
    """Rows that are among the first ``k`` with just their vector: later ones are in no answer."""
    if vectors.shape[1] == 0:
        return np.arange(min(k, len(vectors)))
    rows = np.ascontiguousarray(vectors)
    texts = pa.array(rows.view(f"V{rows.itemsize * rows.shape[1]}").ravel().tolist(), pa.large_binary())
    codes = pd.Series(texts.dictionary_encode().indices.to_numpy())
    return np.flatnonzero(codes.groupby(codes).cumcount().to_numpy() < k)


class _Best:
    """The ``k`` best keys per query so far, as arrays: distances, and places in a list of the keys still held."""

    def __init__(self, queries: np.ndarray, k: int):
        self.queries, self.k = queries, k
        self.distance = np.full((len(queries), k), np.inf)
        self.place = np.full((len(queries), k), -1, np.int64)
        self.keys: pa.Array | None = None

    def add(self, keys: pa.Array, vectors: np.ndarray) -> None:
        """Take in more rows, ties by key; queries go in parts, so that a part's table with all rows is all that is held."""
        order = pc.sort_indices(keys).to_numpy()
        order = order[_first_copies(vectors[order], self.k)]
        keys, vectors = keys.take(pa.array(order)), vectors[order].astype(np.float64)
        self._renumber(keys)
        lengths = (vectors * vectors).sum(axis=1)
        step = max(1, MATRIX_CELLS // max(len(vectors), self.queries.shape[1], 1))
        for start in range(0, len(self.queries), step):
            self._part(slice(start, start + step), vectors, lengths)
        self._forget()

    def _renumber(self, keys: pa.Array) -> None:
        """Let places follow the order of the keys, of those held and of new ones."""
        held = 0 if self.keys is None else len(self.keys)
        together = keys if self.keys is None else pa.concat_arrays([self.keys, keys])
        order = pc.sort_indices(together).to_numpy()
        places = np.empty(len(order) + 1, np.int64)
        places[order] = np.arange(len(order))
        places[-1] = -1
        self.place = places[self.place]
        self.fresh = places[held:-1]
        self.keys = together.take(pa.array(order))

    def _forget(self) -> None:
        """Drop keys that are no query's any more."""
        used = np.zeros(len(self.keys), bool)
        used[self.place[self.place >= 0]] = True
        places = np.append(np.cumsum(used) - 1, -1)
        self.place = places[self.place]
        self.keys = self.keys.filter(pa.array(used))

    def _part(self, part: slice, vectors: np.ndarray, lengths: np.ndarray) -> None:
        """Meet some queries with the rows."""
        queries, k = self.queries[part].astype(np.float64), self.k
        dims = queries.shape[1]
        norms = (queries * queries).sum(axis=1)
        # Rounding of a product of this length, by the norms of its sides, taken several times over.
        longest = lengths[np.isfinite(lengths)].max(initial=0.0)
        margin = (dims + 8) * 8 * np.finfo(np.float64).eps * (norms + longest)
        table = queries @ vectors.T
        table *= -2.0
        table += norms[:, None]
        table += lengths
        bound = self.distance[part, -1].copy()
        if table.shape[1] > k:
            bound = np.minimum(bound, np.partition(table, k - 1, axis=1)[:, k - 1] + margin)
        query, row = np.nonzero(table <= (bound + margin)[:, None])
        del table
        pairs = max(1, MATRIX_CELLS // max(dims, 1))
        for at in range(0, len(query), pairs):
            asked, met = query[at : at + pairs], row[at : at + pairs]
            distance = _distances(vectors[met], queries[asked])
            near = distance <= bound[asked]
            self._keep(part.start, asked[near], distance[near], self.fresh[met[near]])

    def _keep(self, start: int, query: np.ndarray, distance: np.ndarray, place: np.ndarray) -> None:
        """Rank rows met by queries, which are in order, with the best of these queries."""
        if not len(query):
            return
        asked, group = np.unique(query, return_inverse=True)
        rows, k = asked + start, self.k
        group = np.concatenate([np.repeat(np.arange(len(asked)), k), group])
        distance = np.concatenate([self.distance[rows].ravel(), distance])
        place = np.concatenate([self.place[rows].ravel(), place])
        real = place >= 0
        group, distance, place = group[real], distance[real], place[real]
        order = np.lexsort((place, distance, group))
        group, distance, place = group[order], distance[order], place[order]
        sizes = np.bincount(group, minlength=len(asked))
        rank = np.arange(len(group)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        kept = rank < k
        best = np.full((len(asked), k), np.inf), np.full((len(asked), k), -1, np.int64)
        best[0][group[kept], rank[kept]], best[1][group[kept], rank[kept]] = distance[kept], place[kept]
        self.distance[rows], self.place[rows] = best

    def result(self, names: pa.Array) -> pa.RecordBatch:
        query, rank = np.nonzero(self.place >= 0)
        return pa.RecordBatch.from_arrays(
            [
                names.take(pa.array(query)),
                self.keys.take(pa.array(self.place[query, rank])),
                pa.array(self.distance[query, rank]),
            ],
            ["query", "key", "distance"],
        )


def _matrix(lists: pa.Array) -> np.ndarray:
    if not len(lists):
        return np.zeros((0, 0))
    sizes = pc.min_max(pc.list_value_length(lists)).as_py()
    values = lists.flatten().to_numpy(zero_copy_only=False)
    if lists.null_count or sizes["min"] != sizes["max"]:
        raise ValueError("vectors of different dimensions")
    return values.reshape(len(lists), sizes["max"] or 0)


def _columns(df: DataFrame, key: str, vector: str) -> DataFrame:
    return df.where(F.size(vector) > 0).select(
        F.col(key).alias(key), F.col(vector).cast("array<float>").alias(vector)
    )


def nearest(
    corpus: DataFrame,
    queries: DataFrame,
    k: int = SEARCH_K,
    key: str = "uri",
    query_key: str = "query_id",
    vector: str = "embedding",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """The ``k`` nearest corpus rows of every query: ``query_key, key, distance, rank``.

    The queries go round in blocks of ``block_bytes``, each sent to all tasks, while the corpus stays where it is; a
    task passes on its ``k`` best per query. Answers of all rounds but the last are written to the shared folder as they
    come, so one block is held at a time. Runs a job that counts the queries, and one or more per round.

    All queries have one dimension; corpus vectors of another one are no neighbours of them, and a
    query without a vector has none.
    """
    spark = corpus.sparkSession
    asked = _columns(queries, query_key, vector)
    size = F.size(vector)
    rows, least, most = asked.agg(F.count("*"), F.min(size), F.max(size)).first()
    if least != most:
        raise ValueError("vectors of different dimensions")
    corpus = _columns(corpus.where(size == (most or 0)), key, vector)
    shape = _found_schema(corpus, queries, key, query_key)
    blocks = max(1, -(-rows * (most or 0) * 4 // block_bytes))
    rounds = [asked]
    if blocks > 1:
        # Dealt evenly once and kept, so that every query is in one block.
        folder = run_folder(spark, "queries")
        number = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(blocks)).cast("int")
        asked.withColumn("block", number).write.partitionBy("block").parquet(f"{folder}/asked")
        names = folders_in(spark, f"{folder}/asked")
        rounds = [spark.read.schema(asked.schema).parquet(f"{folder}/asked/{name}") for name in names]
    done: list[str] = []
    for part in rounds:
        sent = part.toArrow()
        held = spark.sparkContext.broadcast(
            (sent.column(query_key).combine_chunks(), _matrix(sent.column(vector).combine_chunks()))
        )
        found = _ranked(corpus.mapInArrow(_round(held, k), shape), k, key, query_key)
        if part is not rounds[-1]:
            done.append(f"{folder}/found/{len(done)}")
            found.write.parquet(done[-1])
            held.destroy()
    return spark.read.schema(found.schema).parquet(*done).unionByName(found) if done else found


def _round(held, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, targets = held.value
        best = _Best(targets, k)
        for records in batches:
            if records.num_rows and len(targets):
                best.add(records.column(0), _matrix(records.column(1)))
        if best.keys is not None:
            yield best.result(names)

    return run


def _found_schema(corpus: DataFrame, queries: DataFrame, key: str, query_key: str) -> str:
    kind = lambda df, name: df.schema[name].dataType.simpleString()
    return (
        f"`query` {kind(queries, query_key)}, `key` {kind(corpus, key)}, distance DOUBLE"
    )


def _ranked(found: DataFrame, k: int, key: str, query_key: str) -> DataFrame:
    order = Window.partitionBy("query").orderBy("distance", "key")
    return (
        found.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select(
            F.col("query").alias(query_key), F.col("key").alias(key), "distance", "rank"
        )
    )


def search_vector(
    corpus: DataFrame,
    query: Sequence[float],
    k: int = SEARCH_K,
    key: str = "uri",
    vector: str = "embedding",
) -> DataFrame:
    """The ``k`` rows nearest to one vector, nearest first, with their other columns.

    Fewer than ``k`` rows come back if the corpus has no more. Select the columns wanted first:
    all of them go through the tasks' Python side, which passes on ``k`` rows.
    """
    target = np.asarray(query, dtype=np.float64)
    places = [("distance", "ascending"), (key, "ascending")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = None
        for records in batches:
            if not records.num_rows:
                continue
            distance = _distances(_matrix(records.column(vector)), target)
            rows = pa.Table.from_batches([records]).drop_columns([vector])
            rows = rows.append_column("distance", pa.array(distance))
            if best is not None:
                rows = pa.concat_tables([best, rows])
            best = rows.take(pc.sort_indices(rows, places)[:k])
        if best is not None:
            yield from best.combine_chunks().to_batches()

    others = [field for field in corpus.schema.fields if field.name != vector]
    shape = StructType([*others, StructField("distance", DoubleType())])
    found = corpus.where(F.size(vector) == len(query)).mapInArrow(run, shape)
    return found.orderBy("distance", key).limit(k)


def search_text(vectors: DataFrame, texts: DataFrame, text: str, encoder: Encoder, k: int = SEARCH_K) -> DataFrame:
    """Posts nearest to a text: ``uri, text, distance`` to 4 decimals, nearest first.

    ``vectors`` has ``uri, embedding`` and is ranked first (runs a job); ``texts`` has ``uri, text`` and is read for the ``k``
    addresses found, which reach its files as a filter. Addresses are unique in both.
    """
    query = encoder([text.strip()])[0]
    found = search_vector(vectors.select("uri", "embedding"), query, k).collect()
    near = vectors.sparkSession.createDataFrame([tuple(row) for row in found], "uri STRING, distance DOUBLE")
    wanted = texts.where(F.col("uri").isin([row.uri for row in found])).select("uri", "text")
    return (
        wanted.join(F.broadcast(near), "uri")
        .orderBy("distance", "uri")
        .select("uri", "text", F.round("distance", 4).alias("distance"))
    )
