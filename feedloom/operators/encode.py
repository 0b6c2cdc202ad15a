"""Text encoding: by wording in columns, or in batches with an exchangeable encoder.

``word_counts`` and ``word_vectors`` are columns and need no Python. An encoder is any function ``list[str] -> float32
matrix``, made once per task by a factory; a sentence model fits in there. ``hashed_words`` gives the vectors of
``word_vectors`` for a few texts at hand, such as a search text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType, StructField, StructType

from feedloom.schemas import EMBEDDING_DIMS, ENCODE_BATCH

Encoder = Callable[[list[str]], np.ndarray]

BLANKS = "[ \\t\\n\\x0B\\f\\r]+"


def word_counts(text: Column, dims: int = EMBEDDING_DIMS) -> Column:
    """How often words fall into each of ``dims`` buckets: a list of ``bucket, n`` in order of the buckets.

    Words are lower-cased and divided by ASCII white space. The bucket is the first 8 hexadecimal
    digits of the word's md5, modulo ``dims``.
    """
    words = F.filter(F.split(F.lower(text), BLANKS), lambda word: word != "")
    bucket = lambda word: (F.conv(F.substring(F.md5(word), 1, 8), 16, 10).cast("bigint") % dims).cast("int")
    # Equal buckets stand side by side, so the places where one begins tell their number.
    begins = lambda found: F.array_compact(
        F.transform(found, lambda x, i: F.when((i == 0) | (F.get(found, i - 1) != x), i))
    )
    counted = lambda found, starts: F.transform(
        starts,
        lambda at, i: F.struct(
            F.get(found, at).alias("bucket"), (F.coalesce(F.get(starts, i + 1), F.size(found)) - at).alias("n")
        ),
    )
    return _with(F.sort_array(F.transform(words, bucket)), lambda found: _with(begins(found), lambda at: counted(found, at)))


def _with(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def word_vectors(text: Column, dims: int = EMBEDDING_DIMS) -> Column:
    """The counts as a vector of length one; a text without words, or a null one, is all zero."""
    zeros = lambda n: F.array_repeat(F.lit(0.0).cast("float"), n)

    def dense(counts: Column) -> Column:
        squares = F.aggregate(counts, F.lit(0.0), lambda total, c: total + c["n"].cast("double") * c["n"])
        before = lambda i: F.when(i > 0, F.get(counts, i - 1)["bucket"]).otherwise(-1)

        def filled(norm: Column) -> Column:
            part = lambda c, i: F.concat(zeros(c["bucket"] - before(i) - 1), F.array((c["n"] / norm).cast("float")))
            rest = dims - 1 - F.coalesce(F.get(counts, F.size(counts) - 1)["bucket"], F.lit(-1))
            return F.concat(F.flatten(F.transform(counts, part)), zeros(rest))

        return _with(F.sqrt(squares), filled)

    return F.when(F.length(text) > 0, _with(word_counts(text, dims), dense)).otherwise(zeros(F.lit(dims)))


class _Buckets(dict):
    """Bucket of each word of a batch."""

    def __init__(self, dims: int):
        self.dims = dims

    def __missing__(self, word: bytes) -> int:
        bucket = self[word] = int(hashlib.md5(word).hexdigest()[:8], 16) % self.dims
        return bucket


def hashed_words(dims: int = EMBEDDING_DIMS) -> Encoder:
    """Word counts in ``dims`` buckets, scaled to length one; a text without words is all zero.

    Words are lower-cased and divided by ASCII white space. The bucket is the first 8 hexadecimal
    digits of the word's md5, modulo ``dims``.
    """

    def encode(texts: list[str]) -> np.ndarray:
        buckets = _Buckets(dims)
        words = [text.lower().encode().split() for text in texts]
        sizes = [len(w) for w in words]
        places = np.fromiter(map(buckets.__getitem__, chain.from_iterable(words)), np.intp, sum(sizes))
        places += np.repeat(np.arange(len(texts)) * dims, sizes)
        counts = np.bincount(places, minlength=len(texts) * dims).reshape(-1, dims).astype(np.float64)
        norms = np.sqrt((counts * counts).sum(axis=1, keepdims=True))
        return (counts / np.where(norms == 0, 1, norms)).astype(np.float32)

    return encode


def encode_texts(
    posts: DataFrame,
    text: str = "text",
    make_encoder: Callable[[], Encoder] | None = None,
    batch: int = ENCODE_BATCH,
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """Add ``embedding`` to the columns in ``keep``, by default all; no shuffle.

    Without an encoder these are ``word_vectors``. An encoder sees ``batch`` texts at a time.
    """
    kept = list(posts.columns if keep is None else keep)
    if make_encoder is None:
        # ``inline`` keeps the vector from being formed once more for each condition on it.
        vector = F.struct(word_vectors(F.col(text)).alias("embedding"))
        return posts.select(*kept, F.inline(F.array(vector)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = make_encoder()
        for records in batches:
            for start in range(0, records.num_rows, batch):
                part = records.slice(start, batch)
                texts = [t or "" for t in part.column(text).to_pylist()]
                matrix = np.ascontiguousarray(encode(texts), dtype=np.float32)
                ends = np.arange(len(texts) + 1, dtype=np.int32) * matrix.shape[1]
                vectors = pa.ListArray.from_arrays(pa.array(ends), pa.array(matrix.ravel()))
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(name) for name in kept], vectors], [*kept, "embedding"]
                )

    fields = [posts.schema[name] for name in kept]
    shape = StructType([*fields, StructField("embedding", ArrayType(FloatType()))])
    return posts.select(*dict.fromkeys([*kept, text])).mapInArrow(run, shape)
