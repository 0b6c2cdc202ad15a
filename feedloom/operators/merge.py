"""Keyed merges of post tables.

All of them pre-aggregate before the shuffle, so a post that arrives a billion times
leaves each task as one row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.operators.importing import derived_columns

FIRST = ("author_did", "rkey", "time_us")
LAST = (
    "cid", "text", "reply_parent", "reply_root", "quote_uri", "langs_json", "lang_en",
    "emb_model", "emb_dims",
)


def merge_posts(
    rows: DataFrame, keys: Sequence[str] = ("file_day", "uri"), arrival: str = "arrival"
) -> DataFrame:
    """One row per post from all its arrivals, column by column.

    Author, key and event time come from the first arrival; content, nulls included, from
    the last one; date and vector from the last arrival that has one. Index times span all arrivals.

    A merged row can stand for its arrivals in a later merge, so batches may be merged on
    their own first, and the same batches may be merged again without effect.
    """
    # Equal positions are replays of one line; a digest settles any other tie the same way each
    # time. The place goes through the shuffle four times per row, so it must stay small.
    place = F.struct(arrival, F.xxhash64("cid", "text"))
    when_set = lambda name: F.max_by(name, F.when(F.col(name).isNotNull(), place))
    merged = rows.groupBy(*keys).agg(
        F.min_by(
            F.struct(*FIRST, "has_embedding", F.col("emb_vec").isNotNull().alias("vec")), place
        ).alias("first"),
        F.max_by(F.struct(*LAST), place).alias("last"),
        when_set("created_at").alias("created_at"),
        when_set("emb_vec").alias("emb_vec"),
        F.count("emb_vec").alias("vectors"),
        F.min("indexed_first").alias("indexed_first"),
        F.max("indexed_last").alias("indexed_last"),
    )
    later_vectors = F.col("vectors") - F.col("first.vec").cast("int")
    return merged.select(
        *keys,
        "first.author_did", "first.rkey", "last.cid", "created_at", "first.time_us",
        "indexed_first", "indexed_last",
        "last.text", "last.reply_parent", "last.reply_root", "last.quote_uri",
        "last.langs_json", "last.lang_en",
        F.when(later_vectors > 0, 1).otherwise(F.col("first.has_embedding")).alias("has_embedding"),
        "last.emb_model", "last.emb_dims", "emb_vec",
    ).select(
        *keys,
        "author_did", "rkey", "cid", "created_at", "time_us", "indexed_first", "indexed_last",
        "text", "reply_parent", "reply_root", "quote_uri", "langs_json", "lang_en",
        "has_embedding", *derived_columns(), "emb_model", "emb_dims", "emb_vec",
    )


def first_per_key(rows: DataFrame, key: str, arrival: Column) -> DataFrame:
    """The first arrival of each key."""
    whole = F.struct(*[F.col(c) for c in rows.columns])
    return rows.groupBy(key).agg(F.min_by(whole, arrival).alias("row")).select("row.*")


def insert_or_ignore(
    existing: DataFrame, new: DataFrame, arrival: Column, key: str = "uri"
) -> DataFrame:
    """Existing rows, and the first arrival of every key not among them."""
    # Reduced to one row per key first: the anti join then meets no repeated key.
    fresh = first_per_key(new, key, arrival).join(existing.select(key), key, "left_anti")
    return existing.unionByName(fresh.select(*existing.columns))


def write_vectors(
    posts: DataFrame, vectors: DataFrame, key: str = "uri", written: str | None = None
) -> DataFrame:
    """Older-shape posts with ``embedding_blob`` set and ``embedding = 'y'`` where a vector came in.

    ``vectors`` has the key and ``embedding_blob``; of several blobs for a key the one written last counts,
    by the column ``written``. Among equals, and without that column, it is the largest. Both sides meet by a
    sort: sizes of decoded texts and of packed vectors are guessed far too small, and neither may go through the driver.
    """
    place = F.struct(*([written] if written else []), "embedding_blob")
    filled = F.when(F.col("embedding_blob").isNotNull(), place)
    one_each = vectors.groupBy(key).agg(F.max_by("embedding_blob", filled).alias("_blob"))
    arrived = F.col("_blob").isNotNull()
    return posts.join(one_each.hint("merge"), key, "left").select(
        *[F.col(c) for c in posts.columns if c not in ("embedding", "embedding_blob")],
        F.when(arrived, "y").otherwise(F.col("embedding")).alias("embedding"),
        F.coalesce("_blob", "embedding_blob").alias("embedding_blob"),
    )


def with_vectors(posts: DataFrame, vectors: DataFrame, written: Column) -> DataFrame:
    """Merged posts with the vectors of their day and address; of several the one written last counts.

    ``vectors`` has ``file_day, uri, emb_vec, emb_model``. Posts just merged lie by these two keys already, so the join moves
    the vectors only. Posts without a vector among them stay as they are.
    """
    latest = vectors.groupBy("file_day", "uri").agg(F.max_by(F.struct("emb_vec", "emb_model"), written).alias("_new"))
    arrived = F.col("_new").isNotNull()
    new = {
        "has_embedding": F.lit(1), "emb_model": F.col("_new.emb_model"),
        "emb_dims": F.size("_new.emb_vec"), "emb_vec": F.col("_new.emb_vec"),
    }
    return posts.join(latest, ["file_day", "uri"], "left").select(
        *[F.when(arrived, new[c]).otherwise(F.col(c)).alias(c) if c in new else F.col(c) for c in posts.columns]
    )
