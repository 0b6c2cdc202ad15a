"""The work queue of posts that still need a vector."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.functions.text import embed_text
from feedloom.operators.ranking import newest_rows
from feedloom.schemas import MIN_TEXT_LENGTH


def english_only(langs: Column) -> Column:
    """English is the sole language (older shape, comma-joined)."""
    return langs == "en"


def pending_posts(posts: DataFrame, min_length: int = MIN_TEXT_LENGTH) -> DataFrame:
    """English posts without a vector whose text is longer than ``min_length`` characters."""
    return posts.where(
        F.col("embedding").isNull() & english_only(F.col("langs")) & (F.length("text") > min_length)
    )


def without_vector(posts: DataFrame, vectors: DataFrame, key: str = "uri") -> DataFrame:
    """Posts whose key is not in the vector table yet."""
    return posts.join(vectors.select(key), key, "left_anti")


def embedding_queue(
    posts: DataFrame, limit: int | None = None, max_chars: int | None = None
) -> DataFrame:
    """All pending posts, newest first; or the ``limit`` newest, with ``max_chars`` of their text, if a caller says so."""
    pending = pending_posts(posts)
    newest = [F.col("created_date").desc(), F.col("created_hour").desc()]
    queue = (
        pending.orderBy(*newest, F.md5("uri"), "uri") if limit is None else newest_rows(pending, limit)
    )
    return queue.withColumn("text", embed_text(F.col("text"), max_chars))
