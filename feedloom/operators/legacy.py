"""Merged posts in the older table shape, which the queue, the export and the search read."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.functions.codec import pack_vector
from feedloom.functions.times import written_date, written_hour


def legacy_view(posts: DataFrame, *keep: str) -> DataFrame:
    """Older columns: comma-joined languages, date and hour as written, vector as bytes."""
    langs = F.from_json("langs_json", "array<string>")
    return posts.select(
        "uri",
        F.col("author_did").alias("repo"),
        "rkey",
        "created_at",
        written_date(F.col("created_at")).alias("created_date"),
        written_hour(F.col("created_at")).alias("created_hour"),
        "text",
        F.array_join(langs, ",").alias("langs"),
        F.lit(None).cast("string").alias("raw_json"),
        F.when(F.col("emb_vec").isNotNull(), "y").alias("embedding"),
        pack_vector(F.col("emb_vec")).alias("embedding_blob"),
        *keep,
    )
