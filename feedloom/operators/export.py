"""Export of posts with vectors, by day and hour."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.functions.codec import unpack_vector
from feedloom.functions.text import public_link
from feedloom.functions.times import trailing_days
from feedloom.operators.ranking import number_rows
from feedloom.schemas import EXPORT_CHUNK_ROWS, EXPORT_COLUMNS, EXPORT_DAYS


def in_trailing_days(
    df: DataFrame, last: str, days: int = EXPORT_DAYS, column: str = "created_date"
) -> DataFrame:
    """Rows of the ``days`` days that end at ``last`` (``YYYY-MM-DD``).

    Bounds are literals on the bare text column, so they prune partitions and reach the file scan.
    """
    first = datetime.date.fromisoformat(last) - datetime.timedelta(days=days - 1)
    return df.where(F.col(column).between(first.isoformat(), last))


def export_rows(
    posts: DataFrame, last: str, days: int = EXPORT_DAYS, vector: str | None = None
) -> DataFrame:
    """Posts with a vector in the export shape; bytes that are no vector give null.

    ``vector`` names a column that holds the vectors as lists; without it the bytes are unpacked.
    """
    chosen = in_trailing_days(posts, last, days).where(F.col(vector or "embedding_blob").isNotNull())
    embedding = F.col(vector) if vector else unpack_vector(F.col("embedding_blob"))
    return chosen.select(
        "uri", "created_at", "created_date", "created_hour", "text",
        embedding.alias("embedding"),
        public_link(F.col("uri")).alias("post_url"),
    ).select(*EXPORT_COLUMNS)


def with_chunk(
    df: DataFrame,
    rows: int = EXPORT_CHUNK_ROWS,
    groups: tuple[str, ...] = ("created_date", "created_hour"),
    key: str = "uri",
) -> DataFrame:
    """Number the export chunks of each day and hour; no chunk has more than ``rows`` rows."""
    numbered = number_rows(df, groups, key, "_position")
    chunk = F.floor(F.col("_position") / rows).cast("int")
    return numbered.withColumn("chunk", chunk).drop("_position")


def write_chunks(df: DataFrame, path: str, rows: int = EXPORT_CHUNK_ROWS) -> None:
    """Write (runs a job) one folder per day and hour with files of at most ``rows`` rows.

    ``rebalance`` brings an hour together when it is small and splits it when it is not.
    Folders of the exported hours are replaced, so no older file of them stays behind.
    """
    (
        df.hint("rebalance", "created_date", "created_hour")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("maxRecordsPerFile", rows)
        .partitionBy("created_date", "created_hour")
        .parquet(path)
    )


def hour_grid(
    spark: SparkSession, df: DataFrame, last: str, days: int = EXPORT_DAYS
) -> DataFrame:
    """Row count of every hour of the trailing days, empty hours included, newest day first."""
    spine = (
        spark.range(1)
        .select(F.explode(trailing_days(F.lit(last).cast("date"), days)).alias("created_date"))
        .select("created_date", F.explode(F.sequence(F.lit(0), F.lit(23))).alias("created_hour"))
    )
    counts = (
        in_trailing_days(df, last, days)
        .groupBy("created_date", "created_hour")
        .agg(F.count("*").alias("n"))
    )
    return spine.join(counts, ["created_date", "created_hour"], "left").select(
        "created_date", "created_hour", F.coalesce("n", F.lit(0)).alias("rows")
    )
