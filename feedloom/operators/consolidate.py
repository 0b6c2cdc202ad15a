"""Daily consolidation of export chunks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.operators.export import in_trailing_days
from feedloom.schemas import EXPORT_DAYS
from feedloom.sources.tables import list_files, read_export


def day_of_path(path: Column) -> Column:
    """Day in a folder ``created_date=YYYY-MM-DD`` or a file name ``posts-YYYY-MM-DD...``."""
    return F.regexp_extract(path, r"(?:created_date=|posts-)(\d{4}-\d{2}-\d{2})", 1)


def stale_days(chunks: DataFrame, consolidated: DataFrame) -> DataFrame:
    """Days to rebuild: not consolidated yet, or with any chunk newer than the consolidated data.

    Both inputs have ``day`` and ``modified``, one row per file. A day spread over several
    consolidated files is as old as the oldest of them.
    """
    newest = chunks.groupBy("day").agg(F.max("modified").alias("chunk_modified"))
    done = consolidated.groupBy("day").agg(F.min("modified").alias("done_modified"))
    return newest.join(done, "day", "left").select(
        "day",
        "chunk_modified",
        "done_modified",
        (F.col("done_modified").isNull() | (F.col("chunk_modified") > F.col("done_modified"))).alias(
            "stale"
        ),
    )


def file_days(spark: SparkSession, path: str) -> DataFrame:
    """``day`` and ``modified`` of every Parquet file below ``path``; contents are not read."""
    files = list_files(spark, path, "*.parquet")
    return files.select(
        day_of_path(F.col("path")).alias("day"), F.col("modificationTime").alias("modified")
    ).where(F.col("day") != "")


def consolidate(
    spark: SparkSession, chunk_path: str, path: str, last: str, days: int = EXPORT_DAYS
) -> DataFrame:
    """Rebuild (runs a job) the stale days among the trailing ones and return the day report.

    A day becomes one file; a day too big for one task is split by ``rebalance``.
    """
    report = stale_days(
        in_trailing_days(file_days(spark, chunk_path), last, days, "day"), file_days(spark, path)
    )
    # One row per trailing day, fixed now: writing changes the file times the report is made from.
    rows = [(r.day, r.stale) for r in report.select("day", "stale").collect()]
    days_now = [day for day, stale in rows if stale]
    if days_now:
        (
            read_export(spark, chunk_path)
            .where(F.col("created_date").isin(days_now))
            .hint("rebalance", "created_date")
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("created_date")
            .parquet(path)
        )
    return spark.createDataFrame(rows, "day STRING, rebuilt BOOLEAN")
