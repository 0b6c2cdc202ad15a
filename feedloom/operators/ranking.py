"""Positions and top rows without a window over an unbounded group.

An hour or a day may hold a third of all rows. Rows are therefore spread over buckets by the
first digits of a digest of their address; the digest is also the order inside the hour, which
the feed leaves open. Only the bucket counts of a group are ever put side by side.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKET_DIGITS = 3  # hexadecimal: 4,096 buckets per group
SHARES = 64


def _bucket(key: Column) -> Column:
    return F.substring(F.md5(key.cast("string")), 1, BUCKET_DIGITS)


def _digest_order(key: Column) -> list[Column]:
    return [F.md5(key.cast("string")), key]


def number_rows(
    df: DataFrame, groups: Sequence[str], key: str, name: str = "position"
) -> DataFrame:
    """Add the 0-based position of each row in its group, in the order of ``md5(key), key``.

    Group columns are expected to be filled; a row with a null there gets a null position.
    """
    rows = df.withColumn("_bucket", _bucket(F.col(key)))
    before = F.sum("_n").over(
        Window.partitionBy(*groups).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = (
        rows.groupBy(*groups, "_bucket")
        .agg(F.count("*").alias("_n"))
        .select(
            *[F.col(g).alias(f"_{g}") for g in groups],
            F.col("_bucket").alias("_b"),
            F.coalesce(before, F.lit(0)).alias("_before"),
        )
    )
    in_bucket = Window.partitionBy(*groups, "_bucket").orderBy(*_digest_order(F.col(key)))
    ranked = rows.withColumn("_rank", F.row_number().over(in_bucket))
    # Plain equality keeps the partitioning of the window above: rows move once.
    same = [F.col(group) == F.col(f"_{group}") for group in groups]
    return ranked.join(offsets, [*same, F.col("_bucket") == F.col("_b")], "left").select(
        *df.columns, (F.col("_before") + F.col("_rank") - 1).alias(name)
    )


def newest_rows(
    df: DataFrame, limit: int, key: str = "uri", date: str = "created_date", hour: str = "created_hour"
) -> DataFrame:
    """The ``limit`` newest rows by date and hour, then by ``md5(key), key``.

    The input is evaluated once. Rows are dealt over ``SHARES`` by their key, and only ``limit`` rows of each share count:
    Spark drops the others in the task that made them, and again behind the shuffle, so that no task is left with
    ``limit`` rows of every other.
    """
    order = [F.col(date).desc(), F.col(hour).desc(), F.col("_digest"), F.col(key)]
    shares = df.withColumns({"_share": F.pmod(F.xxhash64(key), F.lit(SHARES)), "_digest": F.md5(F.col(key).cast("string"))})
    rank = F.row_number().over(Window.partitionBy("_share").orderBy(*order))
    newest = shares.withColumn("_rank", rank).where(F.col("_rank") <= limit)
    return newest.orderBy(*order).limit(limit).select(*df.columns)
