"""Hour files: newline-separated JSON posts, one file or folder per UTC hour.

Two layouts are read: files named ``YYYY-MM-DDTHH.ndjson`` or ``.ndjson.part``, and the folders
``hour=YYYY-MM-DDTHH`` that the streaming writer makes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# --- fixed values: name pattern of hour files ---
HOUR_FILE = r"^\d{4}-\d{2}-\d{2}T\d{2}\.ndjson(\.part)?$"
# The hour in a path of either layout; looked for once per line, so in one pattern.
HOUR_PATH = (
    r"/(?:hour=(?=[^/]+/)|(?=[^/]+\.ndjson))(\d{4}-\d{2}-\d{2}T\d{2})(?:/[^/]+|\.ndjson(?:\.part)?)$"
)


def is_hour_file(name: Column) -> Column:
    return name.rlike(HOUR_FILE)


def day_of_name(name: Column) -> Column:
    return F.substring(name, 1, 10)


def hour_of(path: Column) -> Column:
    """Hour of a file from its name or its folder; empty for foreign files."""
    return F.regexp_extract(path, HOUR_PATH, 1)


LINES = "value STRING, file_path STRING, file_time BIGINT, hour STRING, block_start BIGINT"


def hour_lines(text: DataFrame, *extra: Column) -> DataFrame:
    """Lines of the hour files among text files, with file, hour and day."""
    path = F.col("_metadata.file_path")
    lines = text.where((hour_of(path) != "") & (F.col("value") != "")).select(
        "value",
        path.alias("file_path"),
        F.unix_micros("_metadata.file_modification_time").alias("file_time"),
        hour_of(path).alias("hour"),
        F.col("_metadata.file_block_start").alias("block_start"),
        *extra,
    )
    return lines.withColumn("file_day", day_of_name(F.col("hour")))


def read_lines(spark: SparkSession, path: str, day: str | None = None) -> DataFrame:
    """Lines of all hour files below ``path``, or of one day, with file and hour."""
    text = spark.read.option("recursiveFileLookup", "true").text(path)
    if day is not None:
        # A filter on paths alone: files of other days are not opened.
        text = text.where(day_of_name(hour_of(F.col("_metadata.file_path"))) == day)
    return hour_lines(text)


def stream_lines(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """The same as a stream over closed files. ``indexed_at`` is the start of the micro-batch,

    which Spark keeps in the offset log, so a repeated batch gets the same value. This source reads a file
    once, so open files (``.part``) are left to the reader of growing files, or to their closing.
    """
    text = spark.readStream.options(**options).option("recursiveFileLookup", "true").text(path)
    text = text.where(~F.col("_metadata.file_path").endswith(".part"))
    indexed_at = F.unix_micros(F.current_timestamp()).alias("indexed_at")
    return hour_lines(text, indexed_at)


def arrival() -> Column:
    """Order of a line: by hour, open file after closed one, file time, split and place in the split.

    Only the relative order inside a split is taken from the running number, and a split
    is always read front to back, so a repeated task gives the same order. All parts are numbers,
    as a merge carries several of these per row.
    """
    return F.struct(
        F.translate("hour", "-T", "").cast("bigint").alias("hour"),
        F.col("file_path").endswith(".part").alias("open"),
        "file_time",
        F.xxhash64("file_path").alias("file"),
        "block_start",
        F.monotonically_increasing_id().alias("line"),
    )


def files_by_day(names: DataFrame, column: str = "file_name") -> DataFrame:
    """Sorted file names of each day; at most 48 names fit the pattern for a day."""
    name = F.col(column)
    return (
        names.where(is_hour_file(name))
        .groupBy(day_of_name(name).alias("file_day"))
        .agg(F.sort_array(F.collect_set(name)).alias("files"))
    )


def rows_per_file(lines: DataFrame, column: str = "file_name") -> DataFrame:
    """Number of submitted rows per file."""
    return lines.groupBy(column).agg(F.count("*").alias("rows"))


def hour_states(hours: DataFrame, as_of_hour: str, column: str = "hour") -> DataFrame:
    """``closed`` for every hour but the running one, future hours included."""
    return (
        hours.groupBy(column)
        .agg(F.count("*").alias("rows"))
        .withColumn("closed", F.col(column) != as_of_hour)
    )


def cursor(df: DataFrame, column: str = "time_us") -> DataFrame:
    """Highest event time seen, in whatever order the events came."""
    return df.agg(F.max(column).alias("time_us"))
