"""Readers for tables written by this package, and file listings."""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.schemas import EXPORT, EXPORT_COLUMNS, PACKED, POSTS, VECTORS

OPEN_FILES = "spark.sql.maxConcurrentOutputFileWriters"


def list_files(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """``path``, ``modificationTime`` and ``length`` of the files below ``path``.

    The content column is not selected and therefore not read. A missing folder has no files.
    """
    reader = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", "true")
    )
    try:
        files = reader.load(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "path STRING, modificationTime TIMESTAMP, length BIGINT")
    return files.select("path", "modificationTime", "length")


def read_posts_table(spark: SparkSession, path: str) -> DataFrame:
    """Merged posts, one folder per day."""
    return spark.read.schema(POSTS).parquet(path)


def read_export(spark: SparkSession, path: str) -> DataFrame:
    """Exported posts, from hourly chunks or from consolidated days."""
    return spark.read.schema(EXPORT).parquet(path).select(*EXPORT_COLUMNS)


def read_export_files(spark: SparkSession, folder: str, day: str) -> DataFrame:
    """Chunk files of one day that lie in a flat folder as ``posts-DAY-*.parquet``."""
    return (
        spark.read.schema(EXPORT)
        .option("pathGlobFilter", f"posts-{day}-*.parquet")
        .parquet(folder)
    )


def write_vectors_table(vectors: DataFrame, path: str) -> None:
    """Write (runs a job) the searchable vectors with their texts."""
    vectors.select("uri", "text", "embedding").write.mode("overwrite").parquet(path)


def read_vectors(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(VECTORS).parquet(path)


def write_texts(rows: DataFrame, path: str, mode: str, *parts: str, open_files: int = 64) -> None:
    """Write (runs a job) packed texts in folders; a task holds a file open in each of its folders.

    So rows are not sorted by folder first; only those of a task with more than ``open_files`` folders are.
    """
    conf = rows.sparkSession.conf
    before = conf.get(OPEN_FILES)
    conf.set(OPEN_FILES, open_files)
    try:
        writer = rows.write.mode(mode).option("partitionOverwriteMode", "static")
        writer.options(**PACKED).partitionBy(*parts).text(path)
    finally:
        conf.set(OPEN_FILES, before)


def kept_by_key(df: DataFrame, path: str, key: str = "uri", buckets: int | None = None) -> DataFrame:
    """Write (runs a job) rows in buckets by a key and read them back: joins on that key leave them where they lie.

    There are as many buckets as shuffle partitions unless told otherwise.
    """
    spark = df.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"feedloom_{uuid.uuid4().hex}"
    # The buckets are known to the session's catalog; the entry goes once the table is read.
    df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(name)
    rows = spark.table(name)
    rows.schema  # noqa: B018  (resolved while the entry is there)
    spark.sql(f"DROP TABLE {name}")
    return rows


def query_file(spark: SparkSession, path: str, query: str) -> DataFrame:
    """Run SQL over a Parquet file; ``{file}`` in the query stands for it."""
    quoted = "parquet.`" + path.replace("`", "``") + "`"
    return spark.sql(query.replace("{file}", quoted))


def table_names(spark: SparkSession) -> list[str]:
    return sorted(table.name for table in spark.catalog.listTables())


def describe(spark: SparkSession, df: DataFrame) -> DataFrame:
    """Column names and types of a DataFrame, in order."""
    rows = [(i, name, kind) for i, (name, kind) in enumerate(df.dtypes)]
    return spark.createDataFrame(rows, "position INT, column_name STRING, column_type STRING")


def count_by_date(df: DataFrame, column: str = "created_date") -> DataFrame:
    return df.groupBy(column).agg(F.count("*").alias("n")).orderBy(column)
