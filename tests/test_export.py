import glob
import os
import pathlib

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from feedloom.functions.codec import pack_vector
from feedloom.operators.consolidate import consolidate, file_days, stale_days
from feedloom.operators.export import export_rows, hour_grid, in_trailing_days, write_chunks
from feedloom.schemas import EXPORT_COLUMNS
from feedloom.sources.tables import (
    count_by_date,
    describe,
    list_files,
    query_file,
    read_export,
    read_export_files,
    table_names,
)

SCHEMA = (
    "uri STRING, created_at STRING, created_date STRING, created_hour INT, text STRING, "
    "embedding ARRAY<FLOAT>, post_url STRING"
)


def rows(day, hour, count, start=0):
    return [
        (f"at://d/c/{day}-{hour}-{i}", f"{day}T{hour:02d}:00:00Z", day, hour, f"t{i}", [float(i)], "l")
        for i in range(start, start + count)
    ]


def exported(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def file_rows(path):
    return {f: pq.ParquetFile(f).metadata.num_rows for f in glob.glob(path + "/**/*.parquet", recursive=True)}


def test_export_rows(spark):
    schema = "uri STRING, created_at STRING, created_date STRING, created_hour INT, text STRING, vec ARRAY<FLOAT>"
    data = [
        ("at://d/c/1", "x", "2024-01-05", 3, "t", [1.0, 2.0]),
        ("at://d/c/2", "x", "2024-01-03", 3, None, [3.0]),
        ("at://d/c/3", "x", "2024-01-02", 3, "t", [1.0]),
        ("at://d/c/4", "x", "2024-01-06", 3, "t", [1.0]),
        ("at://d/c/5", "x", "2024-01-05", 3, "t", None),
    ]
    posts = spark.createDataFrame(data, schema).withColumn("embedding_blob", pack_vector("vec"))
    df = export_rows(posts, "2024-01-05")
    assert tuple(df.columns) == EXPORT_COLUMNS
    got = {r.uri: r for r in df.collect()}
    assert set(got) == {"at://d/c/1", "at://d/c/2"}
    assert got["at://d/c/1"].embedding == [1.0, 2.0]
    assert got["at://d/c/1"].post_url == "https://bsky.app/profile/d/post/1"


def test_bad_bytes_are_exported_as_null(spark):
    posts = spark.createDataFrame(
        [("u", "x", "2024-01-05", 3, "t", b"abc")],
        "uri STRING, created_at STRING, created_date STRING, created_hour INT, text STRING, embedding_blob BINARY",
    )
    assert export_rows(posts, "2024-01-05").first().embedding is None


def test_trailing_days_prune_folders(spark, folder):
    write_chunks(exported(spark, rows("2024-01-01", 1, 3) + rows("2024-01-04", 1, 3)), folder + "/c")
    df = in_trailing_days(read_export(spark, folder + "/c"), "2024-01-05")
    assert {r.created_date for r in df.collect()} == {"2024-01-04"}
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(created_date" in plan


def test_chunk_files_are_bounded_and_hours_apart(spark, folder):
    data = rows("2024-01-01", 1, 250) + rows("2024-01-01", 2, 30) + rows("2024-01-02", 1, 100)
    write_chunks(exported(spark, data), folder + "/c", 100)
    sizes = file_rows(folder + "/c")
    assert max(sizes.values()) <= 100 and sum(sizes.values()) == 380
    hours = {os.path.dirname(f).split("/c/")[1] for f in sizes}
    assert hours == {
        "created_date=2024-01-01/created_hour=1", "created_date=2024-01-01/created_hour=2",
        "created_date=2024-01-02/created_hour=1",
    }
    assert sorted(read_export(spark, folder + "/c").collect()) == sorted(exported(spark, data).collect())


def test_a_smaller_export_replaces_the_hour_only(spark, folder):
    write_chunks(exported(spark, rows("2024-01-01", 1, 250) + rows("2024-01-01", 2, 5)), folder + "/c", 50)
    write_chunks(exported(spark, rows("2024-01-01", 1, 20)), folder + "/c", 50)
    counts = read_export(spark, folder + "/c").groupBy("created_hour").count().collect()
    assert {r.created_hour: r["count"] for r in counts} == {1: 20, 2: 5}


def test_a_crowded_hour_is_split(spark, folder):
    many = spark.range(0, 40_000, 1, 8).select(
        F.concat(F.lit("u"), F.col("id").cast("string")).alias("uri"), F.lit("x").alias("created_at"),
        F.lit("2024-01-01").alias("created_date"), F.lit(1).alias("created_hour"),
        F.md5(F.col("id").cast("string")).alias("text"),
        F.array(F.col("id").cast("float")).alias("embedding"), F.lit("l").alias("post_url"),
    )
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256k")
    try:
        write_chunks(many, folder + "/c")
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", before)
    sizes = file_rows(folder + "/c")
    assert len(sizes) > 4 and max(sizes.values()) <= 10_000 and sum(sizes.values()) == 40_000


def test_hour_grid_has_all_hours(spark):
    grid = hour_grid(spark, exported(spark, rows("2024-03-01", 5, 7) + rows("2024-02-27", 5, 7)), "2024-03-01")
    got = {(r.created_date, r.created_hour): r.rows for r in grid.collect()}
    assert len(got) == 72 and got[("2024-03-01", 5)] == 7 and sum(got.values()) == 7
    assert {d for d, _ in got} == {"2024-03-01", "2024-02-29", "2024-02-28"}


def test_stale_days(spark):
    schema = "day STRING, modified INT"
    chunks = spark.createDataFrame([("a", 1), ("a", 9), ("b", 5), ("b", 3), ("c", 1), ("d", 7)], schema)
    done = spark.createDataFrame([("a", 8), ("b", 5), ("d", 9), ("d", 6), ("z", 1)], schema)
    got = {r.day: r.stale for r in stale_days(chunks, done).collect()}
    assert got == {"a": True, "b": False, "c": True, "d": True}


def test_consolidation_rebuilds_only_what_changed(spark, folder):
    chunks, daily = folder + "/c", folder + "/d"
    write_chunks(exported(spark, rows("2024-01-04", 1, 30) + rows("2024-01-05", 1, 30)), chunks, 10)
    first = consolidate(spark, chunks, daily, "2024-01-05")
    assert {r.day: r.rebuilt for r in first.collect()} == {"2024-01-04": True, "2024-01-05": True}
    files = file_rows(daily)
    assert sorted(files.values()) == [30, 30]

    again = consolidate(spark, chunks, daily, "2024-01-05")
    assert not any(r.rebuilt for r in again.collect())
    assert file_rows(daily) == files

    write_chunks(exported(spark, rows("2024-01-05", 2, 5)), chunks, 10)
    later = max(os.path.getmtime(f) for f in files) + 10
    for f in glob.glob(chunks + "/created_date=2024-01-05/created_hour=2/*.parquet"):
        os.utime(f, (later, later))
    third = consolidate(spark, chunks, daily, "2024-01-05")
    assert {r.day: r.rebuilt for r in third.collect()} == {"2024-01-04": False, "2024-01-05": True}
    counts = read_export(spark, daily).groupBy("created_date").count().collect()
    assert {r.created_date: r["count"] for r in counts} == {"2024-01-04": 30, "2024-01-05": 35}


def test_consolidation_without_chunks(spark, folder):
    assert consolidate(spark, folder + "/none", folder + "/d", "2024-01-05").count() == 0


def test_days_outside_the_window_are_left(spark, folder):
    write_chunks(exported(spark, rows("2024-01-01", 1, 3) + rows("2024-01-05", 1, 3)), folder + "/c")
    report = consolidate(spark, folder + "/c", folder + "/d", "2024-01-05").collect()
    assert [r.day for r in report] == ["2024-01-05"]


def test_flat_chunk_files_of_a_day(spark, folder):
    for name, n in (("posts-2024-01-05-03.0", 2), ("posts-2024-01-05-04.0", 3), ("posts-2024-01-06-03.0", 4)):
        table = pa.Table.from_pylist(
            [dict(zip(EXPORT_COLUMNS, r)) for r in rows("2024-01-05", 3, n)]
        )
        pq.write_table(table, f"{folder}/{name}.parquet")
    assert read_export_files(spark, folder, "2024-01-05").count() == 5
    days = file_days(spark, folder).groupBy("day").count().collect()
    assert {r.day: r["count"] for r in days} == {"2024-01-05": 2, "2024-01-06": 1}


def test_listing_a_missing_folder(spark, folder):
    assert list_files(spark, folder + "/none").count() == 0


def test_sql_over_a_file(spark, folder):
    path = folder + "/events"
    exported(spark, rows("2024-01-04", 1, 4) + rows("2024-01-05", 2, 6)).write.parquet(path)
    assert query_file(spark, path, "SELECT count(*) AS n FROM {file}").first().n == 10
    assert query_file(spark, path, "SELECT * FROM {file} WHERE created_hour = 2 LIMIT 3").count() == 3
    df = spark.read.parquet(path)
    assert [tuple(r) for r in count_by_date(df).collect()] == [("2024-01-04", 4), ("2024-01-05", 6)]
    assert [tuple(r) for r in describe(spark, df).collect()][3] == (3, "created_hour", "int")
    df.createOrReplaceTempView("exported_posts")
    assert "exported_posts" in table_names(spark)
    spark.catalog.dropTempView("exported_posts")


def test_small_results_go_to_pandas_and_arrow(spark):
    df = exported(spark, rows("2024-01-04", 1, 4)).select("uri", "created_hour")
    assert df.toPandas().shape == (4, 2) and df.toArrow().num_rows == 4


def test_reads_only_the_columns_asked_for(spark, folder):
    write_chunks(exported(spark, rows("2024-01-04", 1, 4)), folder + "/c")
    df = read_export(spark, folder + "/c").where("created_date = '2024-01-04'").select("uri")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<uri:string>" in plan


@pytest.mark.parametrize("name", ["region"])
def test_no_data_in_the_repository(name):
    root = pathlib.Path(__file__).parent.parent
    assert not list(root.glob("**/*.parquet"))
