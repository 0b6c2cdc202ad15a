import datetime

import pytest
from pyspark.sql import functions as F

from feedloom.functions import times
from feedloom.functions.codec import pack_vector, unpack_vector
from feedloom.functions.text import embed_text, first_filled, post_uri, public_link, strip


def values(spark, inputs, column, kind="string"):
    """Column values for a list of inputs, in order."""
    rows = [(i, v) for i, v in enumerate(inputs)]
    df = spark.createDataFrame(rows, f"i INT, x {kind}")
    return [r.y for r in df.select("i", column.alias("y")).orderBy("i").collect()]


def test_public_link_of_short_and_long_addresses(spark):
    inputs = ["a", "at:/", "at://did", "at://did/c", "at://did/c/rk", "at://did/c/rk/", None, ""]
    got = values(spark, inputs, public_link(F.col("x")))
    page = "https://bsky.app/profile/"
    assert got == [
        page + "/post/",
        page + "/post/",
        page + "did/post/",
        page + "did/post/c",
        page + "did/post/rk",
        page + "did/post/",
        None,
        page + "/post/",
    ]


def test_post_uri_spells_missing_parts(spark):
    x = F.col("x")
    got = values(spark, ["d", None], post_uri(x, F.lit("k")))
    assert got == ["at://d/app.bsky.feed.post/k", "at://None/app.bsky.feed.post/k"]


def test_first_filled_passes_over_null_and_empty(spark):
    got = values(spark, ["d", "", None], first_filled(F.col("x"), F.lit("repo")))
    assert got == ["d", "repo", "repo"]
    assert values(spark, [""], first_filled(F.lit(None).cast("string"), F.col("x"))) == [""]


def test_strip_takes_all_white_space(spark):
    inputs = ["  a b \n", "\t a ", "", " \x1f", "a\n\nb", None]
    assert values(spark, inputs, strip(F.col("x"))) == [
        v if v is None else v.strip() for v in inputs
    ]


def test_embed_text_counts_characters(spark):
    inputs = ["é" * 301, "🙂" * 300, "short"]
    assert values(spark, inputs, embed_text(F.col("x"), 300)) == [v[:300] for v in inputs]
    assert values(spark, inputs, embed_text(F.col("x"))) == inputs


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_hour_key_is_utc(spark, zone):
    micros = [0, 1, 3_599_999_999, 3_600_000_000, 1_704_067_199_999_999, 1_751_033_512_345_678, -1]
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        got = values(spark, micros, times.hour_key(F.col("x")), "bigint")
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    epoch = datetime.datetime(1970, 1, 1)
    assert got == [
        (epoch + datetime.timedelta(microseconds=m)).strftime("%Y-%m-%dT%H") for m in micros
    ]


def test_written_date_and_hour_keep_the_offset(spark):
    inputs = [
        "2025-06-27T14:01:02.123Z", "2023-12-31T23:30:00-05:00", "2024-02-29", "2024-02-30T10:00:00Z",
        "2024-01-01T24:00:00Z", "2024-01-01 05:00", "yesterday", "", None, "2024-01-01T05:06:07+0530",
    ]
    assert values(spark, inputs, times.written_date(F.col("x"))) == [
        "2025-06-27", "2023-12-31", "2024-02-29", None, None, "2024-01-01", None, None, None,
        "2024-01-01",
    ]
    assert values(spark, inputs, times.written_hour(F.col("x"))) == [
        14, 23, 0, None, None, 5, None, None, None, 5,
    ]


def test_trailing_days_newest_first(spark):
    days = times.trailing_days(F.lit("2024-03-01").cast("date"), 3)
    assert spark.range(1).select(days).first()[0] == ["2024-03-01", "2024-02-29", "2024-02-28"]


def test_vectors_survive_packing(spark):
    vectors = [[1.5, -2.25, 3e-38], [], None, [float(i) for i in range(384)], [0.1]]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vectors)], "i INT, x ARRAY<FLOAT>")
    packed = df.select("i", "x", pack_vector("x").alias("blob"))
    back = packed.select("i", "x", "blob", unpack_vector("blob").alias("y")).orderBy("i").collect()
    assert [r.y for r in back] == [r.x for r in back]
    assert [None if r.blob is None else len(r.blob) for r in back] == [12, 0, None, 1536, 4]
    assert bytes(back[0].blob)[:4] == b"\x00\x00\xc0\x3f"


def test_bytes_that_are_no_vector_give_null(spark):
    blobs = [b"", b"abc", b"\x00\x00\x80\x3f", None, b"\x00\x00\x80\x3f\x00"]
    df = spark.createDataFrame([(i, b) for i, b in enumerate(blobs)], "i INT, x BINARY")
    got = [r.y for r in df.select("i", unpack_vector("x").alias("y")).orderBy("i").collect()]
    assert got == [[], None, [1.0], None, None]
