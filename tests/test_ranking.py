import hashlib
import random

from pyspark.sql import functions as F

from feedloom.operators.export import with_chunk
from feedloom.operators.pending import embedding_queue, without_vector
from feedloom.operators.ranking import newest_rows, number_rows

SCHEMA = "uri STRING, created_date STRING, created_hour INT, text STRING"


def digest(uri):
    return hashlib.md5(uri.encode()).hexdigest(), uri


def rows(count=2000, seed=1):
    """A third of the rows lie in one hour."""
    rng = random.Random(seed)
    out = []
    for i in range(count):
        day, hour = (2, 12) if rng.random() < 1 / 3 else (rng.randint(1, 3), rng.randrange(24))
        out.append((f"u{i}", f"2024-01-0{day}", hour, f"t{i}"))
    return out


def by_hour(data):
    hours = {}
    for row in data:
        hours.setdefault(row[1:3], []).append(row[0])
    return {k: sorted(v, key=digest) for k, v in hours.items()}


def test_positions_in_crowded_groups(spark):
    data = rows()
    df = spark.createDataFrame(data, SCHEMA).repartition(7)
    got = number_rows(df, ("created_date", "created_hour"), "uri").collect()
    assert len(got) == len(data)
    for key, uris in by_hour(data).items():
        placed = {r.position: r.uri for r in got if (r.created_date, r.created_hour) == key}
        assert placed == dict(enumerate(uris))


def test_rows_without_a_group_stay(spark):
    df = spark.createDataFrame([("a", None, 1, "t"), ("b", "2024-01-01", 1, "t")], SCHEMA)
    got = {r.uri: r.position for r in number_rows(df, ("created_date", "created_hour"), "uri").collect()}
    assert got == {"a": None, "b": 0}


def test_chunks_are_full_but_the_last(spark):
    data = rows()
    df = with_chunk(spark.createDataFrame(data, SCHEMA), 50)
    counts = df.groupBy("created_date", "created_hour", "chunk").count().collect()
    sizes = {(r.created_date, r.created_hour, r.chunk): r["count"] for r in counts}
    for key, uris in by_hour(data).items():
        full, rest = divmod(len(uris), 50)
        wanted = [50] * full + [rest] * bool(rest)
        assert [sizes.pop((*key, c)) for c in range(len(wanted))] == wanted
    assert not sizes


def test_newest_rows_equal_a_plain_sort(spark):
    data = rows()
    df = spark.createDataFrame(data, SCHEMA).repartition(5)
    ordered = sorted(data, key=lambda r: digest(r[0]))
    ordered.sort(key=lambda r: r[1:3], reverse=True)
    for limit in (1, 10, 500, 700, 900, 1999, 2000, 5000):
        got = [r.uri for r in newest_rows(df, limit).collect()]
        assert got == [r[0] for r in ordered[:limit]], limit


def test_newest_rows_of_nothing(spark):
    assert newest_rows(spark.createDataFrame([], SCHEMA), 10).count() == 0


def test_the_queue_takes_english_posts_without_vector(spark):
    schema = SCHEMA + ", langs STRING, embedding STRING"
    text = "x" * 400
    data = [
        ("a", "2024-01-01", 1, text, "en", None),
        ("b", "2024-01-02", 1, "é" * 11, "en", None),
        ("c", "2024-01-02", 1, "é" * 10, "en", None),
        ("d", "2024-01-02", 1, text, "en,de", None),
        ("e", "2024-01-02", 1, text, None, None),
        ("f", "2024-01-02", 1, text, "en", "y"),
        ("g", "2024-01-02", 1, None, "en", None),
        ("h", "2024-01-02", 2, text, "en", None),
    ]
    queue = embedding_queue(spark.createDataFrame(data, schema)).collect()
    assert [(r.uri, len(r.text)) for r in queue] == [("h", 400), ("b", 11), ("a", 400)]
    asked = embedding_queue(spark.createDataFrame(data, schema), 1, 300).collect()
    assert [(r.uri, len(r.text)) for r in asked] == [("h", 300)]


def test_the_queue_has_no_limit_of_its_own(spark):
    posts = spark.range(30_500).selectExpr(
        "cast(id as string) uri", "'2024-01-01' created_date", "1 created_hour", "'long enough text' text", "'en' langs",
        "cast(null as string) embedding")
    assert embedding_queue(posts).count() == 30_500


def test_posts_with_a_vector_leave_the_queue(spark):
    posts = spark.createDataFrame([("a",), ("b",)], "uri STRING")
    vectors = spark.createDataFrame([("b",), ("b",)], "uri STRING")
    assert [r.uri for r in without_vector(posts, vectors).collect()] == ["a"]


def test_no_step_takes_an_unbounded_group(spark, folder):
    spark.createDataFrame(rows(), SCHEMA).write.parquet(folder + "/posts")
    df = spark.read.parquet(folder + "/posts")
    for plan in (number_rows(df, ("created_date", "created_hour"), "uri"), newest_rows(df, 100)):
        text = plan._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_the_newest_rows_are_found_in_one_pass(spark, folder):
    spark.createDataFrame(rows(), SCHEMA).write.parquet(folder + "/posts")
    plan = newest_rows(spark.read.parquet(folder + "/posts"), 100)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Exchange") == 1
    # Rows past the limit go before they are shuffled.
    assert plan.count("WindowGroupLimit") == 2 and "TakeOrderedAndProject(limit=100" in plan
