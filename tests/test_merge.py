import random

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from feedloom.operators.legacy import legacy_view
from feedloom.operators.merge import first_per_key, insert_or_ignore, merge_posts, with_vectors, write_vectors
from feedloom.schemas import POSTS

COLUMNS = [c.split()[0] for c in POSTS.replace("\n", " ").split(",")]
LAST = [
    "cid", "text", "reply_parent", "reply_root", "quote_uri", "langs_json", "lang_en", "emb_model",
    "emb_dims",
]


def row(uri, arrival, **changes):
    base = {
        "file_day": "2024-01-01", "uri": uri, "author_did": f"a{arrival}", "rkey": f"k{arrival}",
        "cid": f"c{arrival}", "created_at": f"2024-01-01T00:00:{arrival:02d}Z", "time_us": arrival,
        "indexed_first": arrival, "indexed_last": arrival, "text": f"t{arrival}",
        "reply_parent": None, "reply_root": None, "quote_uri": None, "langs_json": "[]",
        "lang_en": 0, "has_embedding": 0, "is_reply": 0, "is_quote": 0, "created_day": "",
        "created_hour": "", "emb_model": None, "emb_dims": None, "emb_vec": None,
    }
    return base | changes | {"arrival": arrival}


def fold(rows):
    """The merge rules applied one row after the other."""
    done = {}
    for new in sorted(rows, key=lambda r: r["arrival"]):
        key = (new["file_day"], new["uri"])
        old = done.get(key)
        if old is None:
            done[key] = dict(new)
            continue
        for name in LAST:
            old[name] = new[name]
        old["created_at"] = new["created_at"] or old["created_at"]
        old["indexed_first"] = min(old["indexed_first"], new["indexed_first"])
        old["indexed_last"] = max(old["indexed_last"], new["indexed_last"])
        if new["emb_vec"] is not None:
            old["emb_vec"], old["has_embedding"] = new["emb_vec"], 1
    for post in done.values():
        post["is_reply"] = int(post["reply_parent"] is not None)
        post["is_quote"] = int(post["quote_uri"] is not None)
        post["created_day"] = post["created_at"][:10]
        post["created_hour"] = post["created_at"][:13]
    return {k: {c: v[c] for c in COLUMNS} for k, v in done.items()}


def frame(spark, rows):
    data = [tuple(r[c] for c in (*COLUMNS, "arrival")) for r in rows]
    return spark.createDataFrame(data, POSTS + ", arrival BIGINT")


def result(df):
    rows = [r.asDict() for r in df.collect()]
    return {(r["file_day"], r["uri"]): {c: r[c] for c in COLUMNS} for r in rows}


def random_rows(seed, count=300, keys=40):
    rng = random.Random(seed)
    maybe = lambda v: v if rng.random() < 0.5 else None
    rows = []
    for arrival in range(count):
        # One post gets a third of all arrivals.
        uri = "hot" if rng.random() < 0.34 else f"u{rng.randrange(keys)}"
        rows.append(
            row(
                uri, arrival, file_day=f"2024-01-0{rng.randint(1, 2)}",
                indexed_first=rng.randrange(1000), indexed_last=rng.randrange(1000),
                text=maybe(f"t{arrival}"), reply_parent=maybe("p"), quote_uri=maybe("q"),
                emb_model=maybe("m"), emb_dims=maybe(2), lang_en=rng.randint(0, 1),
                emb_vec=maybe([float(arrival), 1.0]), has_embedding=rng.randint(0, 1),
            )
        )
    rng.shuffle(rows)
    return rows


def test_merge_equals_the_row_by_row_rules(spark):
    for seed in range(3):
        rows = random_rows(seed)
        assert result(merge_posts(frame(spark, rows))) == fold(rows)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(seed=st.integers(0, 10_000), cut=st.integers(1, 299))
def test_batches_may_be_merged_first(spark, seed, cut):
    rows = random_rows(seed)
    early = [r for r in rows if r["arrival"] < cut]
    late = [r for r in rows if r["arrival"] >= cut]
    layer = lambda part, place: merge_posts(frame(spark, part)).withColumn("arrival", F.lit(place))
    layers = layer(early, 0).unionByName(layer(late, 1))
    assert result(merge_posts(layers)) == fold(rows)


def test_replayed_layers_change_nothing(spark):
    # The flag of a single row tells whether it has a vector, as everywhere outside these tests.
    rows = [r | {"has_embedding": int(r["emb_vec"] is not None)} for r in random_rows(7)]
    early = merge_posts(frame(spark, [r for r in rows if r["arrival"] < 150]))
    late = merge_posts(frame(spark, [r for r in rows if r["arrival"] >= 150]))
    layers = early.withColumn("arrival", F.lit(1)).unionByName(late.withColumn("arrival", F.lit(2)))
    base = merge_posts(layers).withColumn("arrival", F.lit(0))
    once = result(merge_posts(layers))
    again = result(merge_posts(base.unionByName(layers)))
    assert once == again


def test_same_lines_twice_make_one_post(spark):
    rows = [row("u", 1), row("u", 1), row("u", 1)]
    assert result(merge_posts(frame(spark, rows))) == fold(rows[:1])


def test_last_null_wins_but_vector_stays(spark):
    rows = [
        row("u", 1, text="a"), row("u", 2, text="b", emb_vec=[1.0], emb_model="m", emb_dims=1),
        row("u", 3, text=None),
    ]
    post = result(merge_posts(frame(spark, rows)))[("2024-01-01", "u")]
    assert post["text"] is None and post["emb_model"] is None and post["emb_dims"] is None
    assert post["emb_vec"] == [1.0] and post["has_embedding"] == 1
    assert post["time_us"] == 1 and post["author_did"] == "a1"


def test_days_are_merged_apart(spark):
    rows = [row("u", 1), row("u", 2, file_day="2024-01-02")]
    assert len(result(merge_posts(frame(spark, rows)))) == 2


def test_first_arrival_wins(spark):
    schema = "uri STRING, text STRING, n INT"
    existing = spark.createDataFrame([("a", "old", 0)], schema)
    new = spark.createDataFrame([("a", "x", 1), ("b", "late", 5), ("b", "early", 2), ("c", None, 3)], schema)
    got = insert_or_ignore(existing, new, F.col("n")).collect()
    assert sorted(tuple(r) for r in got) == [("a", "old", 0), ("b", "early", 2), ("c", None, 3)]
    assert first_per_key(new, "uri", F.col("n")).count() == 3


def test_vectors_are_written_back(spark):
    posts = spark.createDataFrame(
        [("a", None, None), ("b", "y", b"old"), ("c", "y", b"keep")],
        "uri STRING, embedding STRING, embedding_blob BINARY",
    )
    vectors = spark.createDataFrame(
        [("a", b"new"), ("a", b"new"), ("b", b"newer"), ("x", b"lost")], "uri STRING, embedding_blob BINARY"
    )
    got = {r.uri: (r.embedding, bytes(r.embedding_blob)) for r in write_vectors(posts, vectors).collect()}
    assert got == {"a": ("y", b"new"), "b": ("y", b"newer"), "c": ("y", b"keep")}


def test_the_vector_written_last_counts(spark):
    posts = spark.createDataFrame([("a", None, None)], "uri STRING, embedding STRING, embedding_blob BINARY")
    vectors = spark.createDataFrame(
        [("a", b"zz", 1), ("a", b"aa", 2), ("a", None, 3)], "uri STRING, embedding_blob BINARY, at INT"
    )
    (got,) = write_vectors(posts, vectors, written="at").collect()
    assert (got.embedding, bytes(got.embedding_blob)) == ("y", b"aa")


def test_merged_posts_in_the_older_shape(spark):
    rows = [row("u", 1, langs_json='["en","de"]', emb_vec=[1.0]), row("v", 2)]
    got = {r.uri: r for r in legacy_view(merge_posts(frame(spark, rows))).collect()}
    assert got["u"].langs == "en,de" and got["u"].embedding == "y" and len(got["u"].embedding_blob) == 4
    assert got["v"].langs == "" and got["v"].embedding is None and got["v"].embedding_blob is None
    assert (got["u"].created_date, got["u"].created_hour) == ("2024-01-01", 0)


def test_vectors_are_written_back_by_day_and_address(spark):
    posts = spark.createDataFrame(
        [("d1", "a", 0, None, None, None), ("d2", "a", 0, None, None, None), ("d1", "b", 1, "old", 1, [9.0])],
        "file_day string, uri string, has_embedding int, emb_model string, emb_dims int, emb_vec array<float>",
    )
    vectors = spark.createDataFrame(
        [("d1", "a", [1.0, 2.0], "l", 1), ("d1", "a", [0.0, 1.0], "m", 2), ("d3", "a", [5.0], "m", 3)],
        "file_day string, uri string, emb_vec array<float>, emb_model string, n int",
    )
    filled = with_vectors(posts, vectors, F.col("n"))
    assert filled.columns == posts.columns
    assert sorted(tuple(r) for r in filled.collect()) == [
        ("d1", "a", 1, "m", 2, [0.0, 1.0]), ("d1", "b", 1, "old", 1, [9.0]), ("d2", "a", 0, None, None, None),
    ]
    again = with_vectors(filled, vectors, F.col("n"))
    assert sorted(map(str, again.collect())) == sorted(map(str, filled.collect()))


def test_posts_in_buckets_stay_where_they_lie(spark, folder):
    from feedloom.sources.tables import kept_by_key

    schema = "uri string, text string, embedding string, embedding_blob binary"
    posts = spark.createDataFrame([(f"u{i}", "t", None, None) for i in range(100)], schema)
    kept = kept_by_key(posts, folder + "/posts", buckets=16)
    vectors = spark.createDataFrame([(f"u{i}", bytearray(b"abcd")) for i in range(0, 400, 3)], "uri string, embedding_blob binary")
    joined = write_vectors(kept, vectors.hint("shuffle_merge"))
    assert joined.where("embedding = 'y'").count() == 34 and joined.count() == 100
    plan = joined._jdf.queryExecution().sparkPlan().toString()
    run = joined._jdf.queryExecution().executedPlan().toString()
    # Only the vectors are dealt by key.
    assert "Bucketed: true" in run and run.count("Exchange hashpartitioning(uri") <= 2, run
    assert spark.catalog.listTables() == [t for t in spark.catalog.listTables() if not t.name.startswith("feedloom_")]


def test_texts_of_posts_do_not_go_through_the_driver(spark):
    # Decoded texts are guessed small, so that the posts would be sent to all tasks for the few vectors.
    lines = spark.range(40).select(F.to_json(F.struct(F.col("id").cast("string").alias("did"))).alias("value"))
    read = F.from_json("value", "did STRING, record STRUCT<text STRING>")
    posts = lines.select(F.inline(F.array(F.struct(read.alias("m"))))).select(
        F.concat(F.lit("u"), "m.did").alias("uri"), F.col("m.record.text").alias("text"),
        F.lit(None).cast("string").alias("embedding"), F.lit(None).cast("binary").alias("embedding_blob"),
    )
    vectors = spark.range(0, 40, 4).select(F.concat(F.lit("u"), F.col("id").cast("string")).alias("uri"),
                                           F.lit(b"1234").alias("embedding_blob"))
    written = write_vectors(posts, vectors)
    filled = written.where("embedding_blob IS NOT NULL")
    assert filled.count() == 10 and written.count() == 40
    for df in (written, filled):
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Broadcast" not in plan, plan
