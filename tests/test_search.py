import numpy as np
import pytest
from pyspark.sql import functions as F

from feedloom.operators.encode import encode_texts, hashed_words, word_counts, word_vectors
from feedloom.operators.search import (
    nearest,
    search_text,
    search_vector,
    vector_shape,
    vector_table,
)
from feedloom.sources.tables import read_vectors, write_vectors_table

SCHEMA = "uri STRING, text STRING, embedding ARRAY<FLOAT>"


def vectors(count, dims=8, seed=0):
    return np.random.default_rng(seed).normal(size=(count, dims)).astype(np.float32)


def corpus(spark, matrix):
    rows = [(f"u{i:05d}", f"text {i}", [float(x) for x in v]) for i, v in enumerate(matrix)]
    return spark.createDataFrame(rows, SCHEMA).repartition(6)


def queries(spark, matrix):
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(matrix)]
    return spark.createDataFrame(rows, "query_id INT, embedding ARRAY<FLOAT>")


def expected(matrix, query, k):
    distance = ((matrix.astype(np.float64) - query.astype(np.float64)) ** 2).sum(axis=1)
    order = sorted(range(len(matrix)), key=lambda i: (distance[i], f"u{i:05d}"))[:k]
    return [(f"u{i:05d}", round(float(distance[i]), 6)) for i in order]


def found(df):
    return [(r.uri, round(r.distance, 6)) for r in df.collect()]


def test_one_query_equals_brute_force(spark):
    matrix = vectors(500)
    got = found(search_vector(corpus(spark, matrix), matrix[3].tolist(), 5))
    assert got == expected(matrix, matrix[3], 5)
    assert got[0] == ("u00003", 0.0)


@pytest.mark.parametrize("block_bytes", [1 << 20, 13 * 32, 1])
def test_many_queries_equal_brute_force(spark, block_bytes):
    matrix, asked = vectors(700), vectors(60 if block_bytes > 1 else 3, seed=1)
    df, q = corpus(spark, matrix), queries(spark, asked)
    got = nearest(df, q, 7, block_bytes=block_bytes)
    answers = {}
    for r in got.orderBy("query_id", "rank").collect():
        answers.setdefault(r.query_id, []).append((r.uri, round(r.distance, 6)))
    assert answers == {i: expected(matrix, v, 7) for i, v in enumerate(asked)}


def test_small_vectors_are_ranked_by_unrounded_distances(spark):
    matrix, asked = vectors(500, 16) * np.float32(1e-5), vectors(20, 16, seed=1) * np.float32(1e-5)
    df, q = corpus(spark, matrix), queries(spark, asked)
    names = lambda wanted: [u for u, _ in wanted]
    answers = {}
    for r in nearest(df, q, 5).orderBy("query_id", "rank").collect():
        answers.setdefault(r.query_id, []).append(r.uri)
    assert answers == {i: names(expected(matrix, v, 5)) for i, v in enumerate(asked)}
    assert names(found(search_vector(df, asked[0].tolist(), 5))) == answers[0]


def test_vectors_far_from_the_origin_are_ranked_by_differences(spark):
    # The matrix product alone cannot tell these distances apart.
    matrix = vectors(400).astype(np.float64) * 1e-3 + 1000
    matrix = matrix.astype(np.float32)
    got = [u for u, _ in found(nearest(corpus(spark, matrix), queries(spark, matrix[9:10]), 6).orderBy("rank"))]
    assert got == [u for u, _ in expected(matrix, matrix[9], 6)]


def test_copies_tie_by_key(spark):
    matrix = vectors(300)
    matrix[50:150] = matrix[7]  # a third of all rows are copies
    got = found(search_vector(corpus(spark, matrix), matrix[7].tolist(), 5))
    assert [u for u, _ in got] == ["u00007", "u00050", "u00051", "u00052", "u00053"]
    batch = nearest(corpus(spark, matrix), queries(spark, matrix[7:8]), 5).orderBy("rank")
    assert found(batch) == got


def test_many_copies_for_many_queries(spark):
    matrix, asked = vectors(900), vectors(40, seed=2)
    matrix[::3] = matrix[0]
    asked[::2] = matrix[0]
    df, q = corpus(spark, matrix), queries(spark, asked)
    wanted = {i: expected(matrix, v, 4) for i, v in enumerate(asked)}
    for got in (nearest(df, q, 4), nearest(df, q, 4, block_bytes=9 * 32)):
        answers = {}
        for r in got.orderBy("query_id", "rank").collect():
            answers.setdefault(r.query_id, []).append((r.uri, round(r.distance, 6)))
        assert answers == wanted


def test_fewer_rows_than_asked_for(spark):
    matrix = vectors(3)
    assert len(found(search_vector(corpus(spark, matrix), matrix[0].tolist(), 5))) == 3
    assert nearest(corpus(spark, matrix), queries(spark, matrix), 5).count() == 9
    assert nearest(corpus(spark, matrix), queries(spark, matrix), 5, block_bytes=32).count() == 9


def test_nothing_to_search(spark):
    matrix = vectors(4)
    assert nearest(corpus(spark, matrix).limit(0), queries(spark, matrix), 5).count() == 0
    assert nearest(corpus(spark, matrix), queries(spark, matrix).limit(0), 5).count() == 0
    assert nearest(corpus(spark, matrix).limit(0), queries(spark, matrix), 5, block_bytes=32).count() == 0
    assert search_vector(corpus(spark, matrix).limit(0), [0.0] * 8, 5).count() == 0


def test_vectors_that_do_not_fit_are_no_neighbours(spark):
    matrix = vectors(20)
    odd = spark.createDataFrame([("x", "t", [0.0] * 4), ("y", "t", None), ("z", "t", [])], SCHEMA)
    df = corpus(spark, matrix).unionByName(odd)
    asked = queries(spark, matrix[:3]).unionByName(
        spark.createDataFrame([(9, None), (8, [])], "query_id INT, embedding ARRAY<FLOAT>")
    )
    for got in (nearest(df, asked, 30), nearest(df, asked, 30, block_bytes=64)):
        counts = {r.query_id: r["count"] for r in got.groupBy("query_id").count().collect()}
        assert counts == {0: 20, 1: 20, 2: 20}
    assert search_vector(df, matrix[0].tolist(), 30).count() == 20
    mixed = spark.createDataFrame([(0, [1.0]), (1, [1.0, 2.0])], "query_id INT, embedding ARRAY<FLOAT>")
    with pytest.raises(ValueError):
        nearest(df, mixed, 2)


def test_single_search_sorts_no_more_than_k(spark, folder):
    write_vectors_table(corpus(spark, vectors(10)), folder + "/v")
    plan = search_vector(read_vectors(spark, folder + "/v"), [0.0] * 8, 5)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject(limit=5" in text and "Exchange" not in text


def test_batch_search_does_not_shuffle_the_corpus(spark):
    matrix = vectors(50)
    plan = nearest(corpus(spark, matrix), queries(spark, matrix), 2)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in text and "NestedLoop" not in text and "WindowGroupLimit" in text


def test_vector_table_takes_valid_vectors(spark, folder):
    rows = [("a", "t", [1.0, 2.0]), ("b", "t", None), ("c", "t", []), ("d", "t", [1.0])]
    df = spark.createDataFrame(rows, SCHEMA)
    assert {r.uri for r in vector_table(df).collect()} == {"a", "d"}
    assert {r.uri for r in vector_table(df, dims=2).collect()} == {"a"}
    shapes = {r.dims: r.vectors for r in vector_shape(vector_table(df)).collect()}
    assert shapes == {2: 1, 1: 1}
    write_vectors_table(vector_table(df), folder + "/v")
    assert read_vectors(spark, folder + "/v").count() == 2


def test_hashed_words():
    encode = hashed_words(64)
    matrix = encode(["a b a", "A  B\nA", "", "ünï"])
    assert matrix.shape == (4, 64) and matrix.dtype == np.float32
    assert (matrix[0] == matrix[1]).all() and not matrix[2].any()
    assert abs(np.linalg.norm(matrix[0]) - 1) < 1e-6 and abs(np.linalg.norm(matrix[3]) - 1) < 1e-6


def test_encoder_sees_whole_texts_in_batches(spark):
    rows = [(i, "w" * i if i != 5 else None) for i in range(300)]

    def lengths():
        def encode(texts):
            assert len(texts) <= 8
            return np.array([[len(t), len(texts) > 0] for t in texts], dtype=np.float32)

        return encode

    df = spark.createDataFrame(rows, "n INT, text STRING")
    got = {r.n: list(r.embedding) for r in encode_texts(df, "text", lengths, 8).collect()}
    assert got == {i: [float(i if i != 5 else 0), 1.0] for i in range(300)}
    assert encode_texts(df, "text", lengths, 8, keep=["n"]).columns == ["n", "embedding"]


def test_text_search(spark):
    texts = ["the cat sat", "a dog ran", "the cat ran", "birds"]
    df = spark.createDataFrame([(f"u{i}", t) for i, t in enumerate(texts)], "uri STRING, text STRING")
    got = search_text(encode_texts(df, keep=["uri"]), df, "  The cat sat\n", hashed_words(), 2).collect()
    assert [(r.uri, r.text) for r in got] == [("u0", "the cat sat"), ("u2", "the cat ran")]
    assert got[0].distance == 0.0 and got[1].distance == round(got[1].distance, 4) > 0


def test_texts_are_read_for_what_was_found(spark, folder):
    df = spark.createDataFrame([(f"u{i}", f"word {i}") for i in range(50)], "uri STRING, text STRING")
    df.write.parquet(folder + "/posts")
    posts = spark.read.parquet(folder + "/posts")
    found = search_text(encode_texts(posts, keep=["uri"]), posts, "word 7", hashed_words(), 3)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" not in plan and "PushedFilters: [In(uri" in plan
    assert "u7" in {r.uri for r in found.collect()} and found.count() == 3
    assert search_text(encode_texts(posts.limit(0), keep=["uri"]), posts, "x", hashed_words()).count() == 0


def test_queries_of_a_round_bound_what_is_held(spark):
    matrix = vectors(40)
    sizes = []
    broadcast = spark.sparkContext.broadcast

    def seen(value):
        sizes.append(len(value[1]))
        return broadcast(value)

    spark.sparkContext.broadcast = seen
    try:
        assert nearest(corpus(spark, matrix), queries(spark, matrix), 2, block_bytes=10 * 32).count() == 80
    finally:
        del spark.sparkContext.broadcast
    assert len(sizes) > 2 and sum(sizes) == 40 and max(sizes) < 25


def test_word_vectors_equal_the_encoder(spark):
    texts = ["a b a", "A  B\nA", "", None, " \t\x0b\f\r\n", "ünï\u00a0x é", "w " * 3000 + "z", " ".join(f"w{i % 97}" for i in range(5000))]
    df = spark.createDataFrame(list(enumerate(texts)), "n INT, text STRING")
    for dims in (1, 64, 384):
        wanted = hashed_words(dims)([t or "" for t in texts])
        found = df.select("n", word_vectors(F.col("text"), dims).alias("v"))
        for row in found.collect():
            assert np.array_equal(np.array(row.v, np.float32), wanted[row.n]), (dims, texts[row.n])
    counts = df.select(word_counts(F.col("text"), 7).alias("c")).collect()
    assert sum(c.n for c in counts[0].c) == 3 and counts[2].c == [] and counts[3].c is None
    plan = encode_texts(df, keep=["n"])._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "MapInArrow" not in plan


def test_a_task_holds_little_beside_its_queries(monkeypatch):
    import tracemalloc

    import pyarrow as pa

    from feedloom.operators import search

    matrix, asked = vectors(4000, 16), vectors(8000, 16, seed=1)
    keys = pa.array(np.arange(len(matrix)))
    lists = pa.FixedSizeListArray.from_arrays(pa.array(matrix.ravel()), 16).cast(pa.list_(pa.float32()))
    batches = [
        pa.RecordBatch.from_arrays([keys.slice(at, 1000), lists.slice(at, 1000)], ["key", "embedding"])
        for at in range(0, len(matrix), 1000)
    ]

    class Held:
        value = pa.array(np.arange(len(asked))), asked

    monkeypatch.setattr(search, "MATRIX_CELLS", 100_000)
    tracemalloc.start()
    try:
        (result,) = search._round(Held, 5)(iter(batches))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert result.num_rows == 5 * len(asked)
    assert peak < 12_000_000
    rows = result.to_pandas()
    for number in (0, 4321, 7999):
        distance = ((matrix.astype(np.float64) - asked[number].astype(np.float64)) ** 2).sum(axis=1)
        got = rows[rows["query"] == number].sort_values(["distance", "key"])["key"].tolist()
        assert got == np.argsort(distance, kind="stable")[:5].tolist()


def test_a_vector_that_is_no_number_hides_no_others(spark):
    matrix = vectors(50)
    spoiled = spark.createDataFrame([("zz", "t", [float("nan")] * 8)], SCHEMA)
    df = corpus(spark, matrix).unionByName(spoiled).coalesce(1)
    got = found(nearest(df, queries(spark, matrix[:1]), 5).orderBy("rank"))
    assert got == expected(matrix, matrix[0], 5)
