import json

from pyspark.sql import functions as F

from feedloom.operators.importing import parse_lines, rejected_lines, valid_posts

LINE = {
    "kind": "post", "uri": "at://d/app.bsky.feed.post/k", "cid": "c", "did": "d", "rkey": "k",
    "created_at": "2024-01-02T03:04:05Z", "time_us": 7, "text": "t", "reply_parent": None,
    "reply_root": None, "quote_uri": "q", "langs": ["en"],
}


def line(**changes):
    return json.dumps({k: v for k, v in (LINE | changes).items() if v != "DROP"})


def outcomes(spark, *texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i INT, value STRING")
    return [r.outcome for r in parse_lines(df).orderBy("i").collect()]


def posts(spark, *texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i INT, value STRING")
    rows = valid_posts(parse_lines(df), F.lit(99), F.lit("2024-01-02"), F.col("i"))
    return rows.orderBy("arrival").collect()


def test_outcomes(spark):
    assert outcomes(
        spark, line(), line(kind="like"), line(uri="DROP"), line(uri=None), line(uri=""), line(did=""),
        line(did="DROP", repo="r"), line(rkey=None), line(created_at=""), line(time_us=0),
        line(time_us="DROP"), line(time_us="abc"), line(time_us="12"), "{half", line(rkey=0),
        line(rkey="0"), line(time_us="0"), line(created_at=False), "[1]", line() + line(),
    ) == [
        "post", "ignored", "ignored", "uri", "uri", "did", "did", "rkey", "created_at", "time_us",
        "time_us", "time_us", "post", "json", "rkey", "post", "post", "created_at",
        "json", "json",
    ]


def test_rejects_carry_the_line_and_the_reason(spark):
    texts = [line(), line(kind="like"), line(did=None), "{half"]
    df = spark.createDataFrame([(t,) for t in texts], "value STRING")
    got = {(r.value, r.reason) for r in rejected_lines(parse_lines(df)).collect()}
    assert got == {(texts[2], "did"), ("{half", "json")}


def test_post_columns(spark):
    (post,) = posts(spark, line())
    row = post.asDict()
    assert row == {
        "file_day": "2024-01-02", "uri": LINE["uri"], "author_did": "d", "rkey": "k", "cid": "c",
        "created_at": LINE["created_at"], "time_us": 7, "indexed_first": 99, "indexed_last": 99,
        "text": "t", "reply_parent": None, "reply_root": None, "quote_uri": "q",
        "langs_json": '["en"]', "lang_en": 1, "has_embedding": 0, "is_reply": 0, "is_quote": 1,
        "created_day": "2024-01-02", "created_hour": "2024-01-02T03", "emb_model": None,
        "emb_dims": None, "emb_vec": None, "arrival": 0,
    }


def test_language_list_is_ascii(spark):
    forms = [["é", "en"], ["日本"], ["😀"], ['a"b\\']]
    rows = posts(spark, *[line(langs=f) for f in forms])
    assert [r.langs_json for r in rows] == [json.dumps(f, separators=(",", ":")) for f in forms]


def test_languages_of_lines(spark):
    forms = [["de", "en"], ["en-US"], [], "en", "", None, "DROP"]
    rows = posts(spark, *[line(langs=f) for f in forms])
    assert [r.langs_json for r in rows] == ['["de","en"]', '["en-US"]', "[]", '["en"]', "[]", "[]", "[]"]
    assert [r.lang_en for r in rows] == [1, 0, 0, 1, 0, 0, 0]
