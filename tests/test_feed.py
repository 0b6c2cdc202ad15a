import json

from pyspark.sql import functions as F

from feedloom.operators.feed import (
    dead_letters,
    flatten_posts,
    keep_posts,
    keep_posts_legacy,
    legacy_posts,
    parse_messages,
    verdict,
    verdict_legacy,
)
from feedloom.sources.feed import from_cursor

DROP = object()


def message(**changes):
    """A good message with some parts replaced; ``commit`` and ``record`` change inner parts."""
    record = {"text": "hello world", "createdAt": "2024-01-02T03:04:05Z", "langs": ["en"]}
    record = record | changes.pop("record", {}) if isinstance(changes.get("record", {}), dict) else changes.pop("record")
    commit = {
        "operation": "create", "collection": "app.bsky.feed.post", "rkey": "k1", "cid": "c1",
        "record": record,
    }
    commit |= changes.pop("commit", {})
    whole = {"did": "did:1", "time_us": 5, "kind": "commit", "commit": commit} | changes
    clean = lambda d: {k: clean(v) if isinstance(v, dict) else v for k, v in d.items() if v is not DROP}
    return json.dumps(clean(whole))


def parsed(spark, texts):
    rows = [(i, t) for i, t in enumerate(texts)]
    return parse_messages(spark.createDataFrame(rows, "i INT, value STRING"))


def verdicts(spark, texts):
    df = parsed(spark, texts).select("i", verdict().alias("v")).orderBy("i")
    return [r.v for r in df.collect()]


def flat(spark, *texts):
    df = flatten_posts(keep_posts(parsed(spark, texts)), "i").orderBy("i").drop("i")
    return [r.asDict() for r in df.collect()]


def test_verdict_of_event_time(spark):
    good = [message(), message(time_us=-3), message(time_us=0)]
    bad = [
        message(time_us=DROP), message(time_us=None), message(time_us="12"), message(time_us=1.5),
        message(time_us=12.0), message(time_us=True),
    ]
    assert verdicts(spark, good) == ["post"] * len(good)
    assert verdicts(spark, bad) == ["skip"] * len(bad)


def test_verdict_of_other_events(spark):
    others = [
        message(kind="identity"), message(kind=DROP), message(commit={"operation": "delete"}),
        message(commit={"operation": DROP}), message(commit={"collection": "app.bsky.feed.like"}),
    ]
    assert verdicts(spark, others) == ["skip"] * len(others)


def test_verdict_of_records(spark):
    empty = [message(commit={"record": r}) for r in ({}, None, DROP, "", [], 0, False)]
    assert verdicts(spark, empty) == ["skip"] * len(empty)
    odd = [message(commit={"record": r}) for r in ("text", [1], 5, True)]
    assert verdicts(spark, odd) == ["dead:record"] * len(odd)
    filled = [message(commit={"record": r}) for r in ({"a": 1}, {"text": None}, {"langs": []})]
    assert verdicts(spark, filled) == ["post"] * len(filled)


def test_verdict_of_broken_messages(spark):
    broken = [
        "{bad", "", "[1]", '"text"', message()[:40],
        '{"time_us":5,"kind":"commit","commit":null}', '{"time_us":5,"kind":"commit","commit":"x"}',
        '{"time_us":5,"kind":"commit"}', message(commit={"rkey": DROP}),
        message() + message(), message() + " " + message(), message() + " x",
    ]
    assert verdicts(spark, broken) == [
        "dead:json", "dead:json", "dead:message", "dead:message", "dead:json",
        "dead:commit", "dead:commit", "skip", "dead:rkey", "dead:json", "dead:json", "dead:json",
    ]
    letters = dead_letters(parsed(spark, broken))
    assert letters.count() == 11
    assert {r.reason for r in letters.collect()} == {"json", "message", "commit", "rkey"}


def test_more_than_one_value_is_broken(spark):
    one = message()
    texts = [
        one + "," + one, one + "\t" + one, one + "  " + one, one + " junk}", one + "}", one + "],[" + one, one + "]x",
        one + "}, {" + one, one + "}{", one + " ", " " + one,
    ]
    assert verdicts(spark, texts) == ["dead:json"] * 9 + ["post"] * 2


def test_every_message_has_one_fate(spark):
    texts = [message(), message(kind="x"), "{", message(commit={"rkey": DROP})]
    df = parsed(spark, texts)
    fates = df.select(F.substring_index(verdict(), ":", 1).alias("fate")).groupBy("fate").count()
    assert {r.fate: r["count"] for r in fates.collect()} == {"post": 1, "skip": 1, "dead": 2}


def test_flat_post(spark):
    (post,) = flat(spark, message())
    assert post == {
        "kind": "post", "uri": "at://did:1/app.bsky.feed.post/k1", "cid": "c1", "did": "did:1",
        "rkey": "k1", "created_at": "2024-01-02T03:04:05Z", "time_us": 5, "text": "hello world",
        "reply_parent": None, "reply_root": None, "quote_uri": None, "langs": ["en"],
    }


def test_author_falls_back_to_repo(spark):
    posts = flat(
        spark, message(did="", repo="r"), message(did=DROP, repo="r"), message(did=None),
    )
    assert [p["did"] for p in posts] == ["r", "r", None]
    assert posts[2]["uri"] == "at://None/app.bsky.feed.post/k1"


def test_missing_and_null_text_differ(spark):
    posts = flat(
        spark, message(record={"text": DROP}), message(record={"text": None}),
        message(record={"createdAt": DROP}), message(record={"createdAt": None}),
    )
    assert [p["text"] for p in posts] == ["", None, "hello world", "hello world"]
    assert [p["created_at"] for p in posts][2:] == ["", None]


def test_languages(spark):
    forms = [["en", "de"], "en", "", None, DROP, [], ["en-US"]]
    posts = flat(spark, *[message(record={"langs": f}) for f in forms])
    assert [p["langs"] for p in posts] == [["en", "de"], ["en"], [""], [], [], [], ["en-US"]]


def test_reply_pointers(spark):
    forms = [
        {"parent": {"uri": "p"}, "root": {"uri": "r"}}, {"parent": {"uri": "p"}}, {"parent": None},
        {}, None,
    ]
    posts = flat(spark, *[message(record={"reply": f}) for f in forms])
    assert [(p["reply_parent"], p["reply_root"]) for p in posts] == [
        ("p", "r"), ("p", None), (None, None), (None, None), (None, None),
    ]


def test_quote_pointers(spark):
    record = "app.bsky.embed.record"
    forms = [
        {"$type": record, "record": {"uri": "q"}}, {"$type": record + "#view", "record": {"uri": "q"}},
        {"$type": record + "WithMedia", "record": {"uri": "q"}}, {"$type": record, "record": "q"},
        {"$type": record}, {"$type": record, "record": {}}, {"record": {"uri": "q"}}, None,
    ]
    posts = flat(spark, *[message(record={"embed": f}) for f in forms])
    assert [p["quote_uri"] for p in posts] == ["q", "q"] + [None] * 6


def test_odd_but_valid_messages_are_kept(spark):
    braces = message(record={"text": 'a }{ b } { "c" },{'})
    spaced = message() + " \r"
    unknown = message(record={"facets": [{"a": 1}, {"b": 2}], "reply": "x", "embed": [1]}, extra={"a": {}})
    twice = message()[:-1] + ', "did": "did:2"}'
    posts = flat(spark, braces, spaced, unknown, twice)
    assert [p["text"] for p in posts] == ['a }{ b } { "c" },{'] + ["hello world"] * 3
    assert [p["did"] for p in posts] == ["did:1"] * 3 + ["did:2"]
    assert posts[2]["reply_parent"] is None and posts[2]["quote_uri"] is None


def test_older_selection_does_not_look_at_the_time(spark):
    texts = [message(time_us="12"), message(time_us=DROP), message(commit={"record": {}}), message(kind="x")]
    kept = keep_posts_legacy(parsed(spark, texts)).select("i").collect()
    assert sorted(r.i for r in kept) == [0, 1]


def test_older_posts_without_author_or_key_are_dead(spark):
    texts = [
        message(), message(commit={"rkey": DROP}), message(time_us="12", commit={"rkey": None}),
        message(did=None), message(did=DROP), message(kind="x", did=DROP), "{bad", "[1]",
    ]
    messages = parsed(spark, texts)
    kept = [r.i for r in keep_posts_legacy(messages).collect()]
    dead = dead_letters(messages.withColumn("value", F.col("i").cast("string")), outcome=verdict_legacy())
    assert kept == [0]
    assert sorted((int(r.value), r.reason) for r in dead.collect()) == [
        (1, "rkey"), (2, "rkey"), (3, "did"), (4, "did"), (6, "json"), (7, "message"),
    ]


def test_older_rows(spark):
    texts = [
        message(), message(record={"langs": "en"}), message(record={"langs": DROP}),
        message(record={"langs": ["en", "de"]}), message(record={"createdAt": ""}),
        message(record={"createdAt": "2023-12-31T23:30:00-05:00"}),
    ]
    rows = legacy_posts(keep_posts_legacy(parsed(spark, texts)), "i").orderBy("i").collect()
    assert [r.i for r in rows] == [0, 1, 2, 3, 5]
    assert [r.langs for r in rows] == ["en", "en", None, "en,de", "en"]
    assert (rows[4].created_date, rows[4].created_hour) == ("2023-12-31", 23)
    assert rows[0].embedding is None and rows[0].embedding_blob is None and rows[0].raw_json is None


def test_cursor_starts_at_its_event_time_and_keeps_the_unreadable(spark):
    texts = [message(time_us=t) for t in (1, 2, 3)] + ["{bad"]
    kept = from_cursor(parsed(spark, texts), 2).select("i").collect()
    assert sorted(r.i for r in kept) == [1, 2, 3]


def test_a_message_is_decoded_once(spark, folder):
    spark.createDataFrame([(message(),)], "value STRING").write.text(folder + "/m")
    df = flatten_posts(keep_posts(parse_messages(spark.read.text(folder + "/m"))))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json(") == 1
