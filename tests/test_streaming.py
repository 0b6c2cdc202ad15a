import glob
import json
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from feedloom.functions.times import hour_key
from feedloom.operators.encode import hashed_words
from feedloom.operators.feed import flatten_posts, keep_posts, parse_messages
from feedloom.operators.search import search_text
from feedloom.session import run_folder, shared_folder
from feedloom.sources.commits import CommitLog
from feedloom.sources.feed import RecordedFoldersReader, kept_start, read_messages, saved_cursor, stream_feed
from feedloom.sources.growing_files import GrowingFilesReader, new_lines, stream_growing
from feedloom.sources.hour_files import (
    files_by_day,
    hour_states,
    read_lines,
    rows_per_file,
    stream_lines,
)
from feedloom.sources.files import file_system
from feedloom.streaming import older
from feedloom.streaming.embedding import embed_added, read_embeddings, start_embedding
from feedloom.streaming.landing import land, read_dead, read_hours, read_landed, start_landing, stream_landed
from feedloom.streaming.older import compact_older, read_older, start_older, store_older
from feedloom.streaming.posts import (
    append_layer, compact_posts, read_ledger, read_posts, read_rejects, start_posts,
)

HOUR = 3_600_000_000
DAY = 24 * HOUR
START = 1_704_067_200_000_000  # 2024-01-01T00 UTC


def message(number, time_us, text=None, **changes):
    record = {
        "text": text or f"some text number {number}", "createdAt": "2024-01-01T00:00:00Z", "langs": ["en"],
    }
    commit = {
        "operation": "create", "collection": "app.bsky.feed.post", "rkey": f"k{number}", "cid": "c",
        "record": record,
    }
    return json.dumps({"did": "d", "time_us": time_us, "kind": "commit", "commit": commit} | changes)


def post(number, time_us=START, **changes):
    line = {
        "kind": "post", "uri": f"at://d/app.bsky.feed.post/k{number}", "cid": "c", "did": "d",
        "rkey": f"k{number}", "created_at": "2024-01-01T00:00:00Z", "time_us": time_us,
        "text": f"some text number {number}", "langs": ["en"],
    }
    return json.dumps(line | changes)


def put(path, lines, mode="w"):
    path.parent.mkdir(parents=True, exist_ok=True)
    with open(path, mode) as out:
        out.write("".join(line + "\n" for line in lines))


def folder_of(number):
    """A recorder folder closed at the given hour after the start."""
    return f"in/taken_us={START + number * HOUR}/1.json"


def land_all(spark, tmp_path, start_us=1, name="bronze"):
    feed = stream_feed(spark, str(tmp_path / "in"), str(tmp_path / f"start-{name}"), start_us)
    start_landing(feed, str(tmp_path / name), str(tmp_path / f"ck-{name}"), every=None).awaitTermination()
    return str(tmp_path / name)


def keys(df):
    return sorted(r.uri.rsplit("/", 1)[1] for r in df.collect())


def landed_keys(spark, path, which="came"):
    uri = F.get_json_object("value", "$.uri").alias("uri")
    return keys(read_landed(spark, path, which).select(uri))


def test_late_messages_reach_their_own_hour(spark, tmp_path):
    put(tmp_path / folder_of(1), [message(1, START), message(2, START + 5 * HOUR)])
    bronze = land_all(spark, tmp_path)
    states = lambda: {r.hour[-2:]: (r.came, r.closed, r.is_open) for r in read_hours(spark, bronze).collect()}
    assert states() == {"00": (1, 1, False), "05": (1, 0, True)}
    assert landed_keys(spark, bronze, "closed") == ["k1"]
    put(tmp_path / folder_of(2), [message(3, START + 10), message(4, START + 9 * HOUR), message(5, 1)])
    counts = {r.hour: r["count"] for r in read_landed(spark, land_all(spark, tmp_path)).groupBy("hour").count().collect()}
    assert counts == {
        "2024-01-01T00": 2, "2024-01-01T05": 1, "2024-01-01T09": 1, "1970-01-01T00": 1,
    }
    # Hour 00 came back and was closed again; hour 05 was closed by the later hour 09.
    assert read_hours(spark, bronze).where("hour = '2024-01-01T00'").select("came", "closed", "is_open").first() == (2, 2, False)
    assert read_hours(spark, bronze).where("hour = '2024-01-01T05'").select("came", "closed", "is_open").first() == (1, 1, False)
    assert read_hours(spark, bronze).where("is_open").select("hour").collect() == [("2024-01-01T09",)]
    assert landed_keys(spark, bronze, "closed") == ["k1", "k2", "k3", "k5"]
    assert read_landed(spark, bronze, day="2024-01-01").count() == 4


def test_a_restart_repeats_nothing(spark, tmp_path):
    put(tmp_path / folder_of(1), [message(i, START + i) for i in range(10)])
    for _ in range(3):
        bronze = land_all(spark, tmp_path)
    assert read_landed(spark, bronze).count() == 10


def test_a_repeated_batch_replaces_its_own_folder(spark, tmp_path):
    put(tmp_path / folder_of(1), [message(i, START + i) for i in range(10)] + ["{bad"])
    messages = read_messages(spark, str(tmp_path / "in"))
    path = str(tmp_path / "bronze")
    for run, batch in (("r", 0), ("r", 0), ("r", 1), ("s", 0)):
        land(messages, path, run, batch)
    assert CommitLog(spark, path).last_version() == 2
    assert read_landed(spark, path).count() == 30 and read_dead(spark, path).count() == 3


def test_landed_posts_equal_the_batch_result(spark, tmp_path):
    texts = [message(i, START + i * HOUR) for i in range(30)] + ["{bad", message(99, "x")]
    put(tmp_path / folder_of(1), texts)
    lines = read_landed(spark, land_all(spark, tmp_path))
    fields = F.from_json("value", "uri STRING, time_us BIGINT, text STRING").alias("v")
    landed = lines.select("hour", fields).select("v.*", "hour")
    batch = flatten_posts(keep_posts(parse_messages(spark.read.text(str(tmp_path / "in")))))
    batch = batch.withColumn("hour", hour_key(F.col("time_us"))).select("uri", "time_us", "text", "hour")
    assert sorted(map(tuple, landed.collect())) == sorted(map(tuple, batch.collect()))


def test_resume_at_the_saved_cursor(spark, tmp_path):
    for hour in range(5):
        put(tmp_path / folder_of(hour + 1), [message(hour, START + hour * HOUR)])
    bronze = land_all(spark, tmp_path)
    times = F.get_json_object("value", "$.time_us").cast("bigint").alias("time_us")
    start = saved_cursor(read_landed(spark, bronze).select(times))
    assert start == START + 4 * HOUR
    put(tmp_path / folder_of(6), [message(7, START + 3 * HOUR), message(8, START + 5 * HOUR), message(9, "odd")])
    # From the cursor on, itself included: the last post comes again, and a merge takes it out.
    again = land_all(spark, tmp_path, start, "again")
    assert landed_keys(spark, again) == ["k4", "k8"]
    for cursor, folders in ((None, 6), (0, 6), (1, 6), (START + 4 * HOUR, 3), (START + 4 * HOUR + 120_000_000, 2)):
        read = read_messages(spark, str(tmp_path / "in"), cursor)
        assert read.count() == {None: 8, 0: 8, 1: 8}.get(cursor, 3 if cursor == START + 4 * HOUR else 2)
        assert files_read(read._jdf.queryExecution().sparkPlan()) == [folders]


def files_read(plan):
    """Numbers of files that the scans of a plan are left with."""
    leaves = plan.collectLeaves()
    found = []
    for i in range(leaves.size()):
        leaf = leaves.apply(i)
        if "FileSourceScan" in leaf.getClass().getSimpleName():
            found.append(leaf.selectedPartitions().totalNumberOfFiles())
    return found


def test_offsets_plan_only_folders_that_can_hold_later_messages(tmp_path):
    for hour in (1, 2, 3):
        put(tmp_path / folder_of(hour), ["x"])
    put(tmp_path / "in/notes/1.json", ["x"])
    reader = RecordedFoldersReader(str(tmp_path / "in"), START + 2 * HOUR)
    end = reader.latestOffset()
    assert end == {"time_us": START + 3 * HOUR + 1}
    names = lambda a, b: [n for p in reader.partitions(a, b) for n in p.names]
    assert names(reader.initialOffset(), end) == [f"taken_us={START + h * HOUR}" for h in (2, 3)]
    assert names(end, reader.latestOffset()) == []
    put(tmp_path / folder_of(4), ["x"])
    assert names(end, reader.latestOffset()) == [f"taken_us={START + 4 * HOUR}"]
    # A start ahead of all folders waits for it.
    assert RecordedFoldersReader(str(tmp_path / "in"), START + 9 * HOUR).latestOffset() == {"time_us": START + 9 * HOUR}
    assert RecordedFoldersReader(str(tmp_path / "none"), 5).latestOffset() == {"time_us": 5}


def test_without_a_cursor_only_later_folders_count(spark, tmp_path):
    put(tmp_path / folder_of(1), [message(1, START)])
    assert landed_keys(spark, land_all(spark, tmp_path, None)) == []
    put(tmp_path / folder_of(2), [message(2, START - HOUR)])
    assert landed_keys(spark, land_all(spark, tmp_path, None)) == ["k2"]
    empty = spark.createDataFrame([], "time_us BIGINT")
    zero = spark.createDataFrame([(0,)], "time_us BIGINT")
    assert saved_cursor(empty) is None and saved_cursor(zero) is None


def test_dead_letters_are_kept(spark, tmp_path):
    put(tmp_path / folder_of(1), [message(1, START), "{bad", message(2, START, kind="identity")])
    bronze = land_all(spark, tmp_path)
    assert [tuple(r) for r in read_dead(spark, bronze).collect()] == [("{bad", "json")]
    assert landed_keys(spark, bronze) == ["k1"]


def test_a_running_stream_stops_cleanly(spark, tmp_path):
    put(tmp_path / folder_of(1), [message(i, START + i) for i in range(5)])
    feed = stream_feed(spark, str(tmp_path / "in"), str(tmp_path / "start"), 1)
    query = start_landing(feed, str(tmp_path / "b"), str(tmp_path / "c"), every="100 milliseconds")
    query.processAllAvailable()
    put(tmp_path / folder_of(2), [message(9, START)])
    query.processAllAvailable()
    query.stop()
    assert read_landed(spark, str(tmp_path / "b")).count() == 6


def scans_and_decodes(df):
    """Text scans and JSON decodings in the plan of a DataFrame."""
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return plan.count("Relation ["), plan.count("from_json")


def test_a_batch_is_scanned_and_decoded_once(spark, tmp_path):
    from feedloom.streaming.landing import landed_rows
    from feedloom.streaming.posts import imported

    put(tmp_path / folder_of(1), [message(1, START), "{bad"])
    assert scans_and_decodes(landed_rows(read_messages(spark, str(tmp_path / "in")))) == (1, 1)
    put(tmp_path / "h/2024-01-01T00.ndjson", [post(1), "{half"])
    assert scans_and_decodes(imported(read_lines(spark, str(tmp_path / "h")))) == (1, 1)


def import_from(spark, lines, tmp_path, state="ckp"):
    start_posts(lines, str(tmp_path / "posts"), str(tmp_path / state), every=None).awaitTermination()
    return read_posts(spark, str(tmp_path / "posts"))


def test_posts_are_merged_over_batches(spark, tmp_path):
    put(tmp_path / "h/2024-01-01T00.ndjson", [post(1), post(2), post(1, text="edited", cid="c2")])
    import_from(spark, stream_lines(spark, str(tmp_path / "h")), tmp_path)
    put(tmp_path / "h/2024-01-01T01.ndjson", [post(2, text=None), post(3), "{half", post(4, did="")])
    put(tmp_path / "h/2024-01-02T01.ndjson", [post(1, START + DAY)])
    put(tmp_path / "h/notes.txt", [post(77)])
    merged = import_from(spark, stream_lines(spark, str(tmp_path / "h")), tmp_path)
    rows = {(r.file_day, r.rkey): r for r in merged.collect()}
    assert sorted(rows) == [
        ("2024-01-01", "k1"), ("2024-01-01", "k2"), ("2024-01-01", "k3"), ("2024-01-02", "k1"),
    ]
    assert rows[("2024-01-01", "k1")].text == "edited"
    assert rows[("2024-01-01", "k2")].text is None
    assert rows[("2024-01-01", "k2")].indexed_first < rows[("2024-01-01", "k2")].indexed_last
    rejects = sorted(r.reason for r in read_rejects(spark, str(tmp_path / "posts")).collect())
    assert rejects == ["did", "json"]


def test_an_open_file_is_read_when_it_is_closed(spark, tmp_path):
    put(tmp_path / "h/2024-01-01T00.ndjson", [post(9)])
    put(tmp_path / "h/2024-01-01T01.ndjson.part", [post(1)])
    assert keys(import_from(spark, stream_lines(spark, str(tmp_path / "h")), tmp_path)) == ["k9"]
    put(tmp_path / "h/2024-01-01T01.ndjson", [post(1), post(2), post(3)])
    merged = import_from(spark, stream_lines(spark, str(tmp_path / "h")), tmp_path)
    assert keys(merged) == ["k1", "k2", "k3", "k9"]


def test_the_last_line_of_a_file_wins(spark, tmp_path):
    put(tmp_path / "h/2024-01-01T00.ndjson", [post(1, text=f"v{i}", cid=f"c{i}") for i in range(500)])
    merged = import_from(spark, stream_lines(spark, str(tmp_path / "h")), tmp_path)
    assert [r.text for r in merged.collect()] == ["v499"]


def test_second_imports_and_compactions_change_nothing(spark, tmp_path):
    for hour in range(3):
        put(tmp_path / f"h/2024-01-01T0{hour}.ndjson", [post(i, START + hour, text=f"{hour}-{i}") for i in range(20)])
    content = lambda df: sorted(
        tuple(r) for r in df.drop("indexed_first", "indexed_last", "emb_vec").na.fill("-").collect()
    )
    posts = str(tmp_path / "posts")
    once = content(import_from(spark, stream_lines(spark, str(tmp_path / "h")), tmp_path))
    assert len(once) == 20
    for state in ("second", "third"):
        compact_posts(spark, posts)
        assert content(read_posts(spark, posts)) == once
        again = import_from(spark, stream_lines(spark, str(tmp_path / "h")), tmp_path, state)
        assert content(again) == once
    compact_posts(spark, posts)
    compact_posts(spark, posts)
    # Three layers and two older bases lie there; one base is read.
    assert len(glob.glob(f"{posts}/layers/run=*/batch=*")) == 3 and len(glob.glob(f"{posts}/base/id=*")) == 3
    state = CommitLog(spark, posts).latest()
    files = {os.path.dirname(name.split(":", 1)[1]).removeprefix("//") for name in read_posts(spark, posts).inputFiles()}
    (day, base), = state["bases"].items()
    assert files == {f"{posts}/base/id={base}/file_day={day}"} and state["layers"] == []
    ledger = {r.file: tuple(r)[1:] for r in read_ledger(spark, posts).collect()}
    assert ledger["2024-01-01T00.ndjson"] == (3, 60, 0, 0)


def test_compacted_days_are_read_as_they_lie(spark, tmp_path):
    put(tmp_path / "h/2024-01-01T00.ndjson", [post(1), post(2)])
    put(tmp_path / "h/2024-01-02T00.ndjson", [post(3, START + DAY)])
    posts = str(tmp_path / "posts")
    import_from(spark, stream_lines(spark, str(tmp_path / "h")), tmp_path)
    compact_posts(spark, posts)
    put(tmp_path / "h/2024-01-02T01.ndjson", [post(3, START + DAY, text=None), post(4, START + DAY)])
    merged = import_from(spark, stream_lines(spark, str(tmp_path / "h")), tmp_path)
    expected = {("2024-01-01", "k1", True), ("2024-01-01", "k2", True), ("2024-01-02", "k3", False),
                ("2024-01-02", "k4", True)}
    seen = lambda df: {(r.file_day, r.rkey, r.text is not None) for r in df.collect()}
    assert seen(merged) == expected
    # Of the first day the base is read, and no layer.
    first_day = merged.where("file_day = '2024-01-01'")
    assert sum(files_read(first_day._jdf.queryExecution().sparkPlan())) == 1
    compact_posts(spark, posts)
    assert seen(read_posts(spark, posts)) == expected
    assert len(set(CommitLog(spark, posts).latest()["bases"].values())) == 2


def test_a_layer_that_comes_during_a_compaction_stays(spark, tmp_path, monkeypatch):
    put(tmp_path / "h/2024-01-01T00.ndjson", [post(1)])
    posts, lines = str(tmp_path / "posts"), read_lines(spark, str(tmp_path / "h")).withColumn("indexed_at", F.lit(5).cast("long"))
    append_layer(lines, posts, "r", 0)
    commit = CommitLog.commit

    def late(log, change):
        monkeypatch.setattr(CommitLog, "commit", commit)
        put(tmp_path / "g/2024-01-01T01.ndjson", [post(2), "{bad"])
        other = read_lines(spark, str(tmp_path / "g")).withColumn("indexed_at", F.lit(6).cast("long"))
        for _ in range(2):  # the second is a repetition
            append_layer(other, posts, "r", 1)
        return commit(log, change)

    monkeypatch.setattr(CommitLog, "commit", late)
    compact_posts(spark, posts)
    assert keys(read_posts(spark, posts)) == ["k1", "k2"]
    state = CommitLog(spark, posts).latest()
    assert [part["folder"] for part in state["layers"]] == ["run=r/batch=000000000001"]
    assert read_rejects(spark, posts).count() == 1 and read_ledger(spark, posts).count() == 2


def test_commits_of_two_writers(spark, tmp_path):
    log, other = (CommitLog(spark, str(tmp_path / "t")) for _ in range(2))
    assert log.latest() == {} and log.last_version() == -1

    def change(state):
        if not state:
            other.commit(lambda s: {**s, "n": 10})
        return {**state, "n": state.get("n", 0) + 1}

    assert log.commit(change) == {"n": 11, "version": 1}
    assert log.commit(lambda s: None) == other.latest() == {"n": 11, "version": 1}
    assert [r.n for r in spark.read.json(str(tmp_path / "t/_log")).orderBy("version").collect()] == [10, 11]


def test_the_start_of_a_stream_is_settled_once(spark, tmp_path):
    put(tmp_path / folder_of(1), ["x"])
    source = str(tmp_path / "in")
    folder = str(tmp_path / "start")
    assert kept_start(spark, folder, source, START) == (START - 60_000_000, START)
    assert kept_start(spark, folder, source, 9) == kept_start(spark, folder, source) == (START - 60_000_000, START)
    assert kept_start(spark, str(tmp_path / "now"), source) == (START + HOUR + 1, None)


def older_run(spark, tmp_path):
    feed = stream_feed(spark, str(tmp_path / "in"), str(tmp_path / "start"), 1)
    start_older(feed, str(tmp_path / "old"), str(tmp_path / "cko"), every=None).awaitTermination()
    rows = read_older(spark, str(tmp_path / "old")).collect()
    assert len({r.uri for r in rows}) == len(rows)
    return {r.rkey: r.text for r in rows}


def test_the_older_table_keeps_first_arrivals(spark, tmp_path):
    put(tmp_path / folder_of(1), [message(1, START, "first"), message(1, START + 5, "second")])
    assert older_run(spark, tmp_path) == {"k1": "first"}
    put(tmp_path / folder_of(2), [message(1, START - 9, "late"), message(2, "odd", "other")])
    put(tmp_path / folder_of(3), [message(2, START, "again"), message(3, START, "new")])
    wanted = {"k1": "first", "k2": "other", "k3": "new"}
    assert older_run(spark, tmp_path) == wanted
    compact_older(spark, str(tmp_path / "old"))
    put(tmp_path / folder_of(4), [message(3, START, "no"), message(4, START, "yes")])
    assert older_run(spark, tmp_path) == wanted | {"k4": "yes"}
    assert len(CommitLog(spark, str(tmp_path / "old")).latest()["segments"]) == 2
    assert older_run(spark, tmp_path) == wanted | {"k4": "yes"}


def test_two_writers_of_the_older_table(spark, tmp_path, monkeypatch):
    put(tmp_path / folder_of(1), [message(1, START, "one"), message(2, START, "two")])
    messages, path = read_messages(spark, str(tmp_path / "in")), str(tmp_path / "old")
    append = older._append

    def race(rows, *rest):
        monkeypatch.setattr(older, "_append", append)
        store_older(messages, path, "other", 0)
        return append(rows, *rest)

    monkeypatch.setattr(older, "_append", race)
    store_older(messages, path, "mine", 0)
    store_older(messages, path, "mine", 0)
    assert keys(read_older(spark, path)) == ["k1", "k2"]
    assert CommitLog(spark, path).latest()["done"] == {"other": 0, "mine": 0}


def test_filters_miss_no_key():
    rng = np.random.default_rng(1)
    held, others = (rng.integers(-(2**63), 2**63 - 1, 5000) for _ in range(2))
    bits = older.bloom(held)
    assert older.may_hold(bits, held).all() and older.may_hold(bits, others).mean() < 0.03
    assert not older.may_hold(older.bloom(held[:0]), others).any()


def test_a_batch_of_new_addresses_meets_few_buckets(spark, tmp_path):
    put(tmp_path / folder_of(1), [message(i, START) for i in range(300)])
    path = str(tmp_path / "old")
    store_older(read_messages(spark, str(tmp_path / "in")), path, "r", 0)
    rows = spark.createDataFrame([(f"at://d/app.bsky.feed.post/k{i}",) for i in (*range(5), *range(1000, 1050))], "uri STRING")
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64("uri"), F.lit(older.BUCKETS)).cast("int"))
    segments = CommitLog(spark, path).latest()["segments"]
    new = older.new_rows(rows, path, segments, str(tmp_path / "draft"))
    assert keys(new) == sorted(f"k{i}" for i in range(1000, 1050))
    asked = spark.read.parquet(str(tmp_path / "draft"))
    assert 5 <= asked.count() <= 12


def test_a_day_is_read_from_its_folders(spark, tmp_path):
    put(tmp_path / "h/2024-01-01T00.ndjson", [post(1)])
    put(tmp_path / "h/2024-01-02T00.ndjson", [post(2, START + DAY)])
    merged = import_from(spark, stream_lines(spark, str(tmp_path / "h")), tmp_path)
    day = merged.where("file_day = '2024-01-02'")
    assert keys(day) == ["k2"]
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(file_day" in plan


def test_no_posts_yet(spark, tmp_path):
    assert read_posts(spark, str(tmp_path / "posts")).count() == 0
    assert read_rejects(spark, str(tmp_path / "posts")).count() == 0
    assert read_embeddings(spark, str(tmp_path / "posts")).count() == 0
    compact_posts(spark, str(tmp_path / "posts"))
    assert read_older(spark, str(tmp_path / "old")).count() == 0 and read_ledger(spark, str(tmp_path / "p")).count() == 0
    assert read_landed(spark, str(tmp_path / "l")).count() == read_dead(spark, str(tmp_path / "l")).count() == 0
    assert read_hours(spark, str(tmp_path / "l")).count() == 0


def test_hour_files_by_name(spark, tmp_path):
    for name in (
        "2024-01-02T03.ndjson", "2024-01-01T10.ndjson", "2024-01-01T02.ndjson.part", "2024-01-01T02.ndjson",
        "2024-01-0102.ndjson", "2024-01-01T02.ndjson.tmp", "x2024-01-01T02.ndjson", "2024-01-01T02/x.json",
    ):
        put(tmp_path / f"h/{name}", [post(1), post(2)])
    lines = read_lines(spark, str(tmp_path / "h"))
    assert lines.count() == 8
    names = lines.withColumn("file_name", F.substring_index("file_path", "/", -1))
    days = files_by_day(names).orderBy("file_day").collect()
    assert [(r.file_day, r.files) for r in days] == [
        ("2024-01-01", ["2024-01-01T02.ndjson", "2024-01-01T02.ndjson.part", "2024-01-01T10.ndjson"]),
        ("2024-01-02", ["2024-01-02T03.ndjson"]),
    ]
    assert {r.rows for r in rows_per_file(names).collect()} == {2}
    assert read_lines(spark, str(tmp_path / "h"), "2024-01-02").count() == 2
    states = {r.hour: (r.rows, r.closed) for r in hour_states(lines, "2024-01-01T10").collect()}
    assert states == {
        "2024-01-01T02": (4, True), "2024-01-01T10": (2, False), "2024-01-02T03": (2, True),
    }


def test_a_growing_file_is_read_on(spark, tmp_path):
    path = tmp_path / "h/2024-01-01T00.ndjson.part"
    put(path, [post(1), post(2)])
    lines = lambda: stream_growing(spark, str(tmp_path / "h"))
    assert keys(import_from(spark, lines(), tmp_path)) == ["k1", "k2"]
    put(path, [post(3)], "a")
    with open(path, "a") as out:
        out.write(post(4)[:30])  # a line that is still being written
    assert keys(import_from(spark, lines(), tmp_path)) == ["k1", "k2", "k3"]
    with open(path, "a") as out:
        out.write(post(4)[30:] + "\n")
    put(tmp_path / "h/2024-01-01T01.ndjson", [post(5)])
    assert keys(import_from(spark, lines(), tmp_path)) == ["k1", "k2", "k3", "k4", "k5"]
    assert keys(import_from(spark, lines(), tmp_path)) == ["k1", "k2", "k3", "k4", "k5"]
    assert read_rejects(spark, str(tmp_path / "posts")).count() == 0
    ledger = {r.file: tuple(r)[1:] for r in read_ledger(spark, str(tmp_path / "posts")).collect()}
    assert ledger == {"2024-01-01T00.ndjson.part": (3, 4, 0, 0), "2024-01-01T01.ndjson": (1, 1, 0, 0)}


def test_file_times_do_not_matter(spark, tmp_path):
    """Files with a time long ago, ahead of time, and a finished day that gets one more file."""
    lines = lambda: stream_growing(spark, str(tmp_path / "h"))
    first, ahead = tmp_path / "h/2024-01-01T00.ndjson", tmp_path / "h/2024-01-05T00.ndjson.part"
    put(first, [post(1)])
    put(ahead, [post(2)])
    os.utime(ahead, (4_000_000_000, 4_000_000_000))
    assert keys(import_from(spark, lines(), tmp_path)) == ["k1", "k2"]
    put(tmp_path / "h/2024-01-06T00.ndjson", [post(3)])
    put(tmp_path / "h/2024-01-07T00.ndjson.part", [post(4)])
    assert keys(import_from(spark, lines(), tmp_path)) == ["k1", "k2", "k3", "k4"]
    late = tmp_path / "h/2024-01-01T05.ndjson"
    put(late, [post(5)])
    put(first, [post(6)], "a")
    put(ahead, [post(7)], "a")
    for path in (late, first, ahead):
        os.utime(path, (1_000, 1_000))
    assert keys(import_from(spark, lines(), tmp_path)) == [f"k{i}" for i in range(1, 8)]


def planned(reader, start, end):
    return [(p.path, p.start, p.stop) for part in reader.partitions(start, end) for p in part.pieces]


def test_offsets_hold_running_days_and_marks(tmp_path):
    for day, name in enumerate(("01T00.ndjson", "02T00.ndjson", "03T00.ndjson", "04T00.ndjson.part", "01T03.txt"), 1):
        put(tmp_path / f"h/2024-01-{name}", ["abc"] * day)
    with open(tmp_path / "h/2024-01-02T00.ndjson", "a") as out:
        out.write("no line end")
    reader = GrowingFilesReader(str(tmp_path / "h"))
    first = reader.latestOffset()
    assert first["files"] == {"/2024-01-03T00.ndjson": 12, "/2024-01-04T00.ndjson.part": 16}
    assert list(first["days"]) == ["2024-01-01", "2024-01-02"]
    assert planned(reader, reader.initialOffset(), first) == [
        ("/2024-01-01T00.ndjson", 0, 4), ("/2024-01-02T00.ndjson", 0, 19),
        ("/2024-01-03T00.ndjson", 0, 12), ("/2024-01-04T00.ndjson.part", 0, 16),
    ]
    again = GrowingFilesReader(str(tmp_path / "h"))
    assert again.latestOffset() == first and planned(again, first, first) == []
    # A later day ends the third, of which only the rest is read; a late open file brings the first one back.
    with open(tmp_path / "h/2024-01-03T00.ndjson", "a") as out:
        out.write("rest")
    put(tmp_path / "h/2024-01-05T00.ndjson", ["x"])
    put(tmp_path / "h/2024-01-01T00.ndjson.part", ["late"])
    second = again.latestOffset()
    assert planned(again, first, second) == [
        ("/2024-01-01T00.ndjson", 0, 4), ("/2024-01-01T00.ndjson.part", 0, 5),
        ("/2024-01-03T00.ndjson", 12, 16), ("/2024-01-05T00.ndjson", 0, 2),
    ]
    # Closed under its name and ended: its day is read once more.
    os.rename(tmp_path / "h/2024-01-01T00.ndjson.part", tmp_path / "h/2024-01-01T01.ndjson")
    third = again.latestOffset()
    assert planned(again, second, third) == [("/2024-01-01T01.ndjson", 0, 5)]
    put(tmp_path / "h/2024-01-02T00.ndjson", ["short"])
    fourth = again.latestOffset()
    assert planned(again, third, fourth) == [("/2024-01-02T00.ndjson", 0, 6)]
    assert planned(again, fourth, again.latestOffset()) == []


@pytest.mark.parametrize("size", [1, 7, 50, 10_000])
def test_lines_between_two_positions(tmp_path, monkeypatch, size):
    from feedloom.sources import growing_files

    monkeypatch.setattr(growing_files, "READ_BYTES", size)
    lines = [f"{i}:" + "é" * (i * 7 % 60) for i in range(100)]
    path = tmp_path / "h/2024-01-01T00.ndjson"
    put(path, lines)
    files, _ = file_system(str(path))
    whole = path.stat().st_size
    cut = len("\n".join(lines[:40]).encode()) + 1
    got = [(p, v.decode()) for a, b in ((0, cut), (cut, whole)) for p, v in new_lines(files, str(path), a, b) if v]
    assert [v for _, v in got] == lines
    data = path.read_bytes()
    assert all(data[p:].startswith(v.encode()) for p, v in got)
    assert list(new_lines(files, str(path) + "x", 0, 5)) == []


def embed(spark, tmp_path):
    import_from(spark, stream_lines(spark, str(tmp_path / "h")), tmp_path)
    posts = str(tmp_path / "posts")
    start_embedding(spark, posts, str(tmp_path / "ckv"), every=None).awaitTermination()
    return read_embeddings(spark, posts)


@pytest.mark.parametrize("compacted", [False, True])
def test_embedding_stream_encodes_each_english_post_once(spark, tmp_path, compacted):
    put(tmp_path / "h/2024-01-01T00.ndjson", [post(1), post(2, langs=["de"]), post(3, text="short"), post(1)])
    posts = str(tmp_path / "posts")
    assert keys(embed(spark, tmp_path)) == ["k1"]
    first = read_posts(spark, posts).where("has_embedding = 1").first()
    assert (first.emb_model, first.emb_dims, len(first.emb_vec)) == ("words", 384, 384)
    if compacted:
        compact_posts(spark, posts)
        state = CommitLog(spark, posts).latest()
        assert state["layers"] == state["vectors"] == []
    put(tmp_path / "h/2024-01-01T01.ndjson", [post(1, text="edited long enough"), post(4)])
    table = embed(spark, tmp_path)
    assert keys(table) == ["k1", "k4"]
    # Two posts were encoded in all: the edited one keeps its vector.
    assert spark.read.parquet(f"{posts}/vectors").count() == 2
    found = search_text(table, table, "some text number 4", hashed_words(), 1).first()
    assert found.uri.endswith("/k4") and found.distance == 0.0


def test_a_layer_folded_before_it_was_encoded(spark, tmp_path):
    put(tmp_path / "h/2024-01-01T00.ndjson", [post(1), post(2)])
    import_from(spark, stream_lines(spark, str(tmp_path / "h")), tmp_path)
    posts = str(tmp_path / "posts")
    compact_posts(spark, posts)
    assert keys(embed(spark, tmp_path)) == ["k1", "k2"]
    compact_posts(spark, posts)
    assert keys(read_posts(spark, posts).where("has_embedding = 1")) == ["k1", "k2"]
    rows = spark.createDataFrame([(CommitLog(spark, posts).read(0)["added"],)], "a ARRAY<STRUCT<folder STRING, days ARRAY<STRING>>>")
    added = rows.select(F.inline("a")).collect()
    embed_added(spark, posts, added, "again", 0)
    assert spark.read.parquet(f"{posts}/vectors").count() == 2


def test_a_post_on_two_days_has_one_vector(spark, tmp_path):
    put(tmp_path / "h/2024-01-01T00.ndjson", [post(1)])
    put(tmp_path / "h/2024-01-02T00.ndjson", [post(1, START + DAY, text="edited long enough")])
    assert [r.text for r in embed(spark, tmp_path).collect()] == ["edited long enough"]


class Session:
    """Stands for a session with some settings."""

    def __init__(self, master, settings, checkpoints=None):
        self.settings, self.master, self.checkpoints = settings, master, checkpoints
        self.conf = self.sparkContext = self

    def get(self, name, default):
        return self.settings.get(name, default)

    def getCheckpointDir(self):
        return self.checkpoints

    def setCheckpointDir(self, folder):
        self.checkpoints = folder


def test_shared_folder_comes_from_the_session(tmp_path):
    cluster = Session("spark://host", {"spark.checkpoint.dir": "hdfs://x/shared/"})
    assert shared_folder(cluster) == "hdfs://x/shared"
    assert run_folder(cluster, "x").startswith("hdfs://x/shared/feedloom-x-")
    assert run_folder(cluster, "x") != run_folder(cluster, "x")
    with pytest.raises(RuntimeError):
        shared_folder(Session("spark://host", {}))
    local = Session("local[2]", {})
    assert shared_folder(local) == shared_folder(local) == local.checkpoints
    assert shared_folder(Session("local[2]", {}, str(tmp_path))) == str(tmp_path)


def test_recorded_and_landed_texts_are_packed_and_move_once(spark, tmp_path):
    from feedloom.plans import fixtures as fx

    rows = [(i, f"words of document {i} " * 200, "en" if i % 2 else "de", f"src{i % 3}", 0) for i in range(60)]
    documents = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT"
    spark.createDataFrame(rows, documents).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(3, 1, 0), (4, 0, 0)], "doc_id BIGINT, quality INT, toxic INT").write.parquet(str(tmp_path / "labels.parquet"))
    for edited in (False, True):
        made = fx.recorded(spark, str(tmp_path), edited)
        plain = fx.messages(spark, str(tmp_path), edited)
        assert sorted(made.collect()) == sorted(plain.collect())
    # Documents are dealt by folder before they become messages, and nothing moves once more for the write.
    fx.record(fx.recorded(spark, str(tmp_path)), str(tmp_path / "in"))
    bronze = land_all(spark, tmp_path)
    texts = sum(len(r.value) for r in fx.messages(spark, str(tmp_path)).collect())
    for place in ("in", "bronze"):
        files = [f for f in glob.glob(f"{tmp_path}/{place}/**/part-*", recursive=True) if os.path.isfile(f)]
        assert files and sum(map(os.path.getsize, files)) < texts / 4
    assert read_landed(spark, bronze).count() == keep_posts(parse_messages(fx.messages(spark, str(tmp_path)))).count()


def test_few_days_are_merged_and_written_with_one_shuffle(spark, tmp_path, monkeypatch):
    from feedloom.streaming import posts as table

    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    shuffles, write = {}, table.write_parts

    def seen(df, path, *parts):
        if parts:
            shuffles.setdefault(path.split("/")[-2 if "/base/" in path else -3], []).append(plan(df).count("Exchange"))
        write(df, path, *parts)

    monkeypatch.setattr(table, "write_parts", seen)
    posts, where = str(tmp_path / "posts"), str(tmp_path / "h")
    lines = lambda stamp: read_lines(spark, where).withColumn("indexed_at", F.lit(stamp).cast("long"))
    put(tmp_path / "h/2024-01-01T00.ndjson", [post(1), post(1, text="later"), post(2)])
    put(tmp_path / "h/2024-01-02T00.ndjson", [post(3, START + DAY)])
    append_layer(lines(5), posts, "r", 0)
    rows = sorted(tuple(r) for r in read_posts(spark, posts).drop("emb_vec").na.fill("-").collect())
    assert [(r[0], r[3], r[9]) for r in rows] == [
        ("2024-01-01", "k1", "later"), ("2024-01-01", "k2", "some text number 2"), ("2024-01-02", "k3", "some text number 3")]
    # Each day lies in one layer: it is read, and compacted, as it lies.
    assert "Exchange" not in plan(read_posts(spark, posts))
    compact_posts(spark, posts)
    assert shuffles == {"layers": [1], "base": [0]}
    assert sorted(tuple(r) for r in read_posts(spark, posts).drop("emb_vec").na.fill("-").collect()) == rows
    # A day that a layer touches again is merged, another is not.
    append_layer(lines(6).where("hour < '2024-01-02'"), posts, "r", 1)
    again = {r.rkey: (r.indexed_first, r.indexed_last, r.text) for r in read_posts(spark, posts).collect()}
    assert again == {"k1": (5, 6, "later"), "k2": (5, 6, "some text number 2"), "k3": (5, 5, "some text number 3")}
    compact_posts(spark, posts)
    assert shuffles == {"layers": [1, 1], "base": [0, 1]}
    # Of many days the rows are brought together, so that no task writes a file of each.
    for day in range(3, 13):
        put(tmp_path / f"h/2024-01-{day:02}T00.ndjson", [post(day + 10, START + (day - 1) * DAY)])
    append_layer(lines(7), posts, "r", 2)
    assert shuffles["layers"] == [1, 1, 2] and read_posts(spark, posts).count() == 13


@pytest.mark.parametrize("open_files", [64, 2])
def test_texts_are_written_without_a_sort(spark, tmp_path, open_files):
    from feedloom.sources.tables import OPEN_FILES, write_texts

    before = spark.conf.get(OPEN_FILES)
    rows = spark.range(500).select(F.col("id").cast("string").alias("value"), (F.col("id") % 7).alias("part")).coalesce(2)
    for _ in range(2):
        write_texts(rows, str(tmp_path / "texts"), "overwrite", "part", open_files=open_files)
    assert spark.conf.get(OPEN_FILES) == before
    got = sorted((int(r.value), int(r.part)) for r in spark.read.text(str(tmp_path / "texts")).collect())
    assert got == [(i, i % 7) for i in range(500)]
    # One file for each folder of a task, whether or not all of them can be open.
    assert len(glob.glob(f"{tmp_path}/texts/part=*/part-*.txt.gz")) == 14
