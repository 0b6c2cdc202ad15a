"""Registered queries: each takes a session and a table folder and returns a DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.functions.codec import pack_vector, unpack_vector
from feedloom.functions.text import embed_text
from feedloom.functions.times import hour_key
from feedloom.operators.consolidate import consolidate, stale_days
from feedloom.operators.encode import encode_texts, hashed_words
from feedloom.operators.export import export_rows, hour_grid, with_chunk, write_chunks
from feedloom.operators.feed import (
    dead_letters,
    flatten_posts,
    keep_posts,
    keep_posts_legacy,
    parse_messages,
    verdict,
)
from feedloom.operators.importing import parse_lines, rejected_lines
from feedloom.operators.legacy import legacy_view
from feedloom.operators.merge import first_per_key, insert_or_ignore, merge_posts, write_vectors
from feedloom.operators.pending import embedding_queue, without_vector
from feedloom.operators.search import (
    nearest,
    search_text,
    search_vector,
    squared_distance,
    vector_shape,
    vector_table,
)
from feedloom.plans import fixtures as fx
from feedloom.session import run_folder
from feedloom.sources.feed import from_cursor, saved_cursor, stream_feed
from feedloom.sources.growing_files import stream_growing
from feedloom.sources.hour_files import (
    cursor,
    files_by_day,
    hour_states,
    read_lines,
    rows_per_file,
)
from feedloom.sources.tables import (
    count_by_date,
    describe,
    kept_by_key,
    query_file,
    list_files,
    read_export,
    read_export_files,
    read_vectors,
    table_names,
    write_vectors_table,
)
from feedloom.streaming.embedding import read_embeddings, start_embedding
from feedloom.streaming.landing import read_dead, read_hours, read_landed, start_landing, stream_landed
from feedloom.streaming.older import read_older, start_older
from feedloom.streaming.posts import compact_posts, read_ledger, read_posts, start_posts

Query = Callable[[SparkSession, str], DataFrame]

QUEUE_ROWS = 100
CHUNK_ROWS = 8
EXPORT_END = "2024-01-05"
GRID_END = "2024-01-31"
AS_OF_HOUR = "2024-01-15T12"
LANDED_DAY = "2024-01-03"
FIRST_DAY_END = 1_704_153_600_000_000
MIDDLE_HOUR = "2024-01-03T12"
LATE_HOUR, AHEAD_HOUR = "T05", "T04"
FLAT_COLUMNS = (
    "kind", "uri", "cid", "did", "rkey", "created_at", "time_us", "text",
    "reply_parent", "reply_root", "quote_uri",
)
POST_COLUMNS = (
    "file_day", "uri", "author_did", "rkey", "cid", "created_at", "time_us", "text",
    "reply_parent", "reply_root", "quote_uri", "langs_json", "lang_en", "has_embedding",
    "is_reply", "is_quote", "created_day", "created_hour",
)


def _rounded(df: DataFrame, *names: str, digits: int = 4) -> DataFrame:
    return df.withColumns({n: F.round(n, digits) for n in names})


# --- vectors ---


def knn_top5(spark: SparkSession, sf_dir: str) -> DataFrame:
    corpus = fx.table(spark, sf_dir, "embeddings")
    query = corpus.where("vec_id = 0").select("embedding").first().embedding
    found = search_vector(corpus, query, 5, "vec_id").select("vec_id", "label", "distance")
    return _rounded(found, "distance")


def vector_distances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distance of every vector to the first one."""
    corpus = fx.table(spark, sf_dir, "embeddings")
    query = corpus.where("vec_id = 0").select("embedding").first().embedding
    distance = squared_distance(F.col("embedding"), query)
    return corpus.select("vec_id", F.round(distance, 4).alias("distance"))


def _self_queries(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    corpus = fx.table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return corpus, corpus.select(F.col("vec_id").alias("query_id"), "embedding")


def knn_batch_top5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five nearest vectors of every vector."""
    corpus, queries = _self_queries(spark, sf_dir)
    return _rounded(nearest(corpus, queries, 5, "vec_id"), "distance")


def knn_small_top5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same on vectors so small that all distances are below 1e-9."""
    corpus, queries = _self_queries(spark, sf_dir)
    small = F.transform("embedding", lambda x: (x.cast("double") * 1e-5).cast("float"))
    found = nearest(
        corpus.withColumn("embedding", small), queries.withColumn("embedding", small), 5, "vec_id"
    )
    return _rounded(found.withColumn("distance", F.col("distance") * 1e10), "distance")


def knn_blocked_top5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same in several rounds of queries."""
    corpus, queries = _self_queries(spark, sf_dir)
    return _rounded(nearest(corpus, queries, 5, "vec_id", block_bytes=1 << 19), "distance")


def vector_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_shape(fx.table(spark, sf_dir, "embeddings"))


def vector_blob_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = fx.table(spark, sf_dir, "embeddings")
    packed = vectors.select("vec_id", "embedding", pack_vector("embedding").alias("blob"))
    back = packed.select("*", unpack_vector("blob").alias("back"))
    total = F.aggregate("back", F.lit(0.0), lambda a, x: a + x.cast("double"))
    return back.select(
        "vec_id",
        F.length("blob").alias("bytes"),
        F.size("back").alias("dims"),
        (F.col("back") == F.col("embedding")).alias("same"),
        F.round(total, 6).alias("total"),
    )


def vector_table_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Searchable rows from posts with packed vectors."""
    posts = fx.posts_with_vectors(spark, sf_dir).select(
        "uri", "text", unpack_vector("embedding_blob").alias("embedding")
    )
    return vector_table(posts, dims=64).select("uri", "text", F.size("embedding").alias("dims"))


# --- feed ---


def _messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_messages(fx.messages(spark, sf_dir))


def feed_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keep_posts(_messages(spark, sf_dir)).select("doc_id")


def feed_filter_legacy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keep_posts_legacy(_messages(spark, sf_dir)).select("doc_id")


def feed_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.flat_posts(spark, sf_dir).select(
        *FLAT_COLUMNS, F.to_json("langs").alias("langs_json")
    )


def _ends(value: Column) -> dict[str, Column]:
    """What may follow a message on its line, where only one value may stand."""
    return {
        "comma": F.concat(F.lit(","), value),
        "tab": F.concat(F.lit("\t"), value),
        "blanks": F.concat(F.lit("  "), value),
        "junk": F.lit(" junk}"),
        "brace": F.lit("}"),
        "bracket": F.concat(F.lit("],["), value),
    }


def _damaged(messages: DataFrame) -> DataFrame:
    """Every message as it is, cut in half, without a record key, with a null commit, and with more on its line."""
    value = F.col("value")
    half = F.substr(value, F.lit(1), F.floor(F.length(value) / 2).cast("int"))
    no_key = F.replace(value, F.lit('"rkey":'), F.lit('"rk":'))
    no_commit = F.concat(F.substring_index(value, ',"commit":', 1), F.lit(',"commit":null}'))
    forms = {"whole": value, "half": half, "no_key": no_key, "no_commit": no_commit}
    forms |= {name: F.concat(value, end) for name, end in _ends(value).items()}
    shaped = F.array(*[F.struct(F.lit(n).alias("form"), v.alias("value")) for n, v in forms.items()])
    return messages.select("time_us", F.inline(shaped))


def feed_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    damaged = parse_messages(_damaged(fx.messages(spark, sf_dir)))
    return damaged.groupBy("form", verdict().alias("verdict")).agg(F.count("*").alias("n"))


def feed_from_cursor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posts from the highest event time of the English part of the feed on."""
    all_messages = _messages(spark, sf_dir)
    landed = flatten_posts(keep_posts(all_messages.where("lang = 'en'")))
    later = from_cursor(all_messages, saved_cursor(landed))
    return keep_posts(later).select("doc_id")


def hour_key_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    hour = hour_key(F.col("time_us")).alias("hour")
    return fx.event_times(spark, sf_dir).groupBy(hour).agg(F.count("*").alias("n"))


def cursor_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cursor(fx.event_times(spark, sf_dir))


def hour_closed(spark: SparkSession, sf_dir: str) -> DataFrame:
    hours = fx.event_times(spark, sf_dir).select(hour_key(F.col("time_us")).alias("hour"))
    return hour_states(hours, AS_OF_HOUR)


# --- import and merge ---


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.post_lines(fx.flat_posts(spark, sf_dir))


def import_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.import_run(_lines(spark, sf_dir), 1).select(*POST_COLUMNS)


def import_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of whole posts, of posts that lack one field each, and lines with more than a post."""
    value = F.col("value")
    gaps = ("uri", "did", "rkey", "created_at", "time_us")
    without = [
        F.regexp_replace(value, f'"{name}":("[^"]*"|[0-9]+)', f'"{name}":""') for name in gaps
    ]
    longer = [F.concat(value, end) for end in _ends(value).values()]
    forms = F.array(*[F.struct(v.alias("value")) for v in (value, *without, *longer)])
    kept = rejected_lines(parse_lines(_lines(spark, sf_dir).select(F.inline(forms))))
    return kept.select(F.regexp_extract("value", '"cid":"([^"]*)"', 1).alias("cid"), "reason")


def _hour_files(spark: SparkSession, sf_dir: str, name: str) -> str:
    """The feed in open hour files, and the hours of the first day once more in closed ones."""
    folder = run_folder(spark, name)
    posts = fx.flat_posts(spark, sf_dir).withColumn("order", F.col("rkey"))
    fx.grow_hour_files(posts, folder)
    fx.grow_hour_files(posts.where(F.col("time_us") < FIRST_DAY_END), folder, ".ndjson")
    return folder


def file_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = list_files(spark, _hour_files(spark, sf_dir, "groups"))
    names = files.select(F.substring_index("path", "/", -1).alias("file_name"))
    return files_by_day(names).select(
        "file_day", F.size("files").alias("n"), F.array_join("files", ",").alias("files")
    )


def file_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = read_lines(spark, _hour_files(spark, sf_dir, "rows"))
    return rows_per_file(lines.withColumn("file_name", F.substring_index("file_path", "/", -1)))


def _merged_view(merged: DataFrame) -> DataFrame:
    return merged.select(
        *POST_COLUMNS, "indexed_first", "indexed_last", "emb_model", "emb_dims",
        F.get("emb_vec", F.lit(0)).cast("double").alias("emb_first"),
    )


def posts_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = fx.import_runs(spark, sf_dir)
    return _merged_view(merge_posts(reduce(DataFrame.unionByName, runs)))


def posts_upsert_layers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same in steps: the first two runs merged, then the third merged into the result."""
    first, second, third = fx.import_runs(spark, sf_dir)
    base = merge_posts(first.unionByName(second)).withColumn("arrival", F.lit(0))
    return _merged_view(merge_posts(base.unionByName(third)))


def posts_first_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edited posts are there already; then all posts come, and the toxic ones once more."""
    first, second, third = fx.import_runs(spark, sf_dir)
    existing = second.select("uri", "text", "time_us")
    new = first.unionByName(third)
    merged = insert_or_ignore(existing, new, F.col("arrival"))
    return merged.select("uri", "text", "time_us")


def posts_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One post per author and language: the one with the lowest event time, then address."""
    posts = fx.flat_posts(spark, sf_dir).withColumn(
        "spot", F.concat_ws("|", "did", F.to_json("langs"))
    )
    order = F.struct("time_us", "uri")
    return first_per_key(posts, "spot", order).select("spot", "uri", "time_us", "text")


def posts_legacy_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.older_posts(spark, sf_dir).select(
        "uri", "repo", "rkey", "created_at", "created_date", "created_hour", "text", "langs"
    )


def posts_legacy_from_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The merged table seen in the older shape."""
    merged = merge_posts(reduce(DataFrame.unionByName, fx.import_runs(spark, sf_dir)))
    return legacy_view(merged).select(
        "uri", "repo", "created_date", "created_hour", "text", "langs", "embedding",
        F.length("embedding_blob").alias("bytes"),
    )


# --- vectors for posts ---


def _waiting(spark: SparkSession, sf_dir: str) -> DataFrame:
    posts = fx.older_posts(spark, sf_dir)
    return without_vector(posts, fx.document_vectors(spark, sf_dir))


def pending_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    queue = embedding_queue(_waiting(spark, sf_dir), QUEUE_ROWS)
    return queue.select("uri", "created_date", "created_hour", "text")


def pending_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every pending post."""
    queue = embedding_queue(_waiting(spark, sf_dir))
    return queue.select("uri", "created_date", "created_hour", "text")


def embed_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the encoder is given of every document: its whole text."""
    documents = fx.documents(spark, sf_dir)
    return documents.select("doc_id", embed_text(F.col("text")).alias("text"))


def embedding_writeback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors written back to posts that lie in buckets by address: only the vectors move."""
    posts = kept_by_key(fx.older_posts(spark, sf_dir).drop("doc_id"), run_folder(spark, "by-key"))
    return write_vectors(posts, fx.document_blobs(spark, sf_dir)).select(
        "uri", "text", "embedding", F.length("embedding_blob").alias("bytes")
    )


# --- export ---


def export_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = export_rows(fx.posts_with_vectors(spark, sf_dir), EXPORT_END)
    total = F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x.cast("double"))
    return rows.select(
        "uri", "created_at", "created_date", "created_hour", "text",
        F.size("embedding").alias("dims"), F.round(total, 6).alias("total"), "post_url",
    )


def export_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Export of the merged table, whose vectors are lists already."""
    merged = merge_posts(reduce(DataFrame.unionByName, fx.import_runs(spark, sf_dir)))
    rows = export_rows(legacy_view(merged, "emb_vec"), EXPORT_END, vector="emb_vec")
    return rows.select(
        "uri", "created_date", "created_hour", "text",
        F.get("embedding", F.lit(0)).cast("double").alias("first"), "post_url",
    )


def export_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    chunked = with_chunk(fx.event_posts(spark, sf_dir), CHUNK_ROWS)
    return chunked.select("uri", "created_date", "created_hour", "chunk")


def export_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hour_grid(spark, fx.event_posts(spark, sf_dir), GRID_END)


def consolidation_stale(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days whose last event came after their last click, as if files had these times."""
    events = fx.table(spark, sf_dir, "events").select(
        F.date_format("ts", "yyyy-MM-dd").alias("day"), F.hour("ts").alias("hour"), "ts", "event_type"
    )
    chunks = events.groupBy("day", "hour").agg(F.max("ts").alias("modified"))
    clicks = events.where("event_type = 'click'").groupBy("day").agg(F.max("ts").alias("modified"))
    return stale_days(chunks, clicks).select("day", "stale")


def consolidate_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events exported in chunks, consolidated by day and read back."""
    folder = run_folder(spark, "export")
    rows = fx.event_posts(spark, sf_dir).withColumn("post_url", F.lit(None).cast("string"))
    write_chunks(rows, f"{folder}/chunks")
    consolidate(spark, f"{folder}/chunks", f"{folder}/daily", GRID_END, 31)
    return read_export(spark, f"{folder}/daily").select(
        "uri", "created_at", "created_date", "created_hour", "text",
        F.get("embedding", F.lit(0)).cast("double").alias("value"),
    )


# --- text encoding and search ---


def hash_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents encoded: filled buckets and a weighted sum over the vector."""
    documents = fx.documents(spark, sf_dir).select("doc_id", "text")
    weighted = F.aggregate(
        F.transform("embedding", lambda x, i: x.cast("double") * (i + 1)),
        F.lit(0.0),
        lambda a, x: a + x,
    )
    return encode_texts(documents, keep=["doc_id"]).select(
        "doc_id",
        F.size("embedding").alias("dims"),
        F.size(F.filter("embedding", lambda x: x > 0)).alias("filled"),
        F.round(weighted, 4).alias("weighted"),
    )


def text_search_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five documents nearest in wording to each benchmark text."""
    documents = fx.documents(spark, sf_dir).select("doc_id", "text")
    items = fx.table(spark, sf_dir, "benchmark").select("item_id", "text")
    corpus, queries = encode_texts(documents, keep=["doc_id"]), encode_texts(items, keep=["item_id"])
    found = nearest(corpus, queries, 5, "doc_id", "item_id")
    return _rounded(found, "distance")


SEARCH_WORDS = "  the of and in that  "


def text_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = fx.documents(spark, sf_dir).select(
        F.col("doc_id").cast("string").alias("uri"), "text"
    )
    return search_text(encode_texts(documents, keep=["uri"]), documents, SEARCH_WORDS, hashed_words())


# --- ad-hoc SQL ---


def row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return query_file(spark, f"{sf_dir}/events.parquet", "SELECT count(*) AS n FROM {file}")


def sql_where(spark: SparkSession, sf_dir: str) -> DataFrame:
    return query_file(
        spark,
        f"{sf_dir}/events.parquet",
        "SELECT event_type, count(*) AS n, round(sum(value), 2) AS total FROM {file} "
        "WHERE value > 10 AND event_type <> 'error' GROUP BY event_type",
    )


def count_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_by_date(fx.event_posts(spark, sf_dir))


def sample_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return query_file(
        spark,
        f"{sf_dir}/events.parquet",
        "SELECT event_id, user_id, event_type, value FROM {file} ORDER BY event_id LIMIT 10",
    )


# --- streams ---


def _done(query) -> None:
    query.awaitTermination()


def _run_landing(spark: SparkSession, folder: str, start_us: int | None = 1) -> None:
    """Land what the recorder has put below ``folder`` since the last run."""
    feed = stream_feed(spark, f"{folder}/messages", f"{folder}/state/start", start_us)
    _done(start_landing(feed, f"{folder}/bronze", f"{folder}/state/bronze", every=None))


def _land(spark: SparkSession, sf_dir: str, folder: str) -> str:
    """Land the feed in two runs of one stream: its English part, then the whole feed with labelled posts edited."""
    first = fx.recorded(spark, sf_dir).where("lang = 'en'")
    for drop, later in ((first, 0), (fx.recorded(spark, sf_dir, edited=True), fx.LATER_US)):
        fx.record(drop, f"{folder}/messages", later)
        _run_landing(spark, folder)
    return f"{folder}/bronze"


def _landed_uris(lines: DataFrame) -> DataFrame:
    return lines.select("hour", F.get_json_object("value", "$.uri").alias("uri"))


def stream_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per hour and post: English posts were delivered twice."""
    lines = read_landed(spark, _land(spark, sf_dir, run_folder(spark, "bronze")))
    return _landed_uris(lines).groupBy("hour", "uri").agg(F.count("*").alias("n"))


def stream_dead(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = run_folder(spark, "dead")
    fx.record(_damaged(fx.recorded(spark, sf_dir)), f"{folder}/messages")
    _run_landing(spark, folder)
    return read_dead(spark, f"{folder}/bronze").groupBy("reason").agg(F.count("*").alias("n"))


def stream_from_cursor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The landing lost its checkpoint: a new one goes on at the cursor of the posts landed up to the middle."""
    folder = run_folder(spark, "cursor")
    bronze = _land(spark, sf_dir, folder)
    landed = read_landed(spark, bronze).where(F.col("hour") < MIDDLE_HOUR)
    times = landed.select(F.get_json_object("value", "$.time_us").cast("bigint").alias("time_us"))
    feed = stream_feed(spark, f"{folder}/messages", f"{folder}/state/again", saved_cursor(times))
    _done(start_landing(feed, f"{folder}/more", f"{folder}/state/more", every=None))
    return _landed_uris(read_landed(spark, f"{folder}/more")).groupBy("hour", "uri").agg(F.count("*").alias("n"))


def _landed_later(spark: SparkSession, sf_dir: str, start_us: int | None) -> DataFrame:
    """The English part is there before the first start, the whole feed comes after it."""
    folder = run_folder(spark, "latest")
    fx.record(fx.recorded(spark, sf_dir).where("lang = 'en'"), f"{folder}/messages")
    _run_landing(spark, folder, start_us)
    fx.record(fx.recorded(spark, sf_dir, edited=True), f"{folder}/messages", fx.LATER_US)
    _run_landing(spark, folder, start_us)
    return _landed_uris(read_landed(spark, f"{folder}/bronze"))


def stream_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Without a cursor only what comes after the first start counts."""
    return _landed_later(spark, sf_dir, None)


def stream_cursor_zero(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A cursor of 0 is none."""
    return _landed_later(spark, sf_dir, 0)


def stream_stopped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A landing at its usual pace, stopped while it runs and started again: nothing is lost and nothing comes twice."""
    folder = run_folder(spark, "stopped")
    rest = fx.recorded(spark, sf_dir)
    for drop, later in ((rest.where("lang = 'en'"), 0), (rest.where("lang <> 'en' OR lang IS NULL"), fx.LATER_US)):
        fx.record(drop, f"{folder}/messages", later)
        feed = stream_feed(spark, f"{folder}/messages", f"{folder}/state/start", 1)
        query = start_landing(feed, f"{folder}/bronze", f"{folder}/state/bronze")
        query.processAllAvailable()
        query.stop()
    lines = _landed_uris(read_landed(spark, f"{folder}/bronze"))
    return lines.groupBy("hour", "uri").agg(F.count("*").alias("n"))


def stream_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed posts imported by a stream and merged."""
    folder = run_folder(spark, "upsert")
    lines = stream_landed(spark, _land(spark, sf_dir, folder))
    _done(start_posts(lines, f"{folder}/posts", f"{folder}/state/posts", every=None))
    return read_posts(spark, f"{folder}/posts").select(*POST_COLUMNS)


def stream_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same after a full second import, with a compaction behind each."""
    folder = run_folder(spark, "replay")
    lines = stream_landed(spark, _land(spark, sf_dir, folder))
    for state in ("first", "second"):
        _done(start_posts(lines, f"{folder}/posts", f"{folder}/state/{state}", every=None))
        compact_posts(spark, f"{folder}/posts")
    return read_posts(spark, f"{folder}/posts").select(*POST_COLUMNS)


def _tail(spark: SparkSession, sf_dir: str, folder: str) -> str:
    """Two imports of hour files that grow: all posts, then the labelled ones edited in the same files.

    Files of one hour of the day come only with the second, closed and with a very old time; files of another have a
    time far ahead from the start.
    """
    late = F.date_format(F.timestamp_micros("time_us"), "'T'HH") == LATE_HOUR
    posts = fx.flat_posts(spark, sf_dir).withColumn("order", F.lit(0))
    edited = fx.flat_posts(spark, sf_dir, edited=True).where(F.col("text").endswith(" [edited]")).withColumn("order", F.lit(1))
    for step in (1, 2):
        if step == 1:
            fx.grow_hour_files(posts.where(~late), f"{folder}/hours")
        else:
            fx.grow_hour_files(edited.where(~late), f"{folder}/hours")
            fx.grow_hour_files(posts.where(late).unionByName(edited.where(late)), f"{folder}/hours", ".ndjson")
            fx.set_file_times(spark, f"{folder}/hours", f"{LATE_HOUR}.ndjson", 86_400)
        fx.set_file_times(spark, f"{folder}/hours", f"{AHEAD_HOUR}.ndjson.part", 4_000_000_000)
        lines = stream_growing(spark, f"{folder}/hours")
        _done(start_posts(lines, f"{folder}/posts", f"{folder}/state/posts", every=None))
    return f"{folder}/posts"


def tail_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posts of growing hour files, and whether they came in both imports."""
    posts = read_posts(spark, _tail(spark, sf_dir, run_folder(spark, "tail")))
    return posts.select(*POST_COLUMNS, (F.col("indexed_first") < F.col("indexed_last")).alias("imported_again"))


def import_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines accepted, ignored and rejected of each growing file, over its imports."""
    return read_ledger(spark, _tail(spark, sf_dir, run_folder(spark, "ledger")))


def landed_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hours of the landed feed: accepted lines, how often messages came and the hour was closed, and its state."""
    bronze = _land(spark, sf_dir, run_folder(spark, "hours"))
    accepted = parse_lines(read_landed(spark, bronze)).where("outcome = 'post'")
    rows = accepted.groupBy("hour").agg(F.count("*").alias("rows"))
    return read_hours(spark, bronze).join(rows, "hour", "left")


def closed_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posts imported by a stream that takes hours when they are closed."""
    folder = run_folder(spark, "closed")
    lines = stream_landed(spark, _land(spark, sf_dir, folder), "closed")
    _done(start_posts(lines, f"{folder}/posts", f"{folder}/state/posts", every=None))
    return read_posts(spark, f"{folder}/posts").select(*POST_COLUMNS)


def landed_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accepted lines of one landed day, without listing the folders of others."""
    lines = read_landed(spark, _land(spark, sf_dir, run_folder(spark, "day")), day=LANDED_DAY)
    return parse_lines(lines).where("outcome = 'post'").select("uri", "hour", "text")


def export_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exported posts of one day and hour."""
    folder = run_folder(spark, "export-hour")
    write_chunks(fx.event_posts(spark, sf_dir).withColumn("post_url", F.lit(None).cast("string")), folder)
    rows = read_export(spark, folder).where((F.col("created_date") == LANDED_DAY) & (F.col("created_hour") == 7))
    return rows.select("uri", "created_at", "text")


def vector_table_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The searchable table written and loaded again."""
    folder = run_folder(spark, "vectors")
    write_vectors_table(fx.document_vectors(spark, sf_dir), folder)
    total = F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x.cast("double"))
    return read_vectors(spark, folder).select("uri", "text", F.round(total, 6).alias("total"))


def describe_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return describe(spark, fx.table(spark, sf_dir, "events"))


def _embedded(spark: SparkSession, sf_dir: str, name: str, compacted: bool = True) -> str:
    """The whole way: feed, hours, merged posts, vectors written back, and all of it compacted."""
    folder = run_folder(spark, name)
    lines = stream_landed(spark, _land(spark, sf_dir, folder))
    posts = f"{folder}/posts"
    _done(start_posts(lines, posts, f"{folder}/state/posts", every=None))
    _done(start_embedding(spark, posts, f"{folder}/state/vectors", every=None))
    if compacted:
        compact_posts(spark, posts)
    return posts


def feed_to_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From the feed to the posts nearest to a text."""
    posts = read_posts(spark, _embedded(spark, sf_dir, "search")).where("has_embedding = 1")
    vectors = posts.select("uri", F.col("emb_vec").alias("embedding"))
    return search_text(vectors, posts, SEARCH_WORDS, hashed_words())


def feed_to_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From the feed to export rows of posts that got a vector."""
    stored = read_posts(spark, _embedded(spark, sf_dir, "way"))
    posts = legacy_view(stored, "emb_vec", "emb_model", "emb_dims")
    return export_rows(posts, EXPORT_END, vector="emb_vec").select(
        "uri", "created_date", "created_hour", "text", F.size("embedding").alias("dims"), "post_url"
    )


def stream_older(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed, its English part twice, stored in the older shape."""
    folder = run_folder(spark, "older")
    messages = fx.recorded(spark, sf_dir)
    for drop, later in ((messages.where("lang = 'en'"), 0), (messages, fx.LATER_US)):
        fx.record(drop, f"{folder}/messages", later)
        feed = stream_feed(spark, f"{folder}/messages", f"{folder}/state/start", 1)
        # Messages without a readable event time count for the older table.
        _done(start_older(feed, f"{folder}/posts", f"{folder}/state/posts", every=None))
    return read_older(spark, f"{folder}/posts").select(
        "uri", "repo", "rkey", "created_at", "created_date", "created_hour", "text", "langs"
    )


def stream_embedding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """English posts among the landed ones, encoded by a stream."""
    vectors = read_embeddings(spark, _embedded(spark, sf_dir, "embedding", compacted=False))
    return vectors.select("uri", "text", F.size("embedding").alias("dims"))


def export_glob(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exported posts of one day, found by the names of its files among those of all days."""
    folder = run_folder(spark, "glob")
    rows = fx.event_posts(spark, sf_dir).withColumn("post_url", F.lit(None).cast("string"))
    fx.write_flat_chunks(rows, folder)
    return read_export_files(spark, folder, LANDED_DAY).select("uri", "created_at", "created_hour", "text")


LISTED = ("events", "orders", "documents", "labels")


def table_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables of the session that stand for given files, with their rows."""
    views = {f"listed_{name}": name for name in LISTED}
    for view, name in views.items():
        fx.table(spark, sf_dir, name).createOrReplaceTempView(view)
    counts = [
        spark.table(view).agg(F.count("*").alias("rows")).select(F.lit(views[view]).alias("name"), "rows")
        for view in table_names(spark) if view in views
    ]
    return reduce(DataFrame.unionByName, counts)


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        knn_top5, vector_distances, knn_batch_top5, knn_small_top5, knn_blocked_top5, vector_shapes, vector_blob_roundtrip,
        vector_table_build, feed_filter, feed_filter_legacy, feed_flatten, feed_verdicts,
        feed_from_cursor, hour_key_counts, cursor_max, hour_closed, import_valid, import_rejects,
        file_groups, file_rows, posts_upsert, posts_upsert_layers, posts_first_wins,
        posts_distinct, posts_legacy_view, posts_legacy_from_merged, pending_queue, pending_all,
        embed_input, embedding_writeback, export_posts, export_merged, export_chunks, export_grid,
        consolidation_stale, consolidate_union, hash_encode, text_search_batch, text_search,
        row_count, sql_where, count_by_day, sample_limit, stream_bronze,
        stream_from_cursor, stream_latest, stream_cursor_zero, stream_stopped, import_ledger, closed_hours,
        export_glob, table_listing, stream_dead, stream_upsert, stream_replay, tail_source, stream_older, stream_embedding,
        landed_hours, landed_day, export_hour, vector_table_stored, describe_events,
        feed_to_search, feed_to_export,
    )
}
