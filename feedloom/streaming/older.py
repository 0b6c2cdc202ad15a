"""Messages straight to the older posts table, where the first arrival of a post stays.

The table is stored with one row per address: segments, one per micro-batch, each dealt over buckets by a hash of
the address, with a Bloom filter per bucket. A batch asks the filters which of its addresses a segment may hold, meets
only those buckets of those segments, and there only the address column; everything else is new and is
appended unseen. ``compact_older`` joins the segments.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from feedloom.operators.feed import event_time, keep_posts_legacy, legacy_posts
from feedloom.operators.merge import first_per_key
from feedloom.schemas import OLDER_POSTS
from feedloom.sources.commits import CommitLog, folders_in
from feedloom.sources.feed import Feed
from feedloom.streaming.landing import query_id, triggered
from feedloom.streaming.posts import batch_folder, is_done, write_parts

BUCKETS = 64
KEY_BITS = 10
PROBES = 7
ROWS = f"{OLDER_POSTS}, bucket INT"
FILTERS = "bucket INT, segment STRING, bits BINARY"


def _probes(hashes: np.ndarray, size: int) -> np.ndarray:
    """Places of each hash in a filter of ``size`` bits."""
    keys = hashes.view(np.uint64)
    low, step = keys & np.uint64(0xFFFFFFFF), (keys >> np.uint64(32)) | np.uint64(1)
    return (low[:, None] + np.arange(PROBES, dtype=np.uint64) * step[:, None]) % np.uint64(size)


def bloom(hashes: np.ndarray) -> bytes:
    """A filter of ``KEY_BITS`` bits a key: about one false answer in a hundred."""
    bits = np.zeros(-(-max(len(hashes) * KEY_BITS, 64) // 8) * 8, np.uint8)
    bits[_probes(hashes, len(bits)).ravel()] = 1
    return np.packbits(bits).tobytes()


def may_hold(bits: bytes, hashes: np.ndarray) -> np.ndarray:
    places = _probes(hashes, len(bits) * 8)
    held = np.frombuffer(bits, np.uint8)
    return ((held[places >> np.uint64(3)] >> (np.uint64(7) - (places & np.uint64(7)))) & 1).all(axis=1)


def _hash() -> Column:
    """Not the hash that deals the buckets, which is alike in all addresses of one."""
    return F.xxhash64("uri", F.lit("filter")).alias("hash")


def _filters(rows: DataFrame) -> DataFrame:
    """A filter for each bucket of a segment; a task holds 8 bytes for each key of a bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, parts = None, []

        def made():
            return pa.RecordBatch.from_arrays(
                [pa.array([bucket], pa.int32()), pa.array([bloom(np.concatenate(parts))], pa.binary())], ["bucket", "bits"]
            )

        for batch in batches:
            buckets, hashes = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("bucket", "hash"))
            for start in [0, *(np.flatnonzero(np.diff(buckets)) + 1)] if len(buckets) else []:
                if bucket is not None and buckets[start] != bucket:
                    yield made()
                    parts = []
                bucket = int(buckets[start])
                stop = start + int(np.searchsorted(buckets[start:], bucket, "right"))
                parts.append(hashes[start:stop])
        if parts:
            yield made()

    dealt = rows.select("bucket", _hash()).repartition("bucket").sortWithinPartitions("bucket")
    return dealt.mapInArrow(run, "bucket INT, bits BINARY")


def _candidates(keys: DataFrame, filters: DataFrame) -> DataFrame:
    """``uri, segment, bucket`` where a segment may hold the address; each bucket's filters come before its keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, held = None, []
        for batch in batches:
            rows = batch.to_pydict()
            hashes = batch.column("hash").fill_null(0).to_numpy(zero_copy_only=False)
            buckets = np.array(rows["bucket"])
            found: dict[str, list] = {"uri": [], "segment": [], "bucket": []}
            at = 0
            while at < len(buckets):
                if buckets[at] != bucket:
                    bucket, held = int(buckets[at]), []
                if rows["kind"][at] == 0:
                    held.append((rows["segment"][at], rows["bits"][at]))
                    at += 1
                    continue
                stop = at + int(np.searchsorted(buckets[at:], bucket, "right"))
                for segment, bits in held:
                    for i in (np.flatnonzero(may_hold(bits, hashes[at:stop])) + at).tolist():
                        found["uri"].append(rows["uri"][i])
                        found["segment"].append(segment)
                        found["bucket"].append(bucket)
                at = stop
            yield pa.RecordBatch.from_pydict(
                found, pa.schema([("uri", pa.string()), ("segment", pa.string()), ("bucket", pa.int32())])
            )

    none = lambda kind: F.lit(None).cast(kind)
    asked = keys.select("bucket", F.lit(1).alias("kind"), none("string").alias("segment"), none("binary").alias("bits"),
                        _hash(), "uri")
    held = filters.select("bucket", F.lit(0).alias("kind"), "segment", "bits", none("long").alias("hash"), none("string").alias("uri"))
    dealt = held.unionByName(asked).repartition("bucket").sortWithinPartitions("bucket", "kind")
    return dealt.mapInArrow(run, "uri STRING, segment STRING, bucket INT")


def _segment_rows(spark: SparkSession, path: str, folders: list[str]) -> DataFrame:
    if not folders:
        return spark.createDataFrame([], ROWS)
    root = f"{path}/posts"
    rows = spark.read.schema(ROWS).option("basePath", root).parquet(*[f"{root}/{folder}" for folder in folders])
    return rows.drop("run", "batch")


def new_rows(rows: DataFrame, path: str, segments: list[dict], draft: str) -> DataFrame:
    """The rows whose address no segment holds; the driver gets names of buckets only. Runs a job that writes ``draft``."""
    spark = rows.sparkSession
    if not segments:
        return rows
    names = {segment["folder"]: set(segment["buckets"]) for segment in segments}
    filters = spark.read.schema(FILTERS).parquet(*[f"{path}/filters/{name}" for name in names])
    write_parts(_candidates(rows.select("uri", "bucket"), filters), draft)
    maybe = spark.read.schema("uri STRING, segment STRING, bucket INT").parquet(draft)
    places = maybe.select("segment", "bucket").distinct().collect()
    met = sorted({f"{p.segment}/bucket={p.bucket}" for p in places if p.bucket in names[p.segment]})
    if not met:
        return rows
    known = _segment_rows(spark, path, met).select("uri").join(maybe.select("uri").distinct(), "uri", "left_semi")
    return rows.join(known, "uri", "left_anti")


def _append(rows: DataFrame, path: str, folder: str) -> dict | None:
    """Write (runs two jobs) a segment and its filters."""
    spark = rows.sparkSession
    write_parts(rows.repartition("bucket"), f"{path}/posts/{folder}", "bucket")
    buckets = [int(name.removeprefix("bucket=")) for name in folders_in(spark, f"{path}/posts/{folder}")]
    if not buckets:
        return None
    filters = _filters(_segment_rows(spark, path, [folder])).withColumn("segment", F.lit(folder))
    write_parts(filters.select("bucket", "segment", "bits"), f"{path}/filters/{folder}")
    return {"folder": folder, "buckets": buckets}


def store_older(messages: DataFrame, path: str, run: str, batch: int) -> None:
    """Append and commit the posts of a batch whose address is new: of several, the first arrival."""
    spark = messages.sparkSession
    log = CommitLog(spark, path)
    arrival = F.struct(F.coalesce(event_time(), F.lit(0)))
    posts = legacy_posts(keep_posts_legacy(messages.withColumn("arrival", arrival)), "arrival")
    order = F.struct("arrival", F.xxhash64("created_at", "text"))
    bucket = F.pmod(F.xxhash64("uri"), F.lit(BUCKETS)).cast("int").alias("bucket")
    draft = f"{path}/drafts/{batch_folder(run, batch)}"
    write_parts(first_per_key(posts, "uri", order).drop("arrival").select("*", bucket), draft)
    rows = spark.read.schema(ROWS).parquet(draft)
    while True:
        seen = log.latest()
        if is_done(seen, run, batch):
            return
        segments = seen.get("segments", [])
        part = _append(new_rows(rows, path, segments, f"{draft}-asked"), path, batch_folder(run, batch))
        added = [part] if part else []
        lost = False

        def change(state: dict) -> dict | None:
            nonlocal lost
            # Another writer's posts have to be met first.
            lost = state.get("version") != seen.get("version")
            if lost:
                return None
            return {**state, "segments": [*segments, *added], "done": {**state.get("done", {}), run: batch}}

        log.commit(change)
        if not lost:
            return


def start_older(feed: Feed, path: str, checkpoint: str, every: str | None = "3 seconds") -> StreamingQuery:
    """Store new posts of the feed in the older shape."""

    def store_batch(batch: DataFrame, number: int) -> None:
        store_older(feed.messages(batch), path, query_id(batch), number)

    writer = feed.folders.writeStream.option("checkpointLocation", checkpoint).foreachBatch(store_batch)
    return triggered(writer, every).start()


def read_older(spark: SparkSession, path: str) -> DataFrame:
    """Posts in the older shape, one row per address, as they are stored."""
    segments = CommitLog(spark, path).latest().get("segments", [])
    return _segment_rows(spark, path, [segment["folder"] for segment in segments]).drop("bucket")


def compact_older(spark: SparkSession, path: str) -> None:
    """Join (runs two jobs) all segments into one; a segment that a stream appends meanwhile stays beside it."""
    log = CommitLog(spark, path)
    segments = log.latest().get("segments", [])
    if len(segments) < 2:
        return
    gone = {segment["folder"] for segment in segments}
    part = _append(_segment_rows(spark, path, sorted(gone)), path, f"run=joined/batch={uuid.uuid4().hex}")

    def change(state: dict) -> dict:
        kept = [segment for segment in state["segments"] if segment["folder"] not in gone]
        return {**state, "segments": [part, *kept]}

    log.commit(change)
