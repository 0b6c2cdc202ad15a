"""Messages to hour folders of flat posts, dead letters beside them, from one decode and in one commit.

A micro-batch writes one table of texts, in folders by outcome and hour, below a folder of its own. Then a commit names
that folder, so posts and dead letters of a batch appear together or not at all, and a repeated batch
replaces its own folder.

Hours are closed by event time: the latest hour seen is the running one, all before it are closed. The
commit lists the pieces (an hour's folder in a batch) that came, those of running or later hours still open, and those
that it closes. A late message brings its hour back: its piece comes and is closed in the same commit.
Readers follow either all pieces or the closed ones; each piece is in either list once.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.readwriter import DataStreamWriter

from feedloom.functions.times import hour_key
from feedloom.operators.feed import event_time, flat_fields, verdict
from feedloom.schemas import FLUSH_SECONDS
from feedloom.sources.commits import CommitLog, folders_in
from feedloom.sources.feed import Feed
from feedloom.sources.hour_files import LINES, hour_lines
from feedloom.sources.tables import write_texts

POSTS, DEAD, NO_HOUR = "outcome=post", "outcome=dead", "none"
PIECES = "array<struct<hour STRING, folder STRING>>"
COMMIT = f"version BIGINT, folder STRING, as_of STRING, dead BOOLEAN, came {PIECES}, open {PIECES}, closed {PIECES}"


def triggered(writer: DataStreamWriter, every: str | None) -> DataStreamWriter:
    """Run every so often, or with ``None`` once over all that is there."""
    return writer.trigger(availableNow=True) if every is None else writer.trigger(processingTime=every)


def query_id(batch: DataFrame) -> str:
    """The streaming query that a micro-batch belongs to; its id lives in its checkpoint."""
    return batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")


def landed_rows(messages: DataFrame, outcome: Column | None = None) -> DataFrame:
    """``value, outcome, hour``: flat posts and dead letters as texts; other messages are left out."""
    found = (verdict() if outcome is None else outcome).alias("found")
    defect = F.substring_index("found", ":", -1).alias("reason")
    post = F.col("found") == "post"
    # ``inline`` keeps the verdict from being formed once more for the filter.
    return (
        messages.select("*", F.inline(F.array(F.struct(found))))
        .where("found <> 'skip'")
        .select(
            F.when(post, F.to_json(F.struct(*flat_fields())))
            .otherwise(F.to_json(F.struct("value", defect)))
            .alias("value"),
            F.when(post, "post").otherwise("dead").alias("outcome"),
            F.when(post, hour_key(event_time())).otherwise(NO_HOUR).alias("hour"),
        )
    )


def land(messages: DataFrame, path: str, run: str, batch: int, outcome: Column | None = None) -> None:
    """Write (runs one job) and commit the messages of a batch."""
    spark = messages.sparkSession
    folder = f"run={run}/batch={batch:012d}"
    # A folder of the recorder spans few hours, so what a task reads lies by hour already and no message is moved.
    write_texts(landed_rows(messages, outcome), f"{path}/{folder}", "overwrite", "outcome", "hour")
    # The hours stand in the names of the folders just written.
    hours = [name.removeprefix("hour=") for name in folders_in(spark, f"{path}/{folder}/{POSTS}")]
    dead = bool(folders_in(spark, f"{path}/{folder}/{DEAD}"))

    def change(state: dict) -> dict | None:
        done = state.get("done", {})
        if done.get(run, -1) >= batch:
            return None
        came = [{"hour": hour, "folder": folder} for hour in hours]
        as_of = max([state.get("as_of", ""), *hours])
        pieces = [*state.get("open", []), *came]
        return {
            "folder": folder, "as_of": as_of, "dead": dead, "came": came, "done": {**done, run: batch},
            "open": [piece for piece in pieces if piece["hour"] >= as_of],
            "closed": [piece for piece in pieces if piece["hour"] < as_of],
        }

    CommitLog(spark, path).commit(change)


def start_landing(
    feed: Feed, path: str, checkpoint: str, every: str | None = f"{FLUSH_SECONDS} seconds", outcome: Column | None = None
) -> StreamingQuery:
    """Land the feed below ``path``; beside the older table give ``verdict_legacy()`` as ``outcome``."""

    def land_batch(batch: DataFrame, number: int) -> None:
        land(feed.messages(batch), path, query_id(batch), number, outcome)

    writer = feed.folders.writeStream.option("checkpointLocation", checkpoint).foreachBatch(land_batch)
    return triggered(writer, every).start()


def _commits(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(COMMIT).json(CommitLog(spark, path).ensure())


def _piece_lines(spark: SparkSession, path: str, pieces) -> DataFrame:
    folders = sorted({f"{path}/{piece.folder}/{POSTS}/hour={piece.hour}" for piece in pieces})
    if not folders:
        return spark.createDataFrame([], f"{LINES}, file_day STRING")
    return hour_lines(spark.read.text(folders))


def read_landed(spark: SparkSession, path: str, which: str = "came", day: str | None = None) -> DataFrame:
    """Lines of all landed hours (``which="closed"``: of closed ones), or of one day, with file and hour.

    Only folders of the hours asked for are listed.
    """
    pieces = _commits(spark, path).select(F.inline(which))
    if day is not None:
        pieces = pieces.where(F.substring("hour", 1, 10) == day)
    return _piece_lines(spark, path, pieces.collect())


def read_dead(spark: SparkSession, path: str) -> DataFrame:
    """Dead letters: ``value, reason``."""
    folders = [f"{path}/{row.folder}/{DEAD}/hour={NO_HOUR}" for row in _commits(spark, path).where("dead").collect()]
    shape = "value STRING, reason STRING"
    return spark.read.schema(shape).json(folders) if folders else spark.createDataFrame([], shape)


def read_hours(spark: SparkSession, path: str) -> DataFrame:
    """``hour, came, closed, is_open``: how often messages of an hour came and how often it was closed."""
    commits = _commits(spark, path)
    came = commits.select("version", F.explode("came.hour").alias("hour"), F.lit("came").alias("what"))
    closed = commits.select("version", F.explode(F.array_distinct("closed.hour")).alias("hour"), F.lit("closed").alias("what"))
    count = lambda what: F.count_if(F.col("what") == what).alias(what)
    last = lambda what: F.max(F.when(F.col("what") == what, F.col("version")))
    behind = F.coalesce(last("closed") < last("came"), last("closed").isNull()).alias("is_open")
    return came.unionByName(closed).groupBy("hour").agg(count("came"), count("closed"), behind)


@dataclass(frozen=True)
class Landed:
    """A stream of landed pieces, and how those of a micro-batch are read."""

    pieces: DataFrame
    path: str

    def lines(self, batch: DataFrame) -> DataFrame:
        rows = batch.select("hour", "folder", "indexed_at").collect()
        at = F.lit(rows[0].indexed_at if rows else None).cast("bigint")
        return _piece_lines(batch.sparkSession, self.path, rows).withColumn("indexed_at", at)


def stream_landed(spark: SparkSession, path: str, which: str = "came", **options: str) -> Landed:
    """Lines of landed hours as they come, or with ``which="closed"`` when their hour is closed.

    The stream follows the commits with Spark's file source; ``indexed_at`` is the start of the micro-batch, which Spark
    keeps in the offset log, so a repeated batch gets the same value.
    """
    commits = spark.readStream.schema(COMMIT).options(**options).json(CommitLog(spark, path).ensure())
    return Landed(commits.select(F.inline(which), F.unix_micros(F.current_timestamp()).alias("indexed_at")), path)
