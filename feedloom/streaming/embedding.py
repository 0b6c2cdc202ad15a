"""Vectors for posts that have none, written back to the posts table by a stream that follows its commits."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from feedloom.functions.text import embed_text
from feedloom.operators.encode import Encoder, encode_texts
from feedloom.operators.legacy import legacy_view
from feedloom.operators.pending import pending_posts
from feedloom.sources.commits import CommitLog
from feedloom.streaming.landing import query_id, triggered
from feedloom.streaming.posts import (
    base_posts, batch_folder, days_in, days_of, is_done, layer_vectors, merged_days, read_posts, write_days,
)

COMMIT = "added ARRAY<STRUCT<folder STRING, days ARRAY<STRING>>>"


def read_embeddings(spark: SparkSession, path: str) -> DataFrame:
    """``uri, text, embedding`` of the posts that have a vector: of a post on several days, that of the latest day."""
    posts = read_posts(spark, path).where("has_embedding = 1")
    latest = F.max_by(F.struct("text", F.col("emb_vec").alias("embedding")), "file_day").alias("latest")
    return posts.groupBy("uri").agg(latest).select("uri", "latest.*")


def waiting_posts(spark: SparkSession, path: str, added: list) -> DataFrame:
    """Posts of the layers named in commits that wait for a vector.

    A layer still on top is walked alone; of one folded since, the days are. Whether a post has a vector is asked of
    the flags and vectors of these days only.
    """
    state = CommitLog(spark, path).latest()
    live = {layer["folder"] for layer in state.get("layers", [])}
    layers = [{"folder": part.folder, "days": part.days} for part in added]
    days = sorted(days_of(layers))
    folded = sorted(days_of([layer for layer in layers if layer["folder"] not in live]))
    bases = state.get("bases", {}).keys()
    rows = merged_days(
        spark, path, [layer for layer in layers if layer["folder"] in live], bases & folded,
        lambda some: base_posts(spark, path, state, some).where("has_embedding = 0"),
    )
    rows = base_posts(spark, path, {}) if rows is None else rows
    waiting = pending_posts(legacy_view(rows, "file_day"))
    vectors = [part for part in state.get("vectors", []) if set(part["days"]) & set(days)]
    if not vectors and not bases & set(days):
        return waiting
    filled = base_posts(spark, path, state, days).where("has_embedding = 1").select("file_day", "uri")
    done = filled.unionByName(layer_vectors(spark, path, vectors).where(F.col("file_day").isin(days)).select("file_day", "uri"))
    return waiting.join(done, ["file_day", "uri"], "left_anti")


def embed_added(
    spark: SparkSession, path: str, added: list, run: str, batch: int,
    make_encoder: Callable[[], Encoder] | None = None, model: str = "words", max_chars: int | None = None,
) -> None:
    """Encode the waiting posts of the layers ``added`` and commit their vectors to the posts table."""
    log = CommitLog(spark, path)
    if not added or is_done(log.latest(), run, batch):
        return
    queue = waiting_posts(spark, path, added).select("file_day", "uri", embed_text(F.col("text"), max_chars).alias("text"))
    encoded = encode_texts(queue, "text", make_encoder, keep=["file_day", "uri"])
    rows = encoded.select("file_day", "uri", F.col("embedding").alias("emb_vec"), F.lit(model).alias("emb_model"))
    folder = batch_folder(run, batch)
    write_days(rows, f"{path}/vectors/{folder}", len({day for part in added for day in part.days}))
    days = days_in(spark, f"{path}/vectors/{folder}")

    def change(state: dict) -> dict | None:
        if is_done(state, run, batch):
            return None
        part = [{"folder": folder, "days": days}] if days else []
        return {
            **state, "kind": "vectors", "added": [], "vectors": [*state.get("vectors", []), *part],
            "done": {**state.get("done", {}), run: batch},
        }

    log.commit(change)


def start_embedding(
    spark: SparkSession,
    path: str,
    checkpoint: str,
    make_encoder: Callable[[], Encoder] | None = None,
    every: str | None = "1 minute",
    model: str = "words",
) -> StreamingQuery:
    """Encode English posts of the posts table at ``path`` as its commits come."""

    def embed_batch(batch: DataFrame, number: int) -> None:
        added = batch.select(F.inline("added")).collect()
        embed_added(batch.sparkSession, path, added, query_id(batch), number, make_encoder, model)

    commits = spark.readStream.schema(COMMIT).json(CommitLog(spark, path).ensure())
    writer = commits.writeStream.option("checkpointLocation", checkpoint).foreachBatch(embed_batch)
    return triggered(writer, every).start()
