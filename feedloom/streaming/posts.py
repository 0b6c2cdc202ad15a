"""Hour files to the merged post table.

The table at a path is what its commits name (``sources/commits.py``): for each day one base folder, on top of it
layers, one per micro-batch, and vectors. A batch merges its own lines, appends them as a layer and commits; its cost
follows its own size, not that of the days it touches. ``compact_posts`` folds layers and vectors into new base
folders of the days they touch and swaps them in one commit, so later reads list the live folders only. A day without
layers is read as it lies.

With the layer a batch commits its rejects and its ledger: how many lines of each file were accepted, ignored and
rejected. All three come from one decode of the lines.
"""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Callable, Collection, Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from feedloom.operators.importing import is_reject, parse_lines, rejected_lines, valid_posts
from feedloom.operators.merge import merge_posts, with_vectors
from feedloom.schemas import POSTS, POST_VECTORS
from feedloom.sources.commits import CommitLog, folders_in
from feedloom.sources.hour_files import arrival
from feedloom.streaming.landing import query_id, triggered

PLACE = "run STRING, batch STRING"
REJECTS = "value STRING, reason STRING"
LEDGER = "file STRING, accepted BIGINT, ignored BIGINT, rejected BIGINT"
FEW_DAYS = 8


def imported(lines: DataFrame) -> DataFrame:
    """Parsed lines with their order of arrival."""
    return parse_lines(lines.withColumn("arrival", arrival()))


def imported_posts(parsed: DataFrame) -> DataFrame:
    return valid_posts(parsed, F.col("indexed_at"), F.col("file_day"), F.col("arrival"))


def file_counts(parsed: DataFrame) -> DataFrame:
    """Accepted, ignored and rejected lines of each file."""
    count = lambda condition, name: F.count_if(condition).alias(name)
    return parsed.groupBy(F.substring_index("file_path", "/", -1).alias("file")).agg(
        count(F.col("outcome") == "post", "accepted"),
        count(F.col("outcome") == "ignored", "ignored"),
        count(is_reject(), "rejected"),
    )


def write_parts(df: DataFrame, path: str, *parts: str) -> None:
    """Write (runs a job) a folder anew; a repeated batch replaces all of its own."""
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "static").option("compression", "zstd")
    writer.partitionBy(*parts).parquet(path)


def write_days(df: DataFrame, path: str, days: int) -> None:
    """Write (runs a job) a folder by day, about so many days in all.

    Of few days each task writes its own files, at most ``FEW_DAYS`` of them; only rows of more days are brought
    together first, so that files stay large.
    """
    write_parts(df if days <= FEW_DAYS else df.hint("rebalance", "file_day"), path, "file_day")


def days_in(spark: SparkSession, path: str) -> list[str]:
    """The days of a folder just written."""
    return [name.removeprefix("file_day=") for name in folders_in(spark, path)]


def batch_folder(run: str, batch: int) -> str:
    return f"run={run}/batch={batch:012d}"


def is_done(state: dict, run: str, batch: int) -> bool:
    return state.get("done", {}).get(run, -1) >= batch


def append_layer(lines: DataFrame, path: str, run: str, batch: int) -> None:
    """Write and commit the merged posts, the rejects and the ledger of one batch below ``path``."""
    spark = lines.sparkSession
    log = CommitLog(spark, path)
    if is_done(log.latest(), run, batch):
        return
    folder = batch_folder(run, batch)
    # Decoded once, for the three tables made of it.
    parsed = imported(lines).persist()
    try:
        seen = Observation()
        days_seen = F.size(F.collect_set("file_day")).alias("days")
        counts = file_counts(parsed.observe(seen, F.count_if(is_reject()).alias("rejected"), days_seen))
        write_parts(counts.coalesce(1), f"{path}/ledger/{folder}")
        write_days(merge_posts(imported_posts(parsed)), f"{path}/layers/{folder}", seen.get["days"])
        if seen.get["rejected"]:
            write_parts(rejected_lines(parsed), f"{path}/rejects/{folder}")
    finally:
        parsed.unpersist()
    days = days_in(spark, f"{path}/layers/{folder}")

    def change(state: dict) -> dict | None:
        if is_done(state, run, batch):
            return None
        added = [{"folder": folder, "days": days}] if days else []
        return {
            **state, "kind": "import", "added": added, "layers": [*state.get("layers", []), *added],
            "done": {**state.get("done", {}), run: batch},
        }

    log.commit(change)


def start_posts(lines, path: str, checkpoint: str, every: str | None = "1 minute") -> StreamingQuery:
    """Import new lines every minute, or with ``every=None`` once.

    ``lines`` is a stream of lines, or one of names with a way to read them (``stream_landed``, ``stream_growing``).
    """
    pieces, read = (lines, lambda batch: batch) if isinstance(lines, DataFrame) else (lines.pieces, lines.lines)

    def import_batch(batch: DataFrame, number: int) -> None:
        # The query's own id lives in its checkpoint; another checkpoint is another run.
        append_layer(read(batch), path, query_id(batch), number)

    writer = pieces.writeStream.option("checkpointLocation", checkpoint).foreachBatch(import_batch)
    return triggered(writer, every).start()


def _parts(spark: SparkSession, root: str, names: Iterable[str], schema: str) -> DataFrame:
    """The named folders below ``root``, with the columns of ``schema``; nothing else there is listed."""
    paths = [f"{root}/{name}" for name in names]
    if not paths:
        return spark.createDataFrame([], schema)
    columns = StructType.fromDDL(schema).names
    return spark.read.schema(schema).option("basePath", root).parquet(*paths).select(*columns)


def layer_posts(spark: SparkSession, path: str, layers: Sequence[dict], days: Collection[str]) -> DataFrame:
    """Posts of some days of layers, with a place that puts them behind any base and in their order."""
    by_day = lambda layer: [f"{layer['folder']}/file_day={day}" for day in layer["days"] if day in days]
    whole = lambda layer: set(layer["days"]) <= set(days)
    folders = [name for layer in layers for name in ([layer["folder"]] if whole(layer) else by_day(layer))]
    rows = _parts(spark, f"{path}/layers", folders, f"{POSTS}, {PLACE}")
    place = F.struct(F.lit(1).alias("layer"), "indexed_last", "run", "batch")
    return rows.withColumn("arrival", place).drop("run", "batch")


def layer_vectors(spark: SparkSession, path: str, vectors: Sequence[dict]) -> DataFrame:
    return _parts(spark, f"{path}/vectors", (part["folder"] for part in vectors), f"{POST_VECTORS}, {PLACE}")


def base_posts(spark: SparkSession, path: str, state: dict, days: Iterable[str] | None = None) -> DataFrame:
    """Posts of the base folders, of all days or of those given."""
    bases = state.get("bases", {})
    wanted = bases if days is None else [day for day in days if day in bases]
    folders = [f"id={bases[day]}/file_day={day}" for day in wanted]
    return _parts(spark, f"{path}/base", folders, f"{POSTS}, id STRING").drop("id")


def as_oldest(base: DataFrame) -> DataFrame:
    """Base posts with a place before any layer."""
    none = F.lit("")
    place = F.struct(F.lit(0).alias("layer"), "indexed_last", none.alias("run"), none.alias("batch"))
    return base.withColumn("arrival", place)


def merged_days(
    spark: SparkSession, path: str, layers: Sequence[dict], base_days: Iterable[str],
    base: Callable[[Sequence[str]], DataFrame],
) -> DataFrame | None:
    """The days of layers and those of a base, merged; None if there are none. ``base`` gives its posts of some days.

    A layer and a base each hold a post of a day once, so a day that lies in one of them alone is taken as it lies.
    """
    parts = Counter([*base_days, *(day for layer in layers for day in layer["days"])])
    alone = {day for day, n in parts.items() if n == 1}
    several = parts.keys() - alone
    in_layers, in_base = days_of(layers), set(base_days)
    found = []
    if alone & in_base:
        found.append(base(sorted(alone & in_base)))
    if alone & in_layers:
        found.append(layer_posts(spark, path, layers, alone).drop("arrival"))
    if several:
        rows = layer_posts(spark, path, layers, several)
        if several & in_base:
            rows = as_oldest(base(sorted(several & in_base))).unionByName(rows)
        found.append(merge_posts(rows))
    return reduce(DataFrame.unionByName, found) if found else None


def days_of(parts: Sequence[dict]) -> set[str]:
    return {day for part in parts for day in part["days"]}


def _written() -> Column:
    return F.struct("run", "batch", F.xxhash64("emb_vec"))


def _folded(spark: SparkSession, path: str, state: dict) -> DataFrame | None:
    """The days with layers or vectors, merged; None if there are none."""
    layers, vectors = state.get("layers", []), state.get("vectors", [])
    touched = days_of(layers) | days_of(vectors)
    base_days = touched & state.get("bases", {}).keys()
    rows = merged_days(spark, path, layers, base_days, lambda days: base_posts(spark, path, state, days))
    if rows is not None and vectors:
        rows = with_vectors(rows, layer_vectors(spark, path, vectors), _written())
    return rows


def read_posts(spark: SparkSession, path: str) -> DataFrame:
    """The merged posts. Only days that have layers are merged; a filter on ``file_day`` reaches the folders."""
    state = CommitLog(spark, path).latest()
    folded = _folded(spark, path, state)
    if folded is None:
        return base_posts(spark, path, state)
    touched = days_of(state.get("layers", [])) | days_of(state.get("vectors", []))
    rest = [day for day in state.get("bases", {}) if day not in touched]
    return folded.unionByName(base_posts(spark, path, state, rest)) if rest else folded


def compact_posts(spark: SparkSession, path: str) -> None:
    """Fold (runs a job) all layers and vectors that there are into new base folders, swapped in one commit.

    What a stream appends meanwhile stays on top. Old folders are left to readers that still use them.
    """
    log = CommitLog(spark, path)
    state = log.latest()
    folded = _folded(spark, path, state)
    if folded is None:
        return
    name = uuid.uuid4().hex
    folder = f"{path}/base/id={name}"
    write_days(folded, folder, len(days_of(state.get("layers", [])) | days_of(state.get("vectors", []))))
    days = days_in(spark, folder)
    gone = {kind: {part["folder"] for part in state.get(kind, [])} for kind in ("layers", "vectors")}

    def change(now: dict) -> dict:
        kept = {kind: [part for part in now.get(kind, []) if part["folder"] not in gone[kind]] for kind in gone}
        return {**now, **kept, "kind": "compact", "added": [], "bases": {**now.get("bases", {}), **dict.fromkeys(days, name)}}

    log.commit(change)


def _committed(spark: SparkSession, path: str, kind: str, schema: str) -> DataFrame:
    """Rows of all committed batches of a table kept whole."""
    done = CommitLog(spark, path).latest().get("done", {})
    if not folders_in(spark, f"{path}/{kind}"):
        return spark.createDataFrame([], f"{schema}, {PLACE}")
    rows = spark.read.schema(f"{schema}, {PLACE}").parquet(f"{path}/{kind}")
    within = F.lit(False)
    for run, batch in done.items():
        within = within | ((F.col("run") == run) & (F.col("batch") <= f"{batch:012d}"))
    return rows.where(within)


def read_rejects(spark: SparkSession, path: str) -> DataFrame:
    """Rejected lines with the reason."""
    return _committed(spark, path, "rejects", REJECTS).select("value", "reason")


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """``file, imports, accepted, ignored, rejected``: the lines submitted from each file over all its imports."""
    counts = [F.sum(name).alias(name) for name in ("accepted", "ignored", "rejected")]
    rows = _committed(spark, path, "ledger", LEDGER)
    return rows.groupBy("file").agg(F.count("*").alias("imports"), *counts)
