"""Time the headline queries; prints one JSON line.

Each query runs once untimed and then three times; its time is the median. Every row of the result is
computed and thrown away.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from feedloom.plans.registry import QUERIES
from feedloom.session import build_session

HEADLINE = (
    "text_search", "text_search_batch", "hash_encode", "knn_top5", "knn_batch_top5",
    "knn_blocked_top5", "feed_filter", "feed_flatten", "feed_verdicts", "import_valid",
    "import_rejects", "posts_upsert", "posts_first_wins", "posts_legacy_view", "pending_queue",
    "embedding_writeback", "vector_blob_roundtrip", "export_posts", "export_chunks", "export_grid",
    "consolidate_union", "hour_key_counts", "count_by_day", "sql_where", "stream_bronze",
    "stream_upsert", "tail_source", "stream_replay", "stream_older", "stream_embedding", "stream_dead",
    "feed_to_search",
)
STREAMS = (
    "consolidate_union", "stream_bronze", "stream_upsert", "tail_source", "stream_replay", "stream_older",
    "stream_embedding", "stream_dead", "feed_to_search",
)


def run(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "feedloom-bench",
        f"local[{cpus}]",
        spark_sql_shuffle_partitions=cpus,
        spark_driver_memory="12g",
        spark_ui_showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in HEADLINE:
        runs = [run(spark, name, sf_dir) for _ in range(2 if name in STREAMS else 4)]
        times[name] = round(statistics.median(runs[1:]), 3)
    result = {
        "metric": "headline_queries_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": sf_dir.rstrip("/").rsplit("/sf", 1)[-1],
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
