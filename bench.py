"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; one JSON line on stdout."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from feedfold.plans.catalogue import QUERIES  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))

# Batch queries run once to warm up, then RUNS times; the last three write tables and run once.
HEADLINES = (
    "posts_merge_daily",
    "posts_metrics_full_outer",
    "snapshot_merge",
    "upsert_coalesce",
    "child_merge",
    "latest_row_per_key",
    "latest_all_ties",
    "split_attachments",
    "split_other",
    "turns_rebuild",
    "json_infer_parse",
    "json_nested_roundtrip",
    "classify_posts",
    "schema_align",
)
WRITING = ("clustered_snapshot", "partition_upsert_roundtrip", "stream_upsert")


def run(spark: SparkSession, name: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("feedfold-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    times: dict[str, float] = {}
    for name in HEADLINES:
        run(spark, name)
        times[name] = round(statistics.median(run(spark, name) for _ in range(RUNS)), 3)
    for name in WRITING:
        times[name] = round(run(spark, name), 3)
    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "headline_queries_total", "value": total, "unit": "sec", "queries": times, "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf")}))


if __name__ == "__main__":
    main()
