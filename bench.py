"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from doclog.plans import catalog  # noqa: E402

HEADLINE = {
    "q_replay": "events",
    "q_replay_base": "orders",
    "q_replay_lineitem": "lineitem",
    "q_replay_conv": "conversations",
    "q_replay_targets": "events",
    "q_update_by_query": "events",
    "q_outcomes": "events",
    "q_roll_size": "events",
    "q_roll_marker": "events",
    "q_order_log": "lineitem",
    "q_route_items": "events",
    "q_flatten_bulk": "events",
    "q_capture_replay": "events",
}


def session() -> SparkSession:
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("doclog-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
    )
    spark = spark.config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="doclog-bench-")).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = session()
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    catalog.QUERIES["q_replay"](spark, sf_dir).write.format("noop").mode("overwrite").save()  # warm-up
    seconds, rate = {}, {}
    for name, source in HEADLINE.items():
        rows = spark.read.parquet(f"{sf_dir}/{source}.parquet").count()
        best = None
        for _ in range(runs):
            began = time.perf_counter()
            catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            took = time.perf_counter() - began
            best = took if best is None else min(best, took)
        seconds[name] = round(best, 3)
        rate[name] = round(rows / best)
    print(
        json.dumps(
            {
                "metric": "headline queries, best of runs, total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "requests_per_sec": rate,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
