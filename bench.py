"""Time the headline queries; prints one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the local cores, ``BENCH_RUNS`` the timed
runs per query (the median counts).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from stockpond.catalog import QUERIES, changes
from stockpond.operators import kept_summary
from stockpond.operators.history import VERSION
from stockpond.session import build_session, released

HEADLINE = [
    "category_revenue",
    "three_way_join_topk",
    "wide_sort_topk",
    "wide_sort_sink",
    "filtered_count",
    "global_row_number",
    "customer_running_total",
    "orders_over_time",
    "change_feed",
    "merge_apply",
    "incremental_summary",
    "full_refresh_summary",
    "state_as_of",
    "json_array_explode",
    "csv_idempotent_load",
    "stream_merge_apply",
    "customer_features",
    "pit_training_set",
    "forecast_14d",
    "feature_psi",
    "budget_crossings",
    "keyword_retrieve",
    "hybrid_retrieve",
]


def run(spark, name: str, sf_dir: str) -> float:
    with released(spark):
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start


def run_refresh(spark, sf_dir: str) -> float:
    """One refresh of the kept summary by itself: it is at version 1 and the feeds are stored before the clock starts."""
    with released(spark):
        root, log = changes.kept_buckets(spark, sf_dir)
        kept_summary.refresh(log, root, VERSION, 1)
        start = time.perf_counter()
        kept_summary.refresh(log, root, VERSION, 2)
        return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g", "spark.ui.enabled": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    run(spark, "category_revenue", sf_dir)
    timings = {n: round(statistics.median([run(spark, n, sf_dir) for _ in range(runs)]), 3) for n in names}
    if names is HEADLINE:
        timings["summary_refresh_alone"] = round(statistics.median([run_refresh(spark, sf_dir) for _ in range(runs)]), 3)
    total = round(sum(timings.values()), 3)
    print(json.dumps({"metric": "headline_queries_total", "value": total, "unit": "sec", "queries": timings, "sf": sf_dir.rsplit("sf", 1)[-1]}))


if __name__ == "__main__":
    main()
