"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose data and cores. Every query
is run in full into a sink that discards the rows; the best of BENCH_RUNS (default 2) runs counts.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidewatch.plans.queries import all_queries  # noqa: E402
from tidewatch.session import build_session  # noqa: E402

HEADLINE = [
    "batch_rollup", "model_scores", "additive_scores", "daily_panel", "dedup_panel", "drift_flags",
    "train_windows", "weekly_fit", "dense_calendar", "history_profile", "dimension_rollup", "latest_runs",
    "closing_rollups", "next_purchase_of_all", "compare_chains", "user_executions", "log_seconds",
    "price_quantiles", "wide_model_records", "stream_daily", "stream_monitor",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_RUNS", "2"))
    spark = build_session(
        "tidewatch-bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "12g",
            # The stages compute much per byte, so small partitions are worth a task of their own.
            "spark.sql.adaptive.coalescePartitions.minPartitionSize": "32k",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = all_queries()
    seconds: dict[str, float] = {}
    for name in HEADLINE:
        best = float("inf")
        for _ in range(repeats):
            started = time.time()
            queries[name](spark, folder).write.format("noop").mode("overwrite").save()
            best = min(best, time.time() - started)
        seconds[name] = round(best, 3)
    spark.stop()
    line = {
        "metric": "headline_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": float(os.path.basename(folder.rstrip("/")).removeprefix("sf")),
    }
    print(json.dumps(line))


if __name__ == "__main__":
    main()
