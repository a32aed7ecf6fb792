"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR names the folder of Parquet tables, BENCH_CPUS the local threads. Each query runs
once to warm up and then BENCH_RUNS times (default 3); the best time counts. Results are computed
whole and thrown away.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from checks.queries import QUERIES  # noqa: E402

HEADLINE = ("stamp_activities", "activity_analysis", "contact_analysis", "daily_roster",
            "daily_manager", "current_manager", "dim_view", "scd2_run", "join_point_in_interval",
            "tenure_metrics")


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINE
    shared = tempfile.TemporaryDirectory(prefix="bench-")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", shared.name)
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in names:
        taken = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - start)
        times[name] = round(min(taken[1:] or taken), 3)
    print(json.dumps({
        "metric": "total seconds of the headline queries", "value": round(sum(times.values()), 3),
        "unit": "sec", "queries": times,
        "sf": os.path.basename(os.path.normpath(folder)).removeprefix("sf"),
    }))
    spark.stop()
    shared.cleanup()


if __name__ == "__main__":
    main()
