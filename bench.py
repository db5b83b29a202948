"""Time the headline pipelines; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) names the data, BENCH_CPUS
(default 8) the local cores. Each query runs once to warm up, then three times;
the median counts. Results are consumed by Spark's no-op sink, so every row is
computed and none reaches the driver.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
from pulsewright.catalog.queries import all_queries  # noqa: E402

HEADLINE = (
    "bpm_features_backfill",
    "event_readings",
    "events_detail",
    "events_daily",
    "hrv_daily",
    "hrv_x_hour",
    "hrv_5min",
    "meal_describe",
    "sleep_bpm_flags",
    "meal_box",
    "describe_by_participant",
    "sdann",
    "tinn_rrtri",
)
RUNS = 3


def session(cpus: str) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def consume(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(run) -> float:
    started = time.perf_counter()
    consume(run())
    return time.perf_counter() - started


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    spark = session(os.environ.get("BENCH_CPUS", "8"))
    queries = all_queries()
    spent = {}
    for name in HEADLINE:
        run = lambda: queries[name](spark, sf_dir)
        timed(run)
        spent[name] = round(statistics.median(timed(run) for _ in range(RUNS)), 3)
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(spent.values()), 3),
                "unit": "sec",
                "queries": spent,
                "sf": os.path.basename(sf_dir).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
