"""Time the headline queries: prints one JSON line.

``BENCH_SF_DIR`` names the table folder, ``BENCH_CPUS`` the local cores. Every query is run in full
into the no-op sink, once to warm up and then ``BENCH_RUNS`` times; the median is reported.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import SparkSession

from checks.queries import REGISTRY

HEADLINE = (
    "ingest_observation",
    "ingest_hourly",
    "ingest_daily",
    "ingest_combined_hourly",
    "stg_current_weather",
    "stg_hourly_weather",
    "stg_daily_weather",
    "current_daily_summary",
    "hourly_daily_summary",
    "daily_mode",
    "int_weather_summary",
    "weather_summary",
    "weather_trends",
    "weather_alerts",
    "moving_avg_7",
    "seasonal_rank",
    "latest_per_key",
    "latest_observation",
    "unexpired_entries",
    "profile_report",
    "quality_verdict",
    "warehouse_summary",
    "wind_text_to_mps",
    "coverage_region",
)


def session(cpus: str) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def seconds(spark: SparkSession, sf_dir: str, name: str) -> float:
    start = time.perf_counter()
    REGISTRY[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = session(os.environ.get("BENCH_CPUS", "8"))
    timings = {}
    for name in HEADLINE:
        first = seconds(spark, sf_dir, name)
        taken = [seconds(spark, sf_dir, name) for _ in range(runs)]
        timings[name] = round(statistics.median(taken), 3)
        print(f"{name} first {first:.2f} then {timings[name]:.2f}", file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
