"""Table statistics and metric reports, as tall tables."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def table_stats(tables: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """Row count and newest time per table, and a ``total`` row with the sum of the counts."""
    rows = None
    for name, (df, time) in tables.items():
        one = df.agg(
            F.count("*").alias("records"),
            F.max(F.col(time).cast("timestamp_ntz")).alias("latest_update"),
        ).select(F.lit(name).alias("table_name"), "records", "latest_update")
        rows = one if rows is None else rows.unionByName(one)
    return (
        rows.rollup("table_name")
        .agg(F.sum("records").alias("records"), F.max("latest_update").alias("latest_update"))
        .withColumn("table_name", F.coalesce("table_name", F.lit("total")))
    )


def warehouse_summary(
    raw: Mapping[str, DataFrame], marts: Mapping[str, DataFrame]
) -> DataFrame:
    """Row count per table with its layer, and one total per layer."""
    rows = None
    for layer, frames in (("raw", raw), ("analytics", marts)):
        for name, df in frames.items():
            one = df.agg(F.count("*").alias("records")).select(
                F.lit(layer).alias("layer"), F.lit(name).alias("table_name"), "records"
            )
            rows = one if rows is None else rows.unionByName(one)
    return (
        rows.rollup("layer", "table_name")
        .agg(F.sum("records").alias("records"))
        .filter(F.col("layer").isNotNull())
        .withColumn("table_name", F.coalesce("table_name", F.lit("total")))
    )


def counts_as_of(
    current: DataFrame, hourly: DataFrame, daily: DataFrame, today: date
) -> DataFrame:
    """All observations, hourly rows of ``today``, daily rows from ``today`` on, and their sum.

    The day is a half-open time range, so the test reaches the file statistics.
    """
    start = F.lit(today).cast("timestamp_ntz")
    end = F.date_add(F.lit(today), 1).cast("timestamp_ntz")
    one_day = hourly.filter((F.col("timestamp") >= start) & (F.col("timestamp") < end))
    ahead = daily.filter(F.col("date") >= F.lit(today))
    rows = None
    for name, df in (
        ("current_records", current),
        ("hourly_records_today", one_day),
        ("daily_forecast_records", ahead),
    ):
        one = df.agg(F.count("*").alias("records")).select(F.lit(name).alias("metric"), "records")
        rows = one if rows is None else rows.unionByName(one)
    return (
        rows.rollup("metric")
        .agg(F.sum("records").alias("records"))
        .withColumn("metric", F.coalesce("metric", F.lit("total_records")))
    )


def _metrics(df: DataFrame, table: str, metrics: Mapping[str, Column]) -> DataFrame:
    """One row per metric: all aggregates in one pass, then unpivoted."""
    wide = df.agg(*[c.cast("double").alias(n) for n, c in metrics.items()])
    return wide.unpivot([], list(metrics), "metric", "value").withColumn(
        "table_name", F.lit(table)
    )


def profile_report(current: DataFrame, hourly: DataFrame, daily: DataFrame) -> DataFrame:
    """Global averages and extremes per table as (metric, value, table_name)."""
    parts = [
        _metrics(
            current,
            "current_weather",
            {
                "record_count": F.count("*"),
                "avg_temp": F.avg("temp"),
                "min_temp": F.min("temp"),
                "max_temp": F.max("temp"),
                "avg_humidity": F.avg("humidity"),
                "avg_pressure": F.avg("pressure"),
                "avg_wind_speed": F.avg("wind_speed"),
            },
        ),
        _metrics(
            hourly,
            "hourly_weather",
            {
                "record_count": F.count("*"),
                "unique_days": F.count_distinct(F.to_date("timestamp")),
                "avg_temp": F.avg("temp"),
                "avg_precipitation_prob": F.avg("pop"),
            },
        ),
        _metrics(
            daily,
            "daily_weather",
            {
                "record_count": F.count("*"),
                "avg_temp_max": F.avg("temp_max"),
                "avg_temp_min": F.avg("temp_min"),
                "avg_precipitation_prob": F.avg("pop"),
            },
        ),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])
