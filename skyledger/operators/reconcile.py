"""Reconciliation of the observed, hourly and daily views of a day."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger import DEFAULT_BY

# Daily-forecast columns carried along, with their names in the reconciled row.
FORECAST_COLUMNS = {
    "temp_min": "forecast_temp_min",
    "temp_max": "forecast_temp_max",
    "temp_day": "forecast_temp_day",
    "temp_night": "forecast_temp_night",
    "humidity": "forecast_humidity",
    "wind_speed": "forecast_wind_speed",
    "pop": "forecast_precipitation_probability",
    "description": "forecast_description",
    "temp_category": "forecast_temp_category",
    "wind_category": "forecast_wind_category",
    "season": "season",
}


def reconcile_two(
    current: DataFrame, hourly: DataFrame, by: Sequence[str] = DEFAULT_BY
) -> DataFrame:
    """Every day that either rollup knows. Both sides arrive hashed on the join key."""
    return current.join(hourly, [*by, "date"], "full_outer")


def reconcile(
    current: DataFrame, hourly: DataFrame, daily: DataFrame, by: Sequence[str] = DEFAULT_BY
) -> DataFrame:
    """Every day that any source knows, with the three views side by side and merged metrics.

    Days repeated in ``daily`` stay repeated; pass it through :func:`latest_per_key` first where
    the feed is polled more than once.
    """
    forecast = daily.select(*by, "date", *[F.col(c).alias(n) for c, n in FORECAST_COLUMNS.items()])
    days = reconcile_two(current, hourly, by).join(forecast, [*by, "date"], "full_outer")
    return days.select(
        *by,
        "date",
        *[c for c in days.columns if c not in (*by, "date")],
        # The average has no forecast fallback; the extremes have one.
        F.coalesce("avg_temp", "avg_temp_hourly").alias("final_avg_temp"),
        F.coalesce("min_temp", "min_temp_hourly", "forecast_temp_min").alias("final_min_temp"),
        F.coalesce("max_temp", "max_temp_hourly", "forecast_temp_max").alias("final_max_temp"),
        source_gap().alias("temp_variance_current_vs_hourly"),
        day_night_gap().alias("day_night_temp_difference"),
    )


def source_gap():
    """Absolute difference of the two averages; NULL unless both exist."""
    return F.abs(F.col("avg_temp") - F.col("avg_temp_hourly"))


def day_night_gap():
    """Daytime minus night-time average; NULL unless both exist."""
    return F.col("avg_daytime_temp") - F.col("avg_nighttime_temp")
