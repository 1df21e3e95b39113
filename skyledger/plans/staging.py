"""Cleaning models: one narrow projection per raw table, labels and calendar parts added."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger import DEFAULT_BY
from skyledger.functions.clock import day_of_week
from skyledger.functions.rules import (
    CURRENT_RANGES,
    DAILY_RANGES,
    HOURLY_RANGES,
    POP_CATEGORY,
    TEMP_CATEGORY,
    WIND_CATEGORY,
    band,
    null_out_of_range,
    season,
)
from skyledger.schemas import RAW_CURRENT, RAW_DAILY, RAW_HOURLY


def clean_current(raw: DataFrame, by: Sequence[str] = DEFAULT_BY) -> DataFrame:
    return null_out_of_range(raw.select(*by, *RAW_CURRENT.names), CURRENT_RANGES)


def clean_hourly(raw: DataFrame, by: Sequence[str] = DEFAULT_BY) -> DataFrame:
    return null_out_of_range(raw.select(*by, *RAW_HOURLY.names), HOURLY_RANGES)


def clean_daily(raw: DataFrame, by: Sequence[str] = DEFAULT_BY) -> DataFrame:
    return null_out_of_range(raw.select(*by, *RAW_DAILY.names), DAILY_RANGES)


def stg_current_weather(raw: DataFrame, by: Sequence[str] = DEFAULT_BY) -> DataFrame:
    """Observations with a time: plausible values, temperature and wind labels."""
    timed = raw.filter(F.col("timestamp").isNotNull())
    return clean_current(timed, by).select(
        "*",
        band("temp", TEMP_CATEGORY).alias("temp_category"),
        band("wind_speed", WIND_CATEGORY).alias("wind_category"),
    )


def stg_hourly_weather(raw: DataFrame, by: Sequence[str] = DEFAULT_BY) -> DataFrame:
    """Hourly forecasts with a time: plausible values, three labels, hour and weekday."""
    timed = raw.filter(F.col("timestamp").isNotNull())
    return clean_hourly(timed, by).select(
        "*",
        band("temp", TEMP_CATEGORY).alias("temp_category"),
        band("wind_speed", WIND_CATEGORY).alias("wind_category"),
        band("pop", POP_CATEGORY).alias("precipitation_probability"),
        F.hour("timestamp").alias("hour_of_day"),
        day_of_week("timestamp").alias("day_of_week"),
    )


def stg_daily_weather(raw: DataFrame, by: Sequence[str] = DEFAULT_BY) -> DataFrame:
    """Daily forecasts with a date: plausible values, mean and range, labels, season."""
    dated = raw.filter(F.col("date").isNotNull())
    low, high = F.col("temp_min"), F.col("temp_max")
    mean = (high + low) / F.lit(2)
    return clean_daily(dated, by).select(
        "*",
        mean.alias("temp_avg"),
        (high - low).alias("temp_range"),
        band(mean, TEMP_CATEGORY).alias("temp_category"),
        band("wind_speed", WIND_CATEGORY).alias("wind_category"),
        band("pop", POP_CATEGORY).alias("precipitation_probability"),
        day_of_week("date").alias("day_of_week"),
        F.month("date").alias("month"),
        season(F.month("date")).alias("season"),
    )
