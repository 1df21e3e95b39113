"""Marts over the reconciled day: daily summary, trends, alerts."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyledger import DEFAULT_BY
from skyledger.functions.numbers import round_to
from skyledger.functions.rules import (
    BUSINESS_POP_PERCENT,
    BUSINESS_TEMP,
    BUSINESS_WIND,
    band,
    extreme_indicator,
    temperature_anomaly,
    temperature_stability,
    weather_pattern,
)
from skyledger.functions.units import MPH_PER_MPS
from skyledger.operators.trend import by_date, direction, known_average, last_rows, seasonal


def stamped(df: DataFrame, run_ts: datetime | None) -> DataFrame:
    """Add the build time, given by the caller so that a rebuild is reproducible."""
    if run_ts is None:
        return df
    return df.withColumn("last_updated_at", F.lit(run_ts).cast("timestamp_ntz"))


def weather_summary(
    days: DataFrame, by: Sequence[str] = DEFAULT_BY, run_ts: datetime | None = None
) -> DataFrame:
    """Rounded daily metrics and business labels.

    The wind and precipitation labels look at the rounded figures shown in the row, the
    temperature label at the unrounded average.
    """
    rounded = days.filter(F.col("date").isNotNull()).select(
        *by,
        "date",
        round_to("final_avg_temp", 1).alias("avg_temperature_celsius"),
        round_to("final_min_temp", 1).alias("min_temperature_celsius"),
        round_to("final_max_temp", 1).alias("max_temperature_celsius"),
        round_to("avg_feels_like", 1).alias("feels_like_temperature_celsius"),
        round_to("day_night_temp_difference", 1).alias("day_night_temp_difference_celsius"),
        round_to("avg_humidity", 0).alias("avg_humidity_percent"),
        round_to("avg_pressure", 0).alias("avg_pressure_hpa"),
        round_to("avg_wind_speed", 1).alias("avg_wind_speed_mps"),
        round_to(F.col("avg_wind_speed") * MPH_PER_MPS, 1).alias("avg_wind_speed_mph"),
        _percent("avg_precipitation_probability").alias("precipitation_probability_percent"),
        _percent("forecast_precipitation_probability").alias(
            "forecast_precipitation_probability_percent"
        ),
        F.col("most_common_description").alias("primary_weather_condition"),
        F.col("forecast_description").alias("forecast_weather_condition"),
        F.col("most_common_temp_category").alias("temperature_category"),
        F.col("most_common_wind_category").alias("wind_category"),
        F.col("forecast_temp_category").alias("forecast_temperature_category"),
        "forecast_wind_category",
        "season",
        F.month("date").alias("month_number"),
        F.year("date").alias("year"),
        F.col("readings_count").alias("current_weather_readings"),
        F.col("hourly_readings_count").alias("hourly_forecast_readings"),
        round_to("temp_variance_current_vs_hourly", 2).alias(
            "temperature_variance_current_vs_forecast"
        ),
        band("final_avg_temp", BUSINESS_TEMP).alias("business_temperature_category"),
    )
    labelled = rounded.select(
        "*",
        band("avg_wind_speed_mps", BUSINESS_WIND).alias("business_wind_category"),
        band("precipitation_probability_percent", BUSINESS_POP_PERCENT).alias(
            "business_precipitation_risk"
        ),
    )
    return stamped(labelled, run_ts)


def _percent(c: str) -> Column:
    return round_to(F.col(c) * 100, 1)


# Rows of the longest window.
LONGEST_WINDOW = 30

_SEASON_MEASURES = (
    "seasonal_avg_temp",
    "temp_deviation_from_seasonal_avg",
    "temp_rank_in_season",
)


def weather_trends(
    days: DataFrame, by: Sequence[str] = DEFAULT_BY, run_ts: datetime | None = None
) -> DataFrame:
    """Rolling, seasonal and pattern columns in one pass over the reconciled days.

    Days without an average temperature are kept with empty trend columns but take part in no
    window: they sit in window partitions of their own, told apart by ``has_avg``. One shuffle (by
    station and flag) serves the date windows and the season windows alike, since the season
    partitions lie inside it. Needs one row per station and date; with repeated dates use
    :func:`weather_trends_by_joins`, which fans out.
    """
    return trends_of(rolled_days(days, by), by, run_ts)


def rolled_days(days: DataFrame, by: Sequence[str] = DEFAULT_BY) -> DataFrame:
    """The reconciled days with ``has_avg`` and the columns over the last rows of a station."""
    flagged = days.withColumn("has_avg", F.col("final_avg_temp").isNotNull())
    site = (*by, "has_avg")
    temp = F.col("final_avg_temp")
    ordered, week, month = by_date(site), last_rows(7, site), last_rows(LONGEST_WINDOW, site)
    measures = {
        "temp_7day_moving_avg": F.avg(temp).over(week),
        "temp_30day_moving_avg": F.avg(temp).over(month),
        "humidity_7day_moving_avg": F.avg("avg_humidity").over(week),
        "wind_7day_moving_avg": F.avg("avg_wind_speed").over(week),
        "temp_7day_volatility": F.stddev_samp(temp).over(week),
        "temp_trend_direction": direction(temp, ordered),
    }
    return flagged.withColumns({name: F.when(F.col("has_avg"), c) for name, c in measures.items()})


def trends_of(
    dated: DataFrame, by: Sequence[str] = DEFAULT_BY, run_ts: datetime | None = None
) -> DataFrame:
    """The trend mart from days that have their rolling columns (:func:`rolled_days`)."""
    temp = F.col("final_avg_temp")
    whole = Window.partitionBy(*by, "has_avg", "season")
    # The rank first: its sort serves the average, which then needs none of its own.
    ranked = dated.withColumn("temp_rank_in_season", F.rank().over(whole.orderBy(temp.desc_nulls_last())))
    seasoned = ranked.withColumn("seasonal_avg_temp", F.avg(temp).over(whole)).withColumn(
        "temp_deviation_from_seasonal_avg", temp - F.col("seasonal_avg_temp")
    )
    masked = seasoned.withColumns(
        {name: F.when(F.col("has_avg"), F.col(name)) for name in _SEASON_MEASURES}
    ).withColumns(
        {
            "daily_temp_range": F.when(
                F.col("has_avg"), F.col("final_max_temp") - F.col("final_min_temp")
            ),
            **{name: F.when(F.col("has_avg"), c) for name, c in _patterns().items()},
        }
    )
    return stamped(_trend_columns(masked, by), run_ts)


def weather_trends_by_joins(
    days: DataFrame, by: Sequence[str] = DEFAULT_BY, run_ts: datetime | None = None
) -> DataFrame:
    """The same result by three left joins back on station and date; repeated dates fan out."""
    keys = [*by, "date"]
    known = known_average(days)
    week, month, ordered = last_rows(7, by), last_rows(30, by), by_date(by)
    temp = F.col("final_avg_temp")
    trend = known.select(
        *keys,
        F.avg(temp).over(week).alias("temp_7day_moving_avg"),
        F.avg(temp).over(month).alias("temp_30day_moving_avg"),
        F.avg("avg_humidity").over(week).alias("humidity_7day_moving_avg"),
        F.avg("avg_wind_speed").over(week).alias("wind_7day_moving_avg"),
        F.stddev_samp(temp).over(week).alias("temp_7day_volatility"),
        direction(temp, ordered).alias("temp_trend_direction"),
        (F.col("final_max_temp") - F.col("final_min_temp")).alias("daily_temp_range"),
    )
    season = seasonal(days, by).select(*keys, *_SEASON_MEASURES)
    pattern = known.select(*keys, *[c.alias(name) for name, c in _patterns().items()])
    joined = (
        days.join(trend, keys, "left").join(season, keys, "left").join(pattern, keys, "left")
    )
    return stamped(_trend_columns(joined, by), run_ts)


def _patterns() -> dict[str, Column]:
    temp, pop = F.col("final_avg_temp"), F.col("avg_precipitation_probability")
    return {
        "weather_pattern": weather_pattern(temp, pop),
        "extreme_weather_indicator": extreme_indicator(temp, F.col("avg_wind_speed"), pop),
    }


def _trend_columns(days: DataFrame, by: Sequence[str]) -> DataFrame:
    return days.filter(F.col("date").isNotNull()).select(
        *by,
        "date",
        round_to("final_avg_temp", 1).alias("avg_temperature_celsius"),
        round_to("final_min_temp", 1).alias("min_temperature_celsius"),
        round_to("final_max_temp", 1).alias("max_temperature_celsius"),
        round_to("avg_humidity", 0).alias("avg_humidity_percent"),
        round_to("avg_wind_speed", 1).alias("avg_wind_speed_mps"),
        _percent("avg_precipitation_probability").alias("precipitation_probability_percent"),
        round_to("temp_7day_moving_avg", 1).alias("temperature_7day_moving_avg"),
        round_to("temp_30day_moving_avg", 1).alias("temperature_30day_moving_avg"),
        round_to("humidity_7day_moving_avg", 0).alias("humidity_7day_moving_avg"),
        round_to("wind_7day_moving_avg", 1).alias("wind_7day_moving_avg"),
        round_to("daily_temp_range", 1).alias("daily_temperature_range"),
        "temp_trend_direction",
        round_to("temp_7day_volatility", 2).alias("temperature_7day_volatility"),
        "season",
        round_to("seasonal_avg_temp", 1).alias("seasonal_average_temperature"),
        round_to("temp_deviation_from_seasonal_avg", 1).alias(
            "temperature_deviation_from_seasonal_avg"
        ),
        "temp_rank_in_season",
        "weather_pattern",
        "extreme_weather_indicator",
        temperature_anomaly(F.col("temp_deviation_from_seasonal_avg")).alias(
            "temperature_anomaly"
        ),
        temperature_stability(F.col("temp_7day_volatility")).alias("temperature_stability"),
    )


def weather_alerts(trends: DataFrame) -> DataFrame:
    """Days with an extreme; days without an average temperature raise no alert."""
    return trends.filter(F.col("extreme_weather_indicator") != "normal")
