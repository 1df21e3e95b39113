"""Daily rollups.

Both rollups combine on the map side with fixed-width buffers, so a station or a day that holds a
large share of all readings costs no more shuffle than any other.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger import DEFAULT_BY
from skyledger.functions.rules import TEMP_CATEGORY, WIND_CATEGORY

DAY_FIRST_HOUR, DAY_LAST_HOUR = 6, 18

_AVERAGED = ("temp", "feels_like", "humidity", "pressure", "wind_speed")


def event_day() -> Column:
    return F.to_date("timestamp").alias("date")


def most_frequent(value: Column | str, count: Column | str) -> Column:
    """Aggregate: the value with the highest ``count``; ties go to the smallest value, NULL is
    ignored. The input has one row per distinct value."""
    value = F.col(value) if isinstance(value, str) else value
    count = F.col(count) if isinstance(count, str) else count
    return F.min_by(value, F.when(value.isNotNull(), F.struct(-count, value)))


def most_frequent_label(counts: Mapping[str, Column]) -> Column:
    """The label with the highest count; ties go to the alphabetically first one."""
    best = F.greatest(*counts.values())
    ordered = sorted(counts)
    out = F.when(counts[ordered[0]] == best, ordered[0])
    for label in ordered[1:]:
        out = out.when(counts[label] == best, label)
    return F.when(best > 0, out)


def daily_mode(
    df: DataFrame, value: str, by: Sequence[str] = DEFAULT_BY, out: str | None = None
) -> DataFrame:
    """Most frequent value of a column per day; ties go to the smallest value.

    Counting distinct values first keeps every buffer small: the group that would hold a whole
    hot day's values is never built.
    """
    counted = df.groupBy(*by, event_day(), value).agg(F.count("*").alias("n"))
    return counted.groupBy(*by, "date").agg(most_frequent(value, "n").alias(out or value))


def observation_partials(staged: DataFrame, *keys: Column | str) -> DataFrame:
    """First rollup level: one row per key and description, with mergeable partial measures."""
    measures = [F.count("*").alias("n"), F.min("temp").alias("lo"), F.max("temp").alias("hi")]
    for c in _AVERAGED:
        measures += [F.sum(c).alias(f"sum_{c}"), F.count(c).alias(f"n_{c}")]
    for column, ladder in (("temp_category", TEMP_CATEGORY), ("wind_category", WIND_CATEGORY)):
        measures += [
            F.count_if(F.col(column) == label).alias(f"{column}={label}")
            for label in ladder.labels
        ]
    return staged.groupBy(*keys, "description").agg(*measures)


def merge_observations(partials: DataFrame, *keys: Column | str) -> DataFrame:
    """Second rollup level: merge the partial rows of all descriptions of a key."""
    measures = [F.sum("n").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi")]
    measures.append(most_frequent("description", "n").alias("most_common_description"))
    additive = [c for c in partials.columns if c.startswith(("sum_", "n_")) or "=" in c]
    measures += [F.sum(F.col(f"`{c}`")).alias(c) for c in additive]
    return partials.groupBy(*keys).agg(*measures)


def finish_observations(merged: DataFrame, *keys: Column | str) -> DataFrame:
    """Turn merged measures into the daily summary columns."""

    def mean(c: str) -> Column:
        return F.col(f"sum_{c}") / F.nullif(F.col(f"n_{c}"), F.lit(0))

    def category(column: str, labels: Sequence[str]) -> Column:
        return most_frequent_label({x: F.col(f"`{column}={x}`") for x in labels})

    return merged.select(
        *keys,
        mean("temp").alias("avg_temp"),
        F.col("lo").alias("min_temp"),
        F.col("hi").alias("max_temp"),
        *[mean(c).alias(f"avg_{c}") for c in _AVERAGED[1:]],
        F.col("n").alias("readings_count"),
        "most_common_description",
        category("temp_category", TEMP_CATEGORY.labels).alias("most_common_temp_category"),
        category("wind_category", WIND_CATEGORY.labels).alias("most_common_wind_category"),
    )


def current_daily_summary(staged: DataFrame, by: Sequence[str] = DEFAULT_BY) -> DataFrame:
    """One row per day of staged observations: averages, extremes, count and three modes.

    Two levels: the first counts per description with plain hash aggregation (partial on the map
    side), the second merges the few rows left per day. A single aggregation with mode() would
    build maps per group and fall back to sorting all readings.
    """
    partials = observation_partials(staged, *by, event_day())
    return finish_observations(merge_observations(partials, *by, "date"), *by, "date")


def hourly_daily_summary(staged: DataFrame, by: Sequence[str] = DEFAULT_BY) -> DataFrame:
    """One row per day of staged hourly forecasts, with daytime and night-time averages."""
    return staged.groupBy(*by, event_day()).agg(
        F.avg("temp").alias("avg_temp_hourly"),
        F.min("temp").alias("min_temp_hourly"),
        F.max("temp").alias("max_temp_hourly"),
        F.avg("humidity").alias("avg_humidity_hourly"),
        F.avg("wind_speed").alias("avg_wind_speed_hourly"),
        F.avg("pop").alias("avg_precipitation_probability"),
        F.count("*").alias("hourly_readings_count"),
        *_day_and_night(),
    )


def day_night_profile(staged: DataFrame, by: Sequence[str] = DEFAULT_BY) -> DataFrame:
    """Average temperature of the hours 6…18 and of the other hours, per day."""
    return staged.groupBy(*by, event_day()).agg(*_day_and_night())


def _day_and_night() -> list[Column]:
    is_day = F.col("hour_of_day").between(DAY_FIRST_HOUR, DAY_LAST_HOUR)
    return [
        F.avg(F.when(is_day, F.col("temp"))).alias("avg_daytime_temp"),
        F.avg(F.when(~is_day, F.col("temp"))).alias("avg_nighttime_temp"),
    ]
