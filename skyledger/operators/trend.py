"""Windows over reconciled days.

All windows run at day grain, after the rollups, and are partitioned by station: a partition holds
one row per calendar day however many readings the station sent.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from skyledger import DEFAULT_BY


def by_date(by: Sequence[str] = DEFAULT_BY, order: str = "date") -> WindowSpec:
    """Days of each station in order. ``by=()`` is for one site: all its days then form one partition,
    which is bounded by the calendar, as rows are day grain."""
    return Window.partitionBy(*by).orderBy(F.col(order).asc_nulls_last())


def last_rows(n: int, by: Sequence[str] = DEFAULT_BY, order: str = "date") -> WindowSpec:
    """The current and the ``n - 1`` preceding rows. Rows, not days: gaps are not filled."""
    return by_date(by, order).rowsBetween(1 - n, Window.currentRow)


def rolling(
    df: DataFrame,
    rows: int,
    measures: Mapping[str, Column],
    by: Sequence[str] = DEFAULT_BY,
    order: str = "date",
) -> DataFrame:
    """Add aggregates over the last ``rows`` rows of each station, one column per measure."""
    window = last_rows(rows, by, order)
    return df.withColumns({name: agg.over(window) for name, agg in measures.items()})


def known_average(days: DataFrame) -> DataFrame:
    """Days that take part in trends: those with an average temperature."""
    return days.filter(F.col("final_avg_temp").isNotNull())


def direction(value: Column, window: WindowSpec) -> Column:
    """increasing / decreasing against the previous row, else stable (the first row included)."""
    previous = F.lag(value, 1).over(window)
    return (
        F.when(value > previous, "increasing")
        .when(value < previous, "decreasing")
        .otherwise("stable")
    )


def moving_averages(
    days: DataFrame, rows: int, columns: Mapping[str, str], by: Sequence[str] = DEFAULT_BY
) -> DataFrame:
    """Moving averages of the given columns (source to output name)."""
    measures = {out: F.avg(c) for c, out in columns.items()}
    return rolling(known_average(days), rows, measures, by)


def rolling_volatility(days: DataFrame, by: Sequence[str] = DEFAULT_BY) -> DataFrame:
    """Sample standard deviation of the average temperature over seven rows."""
    return rolling(
        known_average(days), 7, {"temp_7day_volatility": F.stddev_samp("final_avg_temp")}, by
    )


def trend_direction(days: DataFrame, by: Sequence[str] = DEFAULT_BY) -> DataFrame:
    return known_average(days).withColumn(
        "temp_trend_direction", direction(F.col("final_avg_temp"), by_date(by))
    )


def seasonal(days: DataFrame, by: Sequence[str] = DEFAULT_BY) -> DataFrame:
    """Seasonal average, deviation from it, and rank by temperature (1 = warmest, with gaps).

    Days without a season form a season of their own.
    """
    whole = Window.partitionBy(*by, "season")
    warmest_first = whole.orderBy(F.col("final_avg_temp").desc_nulls_last())
    # The rank first: its sort serves the average, which then needs none of its own.
    ranked = known_average(days).withColumn("temp_rank_in_season", F.rank().over(warmest_first))
    averaged = ranked.withColumn("seasonal_avg_temp", F.avg("final_avg_temp").over(whole))
    deviation = F.col("final_avg_temp") - F.col("seasonal_avg_temp")
    return averaged.withColumn("temp_deviation_from_seasonal_avg", deviation)
