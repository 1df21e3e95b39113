"""Data quality: not-null tests with severities, completeness, verdict."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Failing rows above which a test warns or errors.
WARN_ABOVE = 10
ERROR_ABOVE = 100


def not_null_failures(df: DataFrame, column: str) -> DataFrame:
    """Rows that fail the not-null test of a column."""
    return df.filter(F.col(column).isNull())


def severity(failing: Column) -> Column:
    return (
        F.when(failing > ERROR_ABOVE, "error").when(failing > WARN_ABOVE, "warn").otherwise("pass")
    )


def not_null_report(tables: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """One row per tested table: failing rows and severity."""
    rows = [
        df.agg(F.count_if(F.col(column).isNull()).alias("failing_rows")).select(
            F.lit(name).alias("table_name"),
            F.lit(column).alias("column_name"),
            "failing_rows",
            severity(F.col("failing_rows")).alias("status"),
        )
        for name, (df, column) in tables.items()
    ]
    return _stack(rows)


def failing_rows(tables: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """All failing rows with the table and column they failed on, for a quarantine table."""
    rows = [
        not_null_failures(df, column).withColumns(
            {"table_name": F.lit(name), "column_name": F.lit(column)}
        )
        for name, (df, column) in tables.items()
    ]
    return _stack(rows)


def _stack(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out


def current_quality(df: DataFrame) -> DataFrame:
    """Completeness counts and means of the observation table."""
    return df.agg(
        F.count("*").alias("total_records"),
        *[
            F.count(c).alias(f"{c}_count")
            for c in ("temp", "humidity", "pressure", "wind_speed")
        ],
        F.count_if(F.length("description") > 0).alias("description_count"),
        *[F.avg(c).alias(f"avg_{c}") for c in ("temp", "humidity", "pressure")],
    )


def hourly_quality(df: DataFrame) -> DataFrame:
    """Coverage of the hourly table: rows, days, time range."""
    return df.agg(
        F.count("*").alias("total_records"),
        F.count_distinct(F.to_date("timestamp")).alias("unique_days"),
        F.min("timestamp").alias("earliest_time"),
        F.max("timestamp").alias("latest_time"),
        F.avg("temp").alias("avg_temp"),
        F.count("pop").alias("pop_count"),
    )


def daily_quality(df: DataFrame) -> DataFrame:
    """Plausibility of the daily table: rows, complete pairs, pairs in order."""
    low, high = F.col("temp_min"), F.col("temp_max")
    return df.agg(
        F.count("*").alias("total_records"),
        F.min("date").alias("earliest_date"),
        F.max("date").alias("latest_date"),
        F.avg(high).alias("avg_temp_max"),
        F.avg(low).alias("avg_temp_min"),
        F.count_if(low.isNotNull() & high.isNotNull()).alias("complete_pairs"),
        F.count_if(high >= low).alias("ordered_pairs"),
        F.count_if(high > low).alias("strictly_ordered_pairs"),
    )


def quality_verdict(current: DataFrame, hourly: DataFrame, daily: DataFrame) -> DataFrame:
    """One row of checks and the overall verdict.

    A table without rows is left out of the verdict. Means that do not exist count as 0. The
    pressure check is reported only.
    """

    def mean(c: str) -> Column:
        return F.coalesce(F.avg(c), F.lit(0.0))

    pair = F.col("temp_min").isNotNull() & F.col("temp_max").isNotNull()
    c = current.agg(
        F.count("*").alias("current_rows"),
        (F.count("temp") / F.nullif(F.count("*"), F.lit(0)) > 0.8).alias("temp_complete"),
        mean("temp").between(-40, 45).alias("temp_reasonable"),
        mean("humidity").between(0, 100).alias("humidity_valid"),
        mean("pressure").between(900, 1100).alias("pressure_valid"),
    )
    h = hourly.agg(
        F.count("*").alias("hourly_rows"),
        (F.count("*") >= 12).alias("hourly_enough"),
        mean("pop").between(0, 1).alias("pop_valid"),
    )
    d = daily.agg(
        F.count_if(pair).alias("daily_rows"),
        (F.count_if(pair) >= 3).alias("daily_enough"),
        (F.count_if(F.col("temp_max") >= F.col("temp_min")) == F.count_if(pair)).alias(
            "temp_order_valid"
        ),
    )
    # Three one-row frames become one row by stacking them and taking the value each column has.
    stacked = _stack([c, h, d])
    side = stacked.agg(*[F.max(name).alias(name) for name in stacked.columns])
    return side.withColumn("quality_passed", _passed())


def _passed() -> Column:
    return (
        ((F.col("current_rows") == 0)
         | (F.col("temp_complete") & F.col("temp_reasonable") & F.col("humidity_valid")))
        & ((F.col("hourly_rows") == 0) | (F.col("hourly_enough") & F.col("pop_valid")))
        & ((F.col("daily_rows") == 0) | (F.col("daily_enough") & F.col("temp_order_valid")))
    )


# --- the same from figures taken while rows are written ---------------------------------------

_MEANS = {"current_weather": ("temp", "humidity", "pressure"), "hourly_weather": ("pop",), "daily_weather": ()}


def observed_metrics(table: str, time: str) -> dict[str, Column]:
    """Counts and sums of a raw table's rows that the report and the verdict follow from. They add up over
    batches, and they can be observed on the plan that writes the rows: no scan of their own."""
    out = {"rows": F.count("*"), "no_time": F.count_if(F.col(time).isNull())}
    for c in _MEANS[table]:
        out |= {f"{c}_n": F.count(c), f"{c}_sum": F.coalesce(F.sum(F.col(c).cast("double")), F.lit(0.0))}
    if table == "daily_weather":
        low, high = F.col("temp_min"), F.col("temp_max")
        out |= {"pairs": F.count_if(low.isNotNull() & high.isNotNull()), "ordered": F.count_if(high >= low)}
    return out


def _total(table: str, metric: str) -> Column:
    mine = (F.col("table_name") == table) & (F.col("metric") == metric)
    return F.coalesce(F.sum(F.when(mine, F.col("value"))), F.lit(0.0))


def metrics_report(metrics: DataFrame, times: Mapping[str, str]) -> DataFrame:
    """:func:`not_null_report` from stored figures (table_name, metric, value); tables that never were
    written are left out."""
    failing = F.sum(F.when(F.col("metric") == "no_time", F.col("value"))).cast("long")
    column = F.create_map(*[F.lit(x) for pair in times.items() for x in pair])[F.col("table_name")]
    sums = metrics.groupBy("table_name").agg(failing.alias("failing_rows"))
    return sums.select("table_name", column.alias("column_name"), "failing_rows", severity(F.col("failing_rows")).alias("status"))


def metrics_verdict(metrics: DataFrame) -> DataFrame:
    """:func:`quality_verdict` from stored figures (table_name, metric, value)."""

    def mean(table: str, c: str) -> Column:
        n = _total(table, f"{c}_n")
        return F.when(n > 0, _total(table, f"{c}_sum") / n).otherwise(0.0)

    rows = _total("current_weather", "rows")
    pairs = _total("daily_weather", "pairs")
    hourly = _total("hourly_weather", "rows")
    side = metrics.agg(
        rows.cast("long").alias("current_rows"),
        (_total("current_weather", "temp_n") / F.nullif(rows, F.lit(0.0)) > 0.8).alias("temp_complete"),
        mean("current_weather", "temp").between(-40, 45).alias("temp_reasonable"),
        mean("current_weather", "humidity").between(0, 100).alias("humidity_valid"),
        mean("current_weather", "pressure").between(900, 1100).alias("pressure_valid"),
        hourly.cast("long").alias("hourly_rows"),
        (hourly >= 12).alias("hourly_enough"),
        mean("hourly_weather", "pop").between(0, 1).alias("pop_valid"),
        pairs.cast("long").alias("daily_rows"),
        (pairs >= 3).alias("daily_enough"),
        (_total("daily_weather", "ordered") == pairs).alias("temp_order_valid"),
    )
    return side.withColumn("quality_passed", _passed())
