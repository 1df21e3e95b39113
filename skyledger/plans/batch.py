"""The batch job: landed documents to raw tables, raw tables to marts."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger import DEFAULT_BY
from skyledger.operators.latest import latest_per_key
from skyledger.operators.quality import (
    failing_rows,
    metrics_report,
    metrics_verdict,
    not_null_report,
    observed_metrics,
    quality_verdict,
)
from skyledger.plans.daily import int_weather_summary
from skyledger.plans.incremental import refresh_rolling
from skyledger.plans.marts import trends_of, weather_summary
from skyledger.schemas import RAW_TABLES, TIME_KEY
from skyledger.sources.documents import split_valid
from skyledger.sources.forecast import daily_rows, hourly_rows
from skyledger.sources.observation import observation_rows
from skyledger.sources.tables import append_raw, read_raw, rebuild_table, write_batch
from skyledger.sources.versions import publish, read_table

FLATTENERS = {
    "current": ("current_weather", observation_rows),
    "hourly": ("hourly_weather", hourly_rows),
    "daily": ("daily_weather", daily_rows),
}


# Time of arrival, kept beside the keys so that repeated polls can be told apart later.
ARRIVAL = "ingested_at"


def ingest(
    docs: DataFrame, kind: str, root: str, by: Sequence[str] = DEFAULT_BY, batch: str | None = None
) -> None:
    """Append one kind of documents to its raw table; misshapen ones go to a quarantine table.

    The documents are listed and read once for both. The flatteners skip misshapen documents by
    themselves. A named ``batch`` can be run again and gives the same tables. The figures that the
    quality report needs are taken while the rows are written, and stored with the batch.
    """
    table, flatten = FLATTENERS[kind]
    spark, batch = docs.sparkSession, batch or uuid.uuid4().hex
    docs = docs.persist()
    observed = observed_metrics(table, TIME_KEY[table])
    figures = append_raw(flatten(docs, (*by, ARRIVAL)), root, table, by, (ARRIVAL,), batch, observed)
    _, bad = split_valid(docs, kind)
    write_batch(bad, f"{root}/quarantine/{kind}", batch)
    docs.unpersist()
    figures = [(table, name, float(value)) for name, value in figures.items()]
    rows = spark.createDataFrame(figures, "table_name string, metric string, value double")
    write_batch(rows.coalesce(1), f"{root}/quality/metrics/of={table}", batch)


def newest(spark: SparkSession, root: str, table: str, by: Sequence[str], **days) -> DataFrame:
    """Rows of a raw table, the last arrival only for each station and time.

    All feeds are polled again and again; repeats would inflate counts and means, and repeated
    dates would fan out through the joins.
    """
    time = TIME_KEY[table]
    tie_break = [c for c in RAW_TABLES[table].names if c != time]
    return latest_per_key(read_raw(spark, root, table, **days), [*by, time], ARRIVAL, tie_break)


def build_marts(
    spark: SparkSession,
    root: str,
    run_ts: datetime,
    by: Sequence[str] = DEFAULT_BY,
    since: date | None = None,
    until: date | None = None,
) -> dict[str, DataFrame]:
    """Build the reconciled days from the raw tables, and both marts from the stored days.

    The days are written once and read back: a lost executor costs no recomputation of the rollups. With
    ``since`` or ``until`` only those days are read from the raw tables and replaced, in the daily summary
    too; the rolling windows are brought up to date with the rows around those days, and the trend mart,
    whose seasons span all years, is made from the stored windows. All tables are published in versions.
    """
    place = {n: f"{root}/{n}" for n in ("int_weather_summary", "weather_summary", "rolling_days", "weather_trends")}
    some = {"since": since, "until": until}
    feeds = [newest(spark, root, t, by, **some) for t in RAW_TABLES]
    publish(int_weather_summary(*feeds, by), place["int_weather_summary"], **some)
    changed = read_table(spark, place["int_weather_summary"], **some)
    publish(weather_summary(changed, by, run_ts), place["weather_summary"], **some)
    refresh_rolling(spark, place["int_weather_summary"], place["rolling_days"], since, until, by)
    publish(trends_of(read_table(spark, place["rolling_days"]), by, run_ts), place["weather_trends"])
    return {n: read_table(spark, path) for n, path in place.items()}


def check_quality(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """Run the not-null tests and the verdict over the raw tables and store their results.

    ``quality/report`` has the severity of each test, ``quality/failures`` every failing row,
    ``quality/verdict`` the checks of the whole.
    """
    tables = {t: (read_raw(spark, root, t), TIME_KEY[t]) for t in RAW_TABLES}
    results = {
        "report": not_null_report(tables),
        "failures": failing_rows(tables),
        "verdict": quality_verdict(*(df for df, _ in tables.values())),
    }
    for name, df in results.items():
        rebuild_table(df, f"{root}/quality/{name}")
    return {name: spark.read.parquet(f"{root}/quality/{name}") for name in results}


def quality_of_ingests(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """Report and verdict as :func:`check_quality` has them, from the figures stored by ``ingest``: a few
    rows for each batch are read, no raw table."""
    metrics = spark.read.parquet(f"{root}/quality/metrics").select("table_name", "metric", "value")
    return {"report": metrics_report(metrics, TIME_KEY), "verdict": metrics_verdict(metrics)}
