"""Rolling windows of changed days only, with the neighbouring rows they need."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger import DEFAULT_BY
from skyledger.operators.trend import known_average
from skyledger.plans.marts import LONGEST_WINDOW, rolled_days
from skyledger.sources.versions import publish, read_table, stored_days, table_exists

#: Calendar days read first for each row of a window.
DAYS_PER_ROW = 2


def _short(asked: DataFrame, halo: DataFrame, rows: int, by: Sequence[str]) -> bool:
    """Whether a station with rows in ``asked`` has fewer than ``rows`` in ``halo``."""
    marked = known_average(asked).select(*by, F.lit(0).alias("n")).unionAll(
        known_average(halo).select(*by, F.lit(1).alias("n"))
    )
    counts = marked.groupBy(*by).agg(F.count_if(F.col("n") == 0).alias("asked"), F.sum("n").alias("near"))
    return not counts.filter((F.col("asked") > 0) & (F.col("near") < rows)).isEmpty()


def halo_start(
    spark: SparkSession, path: str, since: date, until: date | None, rows: int, by: Sequence[str] = DEFAULT_BY
) -> date:
    """First day to read so that every station with rows from ``since`` has ``rows`` known rows before
    them, or all it has. Windows count rows, not days; the stretch is doubled until it is long enough."""
    first = min(stored_days(spark, path), default=str(since))
    span = DAYS_PER_ROW * rows
    while True:
        start = since - timedelta(days=span)
        if str(start) <= first:
            return start
        asked, halo = read_table(spark, path, since, until), read_table(spark, path, start, since)
        if not _short(asked, halo, rows, by):
            return start
        span *= 2


def reach_end(
    spark: SparkSession, path: str, until: date | None, rows: int, by: Sequence[str] = DEFAULT_BY
) -> date | None:
    """Day before which the windows of later rows still reach back over ``until``: every station has
    ``rows`` known rows in between, or no more after. None where that is the end of the table."""
    if until is None:
        return None
    last = max(stored_days(spark, path), default=str(until))
    span = DAYS_PER_ROW * rows
    while True:
        end = until + timedelta(days=span)
        if last < str(end):
            return None
        near, later = read_table(spark, path, until, end), read_table(spark, path, end)
        if not _short(later, near, rows, by):
            return end
        span *= 2


def refresh_rolling(
    spark: SparkSession,
    days_path: str,
    path: str,
    since: date | None = None,
    until: date | None = None,
    by: Sequence[str] = DEFAULT_BY,
) -> None:
    """Bring the stored rolling windows up to date after the days from ``since`` to before ``until`` have
    changed in the stored reconciled days. Reads those days, the rows before them that their windows hold
    and the rows after them whose windows hold them, and replaces just the days whose windows change."""
    if since is None or not table_exists(spark, path):
        publish(rolled_days(read_table(spark, days_path), by), path)
        return
    rows = LONGEST_WINDOW - 1
    end = reach_end(spark, days_path, until, rows, by)
    start = halo_start(spark, days_path, since, end, rows, by)
    rolled = rolled_days(read_table(spark, days_path, start, end), by)
    changed = rolled.filter(F.col("date") >= F.lit(since))
    publish(changed, path, since=since, until=end)
