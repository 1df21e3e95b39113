"""The reconciled day: every source's view of a station's day in one row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from skyledger import DEFAULT_BY
from skyledger.operators.reconcile import reconcile
from skyledger.operators.rollup import current_daily_summary, hourly_daily_summary
from skyledger.plans.staging import stg_current_weather, stg_daily_weather, stg_hourly_weather


def int_weather_summary(
    raw_current: DataFrame,
    raw_hourly: DataFrame,
    raw_daily: DataFrame,
    by: Sequence[str] = DEFAULT_BY,
) -> DataFrame:
    """Staging, both rollups, and the two full outer joins.

    ``by=()`` gives the single-site form. A day repeated in the daily feed fans out, as it does in
    SQL; run ``latest_per_key`` on the feed first where it is polled repeatedly.
    """
    return reconcile(
        current_daily_summary(stg_current_weather(raw_current, by), by),
        hourly_daily_summary(stg_hourly_weather(raw_hourly, by), by),
        stg_daily_weather(raw_daily, by),
        by,
    )
