"""The daily observation rollup over an unbounded stream of readings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from skyledger import DEFAULT_BY
from skyledger.operators.rollup import (
    finish_observations,
    merge_observations,
    observation_partials,
)
from skyledger.plans.staging import stg_current_weather
from skyledger.session import checkpoint_root
from skyledger.sources.observation import observation_rows
from skyledger.sources.tables import write_batch
from skyledger.streaming.ingest import EVENT_TIME, drop_repeated_polls, trigger, with_event_time


def daily_rollup_stream(
    raw: DataFrame, delay: str, by: Sequence[str] = DEFAULT_BY
) -> DataFrame:
    """Daily summary of each closed day, in append mode.

    A day is emitted once the watermark has passed its end; readings later than ``delay`` are
    dropped. Both levels of the batch rollup are used, chained on the same one-day window, so the
    state holds a fixed-width row per station, day and description and no list of values.
    """
    timed = with_event_time(raw, delay)
    staged = stg_current_weather(timed, (*by, EVENT_TIME))
    day = F.window(EVENT_TIME, "1 day").alias("day")
    merged = merge_observations(observation_partials(staged, *by, day), *by, "day")
    date = F.col("day.start").cast("date").alias("date")
    return finish_observations(merged, *by, date)


def rollup_stream(
    docs: DataFrame,
    root: str,
    job: str,
    delay: str,
    by: Sequence[str] = DEFAULT_BY,
    interval: str | None = None,
    checkpoint: str | None = None,
) -> StreamingQuery:
    """Landed observations to ``current_daily_summary``: repeated polls dropped, days as they close."""
    rows = drop_repeated_polls(observation_rows(docs, by), delay, by)
    place = f"{checkpoint_root(docs.sparkSession, checkpoint)}/{job}/rollup"

    def store(closed: DataFrame, number: int) -> None:
        write_batch(closed, f"{root}/current_daily_summary", f"{job}-{number:010d}")

    return (
        daily_rollup_stream(rows, delay, by)
        .writeStream.foreachBatch(store)
        .outputMode("append")
        .option("checkpointLocation", place)
        .trigger(**trigger(interval))
        .start()
    )
