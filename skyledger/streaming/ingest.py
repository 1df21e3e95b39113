"""Incremental ingest of landed documents, and removal of repeated polls."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from skyledger import DEFAULT_BY
from skyledger.plans.batch import ingest
from skyledger.session import checkpoint_root

EVENT_TIME = "event_time"


def trigger(interval: str | None) -> dict:
    return {"availableNow": True} if interval is None else {"processingTime": interval}


def ingest_stream(
    docs: DataFrame,
    kind: str,
    root: str,
    job: str,
    by: Sequence[str] = DEFAULT_BY,
    interval: str | None = None,
    checkpoint: str | None = None,
) -> StreamingQuery:
    """Flatten newly landed documents of one kind into its raw table, each file exactly once.

    Each micro-batch goes through the batch ingest, which reads its documents once for rows and
    quarantine and sizes its files by the volume. A batch that is run again after a failure replaces
    its own partitions. ``interval`` ("10 minutes") polls; without it all waiting files are taken
    and the query ends. ``job`` is the lasting name of the query: its progress is kept under it in
    the cluster's shared checkpoint folder, or in ``checkpoint`` where the cluster names none.
    """
    place = f"{checkpoint_root(docs.sparkSession, checkpoint)}/{job}/ingest_{kind}"

    def take(batch: DataFrame, number: int) -> None:
        ingest(batch, kind, root, by, f"{job}-{number:010d}")

    return (
        docs.writeStream.foreachBatch(take)
        .option("checkpointLocation", place)
        .trigger(**trigger(interval))
        .start()
    )


def with_event_time(rows: DataFrame, delay: str, time: str = "timestamp") -> DataFrame:
    """Add the event time (an instant, as watermarks need one) and its watermark."""
    if EVENT_TIME in rows.columns:  # a step before has set it; a watermark can't be set twice
        return rows
    timed = rows.withColumn(EVENT_TIME, F.col(time).cast("timestamp"))
    return timed.withWatermark(EVENT_TIME, delay)


def drop_repeated_polls(
    rows: DataFrame, delay: str, by: Sequence[str] = DEFAULT_BY, time: str = "timestamp"
) -> DataFrame:
    """Keep the first row per station and time; repeats up to ``delay`` apart are recognised.

    State is kept per key and dropped once the watermark has passed it.
    """
    timed = with_event_time(rows, delay, time)
    return timed.dropDuplicatesWithinWatermark([*by, EVENT_TIME])
