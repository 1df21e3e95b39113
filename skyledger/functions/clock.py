"""Times: ISO texts, epoch seconds, calendar parts. The session time zone must be UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def iso_to_utc(text: Column) -> Column:
    """ISO-8601 text (with or without offset) as a zone-less UTC time; NULL if unreadable."""
    return text.try_cast("timestamp").cast("timestamp_ntz")


def iso_local_date(text: Column) -> Column:
    """Calendar date in the text's own offset; NULL if the text is no time."""
    return F.when(text.try_cast("timestamp").isNotNull(), text.try_cast("date"))


def epoch_to_utc(seconds: Column) -> Column:
    """Unix seconds as a zone-less UTC time."""
    return F.timestamp_seconds(seconds).cast("timestamp_ntz")


def day_of_week(c: Column | str) -> Column:
    """0 = Sunday … 6 = Saturday."""
    return F.dayofweek(c) - F.lit(1)
