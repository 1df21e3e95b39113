"""Latest rows: globally, per key, and per key with an age limit."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(
    df: DataFrame, keys: Sequence[str], order: str, tie_break: Sequence[str] = ()
) -> DataFrame:
    """The newest row per key by ``order``; equal times go to the greatest ``tie_break`` values.

    Spark limits each key to one row before the shuffle (WindowGroupLimit), so a key with very
    many versions sends one row per task.
    """
    newest = [F.col(c).desc_nulls_last() for c in (order, *tie_break)]
    ranked = df.withColumn("_rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*newest)))
    return ranked.filter("_rn = 1").drop("_rn")


def most_recent(df: DataFrame, order: str, n: int, tie_break: Sequence[str] = ()) -> DataFrame:
    """The ``n`` newest rows of the whole table: a distributed top-n, no full sort."""
    newest = [F.col(c).desc_nulls_last() for c in (order, *tie_break)]
    return df.orderBy(*newest).limit(n)


def cutoff(now: datetime, ttl_seconds: int) -> Column:
    """Oldest time that is still fresh. An entry exactly ``ttl`` old is fresh."""
    return F.lit(now).cast("timestamp_ntz") - F.make_dt_interval(secs=F.lit(ttl_seconds))


def unexpired_entries(
    df: DataFrame,
    keys: Sequence[str],
    cached_at: str,
    now: datetime,
    ttl_seconds: int,
    tie_break: Sequence[str] = (),
) -> DataFrame:
    """Newest entry per key, where it is no older than the time to live.

    The age test runs first, at the scan: the newest entry of a key is fresh exactly when any is.
    """
    fresh = df.filter(F.col(cached_at) >= cutoff(now, ttl_seconds))
    return latest_per_key(fresh, keys, cached_at, tie_break)


def freshness_stats(
    df: DataFrame, keys: Sequence[str], cached_at: str, now: datetime, ttl_seconds: int
) -> DataFrame:
    """Total, expired and valid keys; a key is as old as its newest entry."""
    newest = df.groupBy(*keys).agg(F.max(cached_at).alias("at"))
    expired = F.col("at") < cutoff(now, ttl_seconds)
    return newest.agg(
        F.count("*").alias("total_entries"),
        F.count_if(expired).alias("expired_entries"),
        (F.count("*") - F.count_if(expired)).alias("valid_entries"),
        F.lit(ttl_seconds).alias("cache_ttl_seconds"),
    )
