"""As-of join with a time limit: the newest entry of a key that is valid at a reading's time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _second(c: str) -> Column:
    return F.unix_micros(F.col(c).cast("timestamp"))


def entry_at(
    readings: DataFrame,
    entries: DataFrame,
    keys: Sequence[str],
    time: str,
    cached_at: str,
    ttl_seconds: int,
    tie_break: Sequence[str] = (),
) -> DataFrame:
    """``readings`` with the struct ``entry``: the newest of ``entries`` of the same keys from the
    reading's time or before, where it is no older than the limit; NULL where there is none. Entries of
    one time go to the greatest ``tie_break`` values. NULL keys match nothing, as in a join; readings
    without a time have no entry; both are kept.

    Readings and entries are put into one table and sorted by time, and the last entry is carried on: one
    shuffle, no comparison of pairs. The key of the shuffle holds a stretch of time as long as the limit.
    An entry goes into its own stretch and the next, beyond which it is too old; so a key with very many
    rows is spread over as many tasks as it has stretches.
    """
    limit = ttl_seconds * 1_000_000
    stretch = lambda c: F.floor(_second(c) / F.lit(max(limit, 1))).cast("long")
    whole_reading, whole_entry = F.struct(*readings.columns), F.struct(*entries.columns)
    own = readings.select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)],
        stretch(time).alias("_stretch"),
        _second(time).alias("_at"),
        F.lit(1).alias("_kind"),
        whole_reading.alias("_reading"),
        F.lit(None).cast(entries.select(whole_entry.alias("e")).schema["e"].dataType).alias("_entry"),
        F.lit(None).cast(entries.select(F.struct(F.lit(0), *tie_break).alias("t")).schema["t"].dataType).alias("_tie"),
    )
    usable = F.col(cached_at).isNotNull()
    for k in keys:
        usable = usable & F.col(k).isNotNull()
    given = entries.filter(usable).select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)],
        F.explode(F.array(stretch(cached_at), stretch(cached_at) + 1)).alias("_stretch"),
        _second(cached_at).alias("_at"),
        F.lit(0).alias("_kind"),
        F.lit(None).cast(readings.select(whole_reading.alias("r")).schema["r"].dataType).alias("_reading"),
        whole_entry.alias("_entry"),
        F.struct(F.lit(0), *tie_break).alias("_tie"),
    )
    so_far = (
        Window.partitionBy(*[f"_k{i}" for i in range(len(keys))], "_stretch")
        .orderBy("_at", "_kind", F.asc_nulls_first("_tie"))
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    carried = F.last(F.when(F.col("_kind") == 0, F.struct("_at", "_entry")), ignorenulls=True).over(so_far)
    joined = own.unionByName(given).withColumn("_last", carried).filter("_kind = 1")
    fresh = F.col("_at") - F.col("_last._at") <= limit
    entry = F.when(fresh, F.col("_last._entry"))
    return joined.select(*[F.col(f"_reading.`{c}`").alias(c) for c in readings.columns], entry.alias("entry"))
