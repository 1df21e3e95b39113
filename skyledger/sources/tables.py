"""Raw and derived tables: scans, appends, rebuilds, views."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from datetime import date

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyledger import DEFAULT_BY
from skyledger.schemas import RAW_TABLES, TIME_KEY, conform


def read_raw(
    spark: SparkSession,
    root: str,
    table: str,
    since: date | None = None,
    until: date | None = None,
) -> DataFrame:
    """Scan a raw table, optionally only the days from ``since`` up to and without ``until``.

    The bounds select partition folders; rows without a time are in none of them.
    """
    try:
        df = spark.read.parquet(f"{root}/{table}")
    except AnalysisException as fault:  # nothing has been appended yet
        if fault.getCondition() not in ("UNABLE_TO_INFER_SCHEMA", "PATH_NOT_FOUND"):
            raise
        keys = [T.StructField(c, T.StringType()) for c in DEFAULT_BY]
        arrival = T.StructField("ingested_at", T.TimestampNTZType())
        fields = [*keys, arrival, *RAW_TABLES[table].fields, T.StructField("event_date", T.DateType())]
        df = spark.createDataFrame([], T.StructType(fields))
    if since is not None:
        df = df.filter(F.col("event_date") >= F.lit(since))
    if until is not None:
        df = df.filter(F.col("event_date") < F.lit(until))
    return df.drop("event_date", "batch")


def with_event_date(df: DataFrame, table: str) -> DataFrame:
    return df.withColumn("event_date", F.to_date(TIME_KEY[table]))


def append_raw(
    df: DataFrame,
    root: str,
    table: str,
    by: Sequence[str] = DEFAULT_BY,
    extra: Sequence[str] = (),
    batch: str | None = None,
    observed: Mapping[str, Column] | None = None,
) -> dict:
    """Append rows to a raw table, laid out for time and station filters. Returns the values of the
    ``observed`` aggregates over the rows, which are taken on the way.

    ``extra`` columns are stored beside the keys. Rebalancing by day gathers a day's rows into few
    files; the adaptive optimizer splits a hot day and merges small ones by their real sizes, and,
    unlike range partitioning, it needs no sampling pass that would parse the documents twice. The
    sort gives row groups narrow minima and maxima. An empty frame appends nothing.

    Rows of a named ``batch`` replace what a broken earlier run of the same batch has left.
    """
    rows = with_event_date(conform(df, RAW_TABLES[table], (*by, *extra)), table)
    seen = Observation() if observed else None
    if seen:
        rows = rows.observe(seen, *[c.alias(name) for name, c in observed.items()])
    rows = rows.hint("rebalance", "event_date").sortWithinPartitions("event_date", *by, *_sort_time(table))
    write_batch(rows, f"{root}/{table}", batch, "event_date")
    if not seen:
        return {}
    try:
        return seen.get
    except Py4JJavaError:
        # Where the plan turns out to be empty, the optimizer has dropped the aggregates with it.
        if df.isEmpty():
            return dict.fromkeys(observed, 0)
        raise


def write_batch(rows: DataFrame, path: str, batch: str | None, *parts: str) -> None:
    """Write the partitions of one batch; partitions of other batches stay."""
    name = F.lit(batch or uuid.uuid4().hex).alias("batch")
    (
        rows.select("*", name)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("batch", *parts)
        .parquet(path)
    )


def _sort_time(table: str) -> list[str]:
    """The time column, where it is finer than the day the table is partitioned by."""
    return [TIME_KEY[table]] if TIME_KEY[table] == "timestamp" else []


def rebuild_table(df: DataFrame, path: str, parts: Sequence[str] = ()) -> None:
    """Replace a small report table once the new one is complete; a failed run leaves the old one. Tables
    that must be readable at every moment are published in versions.

    ``df`` may read from ``path``."""
    spark = df.sparkSession
    fresh, old = (f"{path}.{word}-{uuid.uuid4().hex}" for word in ("new", "old"))
    df.write.partitionBy(*parts).parquet(fresh)
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    folder = hadoop(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    replaced = files.exists(folder) and files.rename(folder, hadoop(old))
    if not files.rename(hadoop(fresh), folder):
        if replaced:
            files.rename(hadoop(old), folder)
        raise OSError(f"could not put {fresh} in place of {path}")
    if replaced:
        files.delete(hadoop(old), True)


def as_view(df: DataFrame, name: str) -> DataFrame:
    """Register a lazy view and return the frame."""
    df.createOrReplaceTempView(name)
    return df


def adhoc(spark: SparkSession, query: str, **frames: DataFrame) -> DataFrame:
    """Run SQL over registered tables or over frames given as ``{name}``; the result stays lazy."""
    return spark.sql(query, **frames)
