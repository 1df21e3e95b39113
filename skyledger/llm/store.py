"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from skyledger.session import checkpoint_root


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path below the cluster's checkpoint folder; a temporary folder only where none is named,
    as in tests on one machine."""
    if spark.conf.get("spark.checkpoint.dir", None) is None:
        spark.conf.set("spark.checkpoint.dir", "file://" + tempfile.mkdtemp(prefix="skyledger-"))
    return f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back: cuts the lineage, survives executors."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def passing(df: DataFrame, name: str) -> DataFrame:
    """``staged``, and what was shuffled for it leaves the disk."""
    conf, key = df.sparkSession.conf, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = conf.get(key, None)
    conf.set(key, "true")
    try:
        # A plan keeps the setting under which it was made.
        return staged(df.select("*"), name)
    finally:
        conf.unset(key) if before is None else conf.set(key, before)


def forget(df: DataFrame) -> None:
    """Delete a staged table that nothing reads any more."""
    spark = df.sparkSession
    for folder in {file.rsplit("/", 1)[0] for file in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
