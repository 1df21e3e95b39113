"""Session settings the library relies on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Times without an offset are read as UTC; AQE coalesces small and splits skewed shuffle partitions.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings above to a session somebody else built."""
    for key, value in REQUIRED_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def checkpoint_root(spark: SparkSession, fallback: str | None = None) -> str:
    """Shared checkpoint folder named by the cluster; ``fallback`` only where none is named."""
    root = spark.conf.get("spark.checkpoint.dir", None) or fallback
    if root is None:
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    return root.rstrip("/")
