"""Raw table schemas and conformance."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyledger import DEFAULT_BY

_TYPES = {
    "TIMESTAMP": T.TimestampNTZType(),
    "DATE": T.DateType(),
    "REAL": T.FloatType(),
    "INTEGER": T.IntegerType(),
    "TEXT": T.StringType(),
}


def _schema(columns: str) -> T.StructType:
    pairs = [c.split() for c in columns.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


# Column names, order and types of the three raw tables.
RAW_CURRENT = _schema(
    "timestamp TIMESTAMP, temp REAL, feels_like REAL, humidity INTEGER, pressure INTEGER, "
    "wind_speed REAL, wind_deg INTEGER, description TEXT, icon TEXT"
)
RAW_HOURLY = T.StructType([*RAW_CURRENT.fields, T.StructField("pop", _TYPES["REAL"])])
RAW_DAILY = _schema(
    "date DATE, temp_min REAL, temp_max REAL, temp_day REAL, temp_night REAL, humidity INTEGER, "
    "pressure INTEGER, wind_speed REAL, wind_deg INTEGER, description TEXT, icon TEXT, pop REAL"
)

RAW_TABLES = {
    "current_weather": RAW_CURRENT,
    "hourly_weather": RAW_HOURLY,
    "daily_weather": RAW_DAILY,
}
TIME_KEY = {"current_weather": "timestamp", "hourly_weather": "timestamp", "daily_weather": "date"}


def conform(df: DataFrame, schema: T.StructType, by: Sequence[str] = DEFAULT_BY) -> DataFrame:
    """Select the schema's columns by name, in order, cast to its types, after the ``by`` keys."""
    return df.select(*by, *[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])


def missing_columns(df: DataFrame, schema: T.StructType) -> list[str]:
    """Required columns the frame lacks, sorted."""
    return sorted({f.name for f in schema} - set(df.columns))


def missing_relations(spark: SparkSession, names: Sequence[str]) -> list[str]:
    """Expected tables or views that the catalog does not hold, sorted."""
    return sorted(n for n in names if not spark.catalog.tableExists(n))


def create_raw_tables(spark: SparkSession, by: Sequence[str] = DEFAULT_BY) -> None:
    """Create the three raw tables, partitioned by event day, where they do not exist yet."""
    keys = "".join(f"{k} STRING, " for k in by)
    for name, schema in RAW_TABLES.items():
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema)
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} ({keys}{columns}, event_date DATE) "
            "USING parquet PARTITIONED BY (event_date)"
        )


def insert_raw(df: DataFrame, table: str, by: Sequence[str] = DEFAULT_BY) -> None:
    """Append rows to a table made by :func:`create_raw_tables`, matched by name."""
    rows = conform(df, RAW_TABLES[table], by)
    rows.withColumn("event_date", F.to_date(TIME_KEY[table])).write.insertInto(table)
