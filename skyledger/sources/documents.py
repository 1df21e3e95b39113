"""Landed JSON documents: reading, parsing, and shape checks.

A document frame has the ``by`` keys, ``body`` (JSON text) and ``ingested_at`` (zone-less UTC time
of arrival). The flatteners parse a body once, with ``from_json`` and the columns they need. Where
"key absent" and "key with JSON null" mean different things, or the JSON type matters, the field is
declared VARIANT: it is SQL NULL if the key is absent and a void variant for JSON null. Plain types
are used for all other fields, since reading a value out of a VARIANT costs several times as much.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

DOCUMENT_KINDS = ("points", "current", "hourly", "daily")


def read_documents(spark: SparkSession, path: str, *, per_line: bool = False) -> DataFrame:
    """Read landed documents, one per file or (``per_line``) one per line.

    Folders named ``location_id=…`` become the location column. The time of arrival is the file's
    modification time, so that a re-read gives the same rows.
    """
    return _named(spark.read.format("text").option("wholetext", not per_line).load(path))


def stream_documents(
    spark: SparkSession,
    path: str,
    *,
    per_line: bool = False,
    max_files_per_trigger: int = 10_000,
) -> DataFrame:
    """Streaming twin of :func:`read_documents`."""
    return _named(
        spark.readStream.format("text")
        .schema("value STRING, location_id STRING")
        .option("wholetext", not per_line)
        .option("maxFilesPerTrigger", max_files_per_trigger)
        .load(path)
    )


def _named(lines: DataFrame) -> DataFrame:
    keys = [F.col("location_id").cast("string")] if "location_id" in lines.columns else []
    return lines.select(
        *keys,
        F.col("value").alias("body"),
        F.col("_metadata.file_modification_time").cast("timestamp_ntz").alias("ingested_at"),
    )


def parsed(docs: DataFrame, body: str = "body", out: str = "doc") -> DataFrame:
    """Add the parsed document; unreadable text gives NULL."""
    return docs.withColumn(out, F.try_parse_json(F.col(body)))


def at(v: Column, path: str, type_name: str = "variant") -> Column:
    """Value at a JSON path as the given type; NULL if absent or of another shape."""
    return F.try_variant_get(v, path, type_name)


def is_present(v: Column, path: str) -> Column:
    """The key exists, whatever its value."""
    return at(v, path).isNotNull()


def text(v: Column) -> Column:
    """A VARIANT scalar as text; NULL if absent or JSON null."""
    return F.try_variant_get(v, "$", "string")


def text_only(v: Column) -> Column:
    """The text of a JSON string; NULL for every other JSON type."""
    return F.when(F.schema_of_variant(v) == "STRING", text(v))


def text_or_unknown(v: Column) -> Column:
    """Condition text: an absent key gives 'Unknown', JSON null stays NULL."""
    return F.when(v.isNull(), "Unknown").otherwise(text(v))


def array_at(v: Column, path: str) -> Column:
    """The elements if the value is a JSON array, else NULL."""
    return at(v, path, "array<variant>")


def is_object(v: Column) -> Column:
    return at(v, "$", "map<string,variant>").isNotNull()


def _shape_fault(v: Column, kind: str) -> Column:
    """First fault of a document of the given kind; NULL if it has none."""
    if kind not in DOCUMENT_KINDS:
        raise ValueError(f"unknown document kind {kind!r}; expected one of {DOCUMENT_KINDS}")
    fault = (
        F.when(v.isNull(), "unreadable")
        .when(~is_object(v), "not_an_object")
        .when(~is_present(v, "$.properties"), "properties_missing")
    )
    if kind == "points":
        for key in ("forecast", "forecastHourly"):
            fault = fault.when(~is_present(v, f"$.properties.{key}"), f"{key}_missing")
    elif kind == "current":
        fault = fault.when(~is_present(v, "$.properties.temperature"), "temperature_missing")
    else:
        fault = fault.when(~is_present(v, "$.properties.periods"), "periods_missing").when(
            array_at(v, "$.properties.periods").isNull(), "periods_not_a_list"
        )
    return fault


def validate_documents(docs: DataFrame, kind: str, body: str = "body") -> DataFrame:
    """Add ``is_valid`` and ``reason`` (NULL when valid) for the expected document shape."""
    checked = parsed(docs, body, "_doc").withColumn("reason", _shape_fault(F.col("_doc"), kind))
    return checked.withColumn("is_valid", F.col("reason").isNull()).drop("_doc")


def validate_as_kinds(docs: DataFrame, kinds: tuple[str, ...] = DOCUMENT_KINDS, body: str = "body") -> DataFrame:
    """One row per document and kind with ``kind``, ``reason``, ``is_valid``; a body is parsed once."""
    checks = [F.struct(F.lit(k).alias("kind"), _shape_fault(F.col("_doc"), k).alias("reason")) for k in kinds]
    keys = [c for c in docs.columns if c != body]
    # The faults are worked out before the explode, beside the parsed document.
    faults = parsed(docs, body, "_doc").select(*keys, F.array(*checks).alias("_faults"))
    return faults.select(*keys, F.inline("_faults")).withColumn("is_valid", F.col("reason").isNull())


def split_valid(docs: DataFrame, kind: str, body: str = "body") -> tuple[DataFrame, DataFrame]:
    """Good documents, and the rest with their ``reason`` for a quarantine table."""
    checked = validate_documents(docs, kind, body)
    good = checked.filter("is_valid").drop("is_valid", "reason")
    return good, checked.filter("NOT is_valid").drop("is_valid")
