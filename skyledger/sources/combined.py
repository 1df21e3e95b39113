"""The older combined payload: one document with ``current``, ``hourly`` and ``daily`` sections.

A section may be missing. A field missing inside a section makes the whole document unusable: such
documents yield no rows and :func:`combined_faults` names the reason.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger import DEFAULT_BY
from skyledger.functions.clock import epoch_to_utc
from skyledger.sources.documents import is_object, is_present, parsed

# Required keys.
SECTIONS = ("current", "hourly", "daily")
READING_KEYS = ("dt", "temp", "feels_like", "humidity", "pressure", "wind_speed", "wind_deg")
DAY_TEMPS = ("min", "max", "day", "night")
WEATHER_KEYS = ("description", "icon")


def _members(names: Sequence[str]) -> str:
    return ", ".join(f"{n}: VARIANT" for n in names)


# All fields VARIANT: a key has to be there, but may hold JSON null.
_WEATHER = f"weather: ARRAY<STRUCT<{_members(WEATHER_KEYS)}>>, pop: VARIANT"
_READING = f"STRUCT<{_members(READING_KEYS)}, {_WEATHER}>"
_DAY = (
    f"STRUCT<{_members([k for k in READING_KEYS if k != 'temp'])}, "
    f"temp: STRUCT<{_members(DAY_TEMPS)}>, {_WEATHER}>"
)
COMBINED = f"current {_READING}, hourly ARRAY<{_READING}>, daily ARRAY<{_DAY}>"


def _typed(docs: DataFrame, by: Sequence[str]) -> DataFrame:
    """Sections of each document and its first fault."""
    d = F.from_json("body", COMBINED)
    sections = docs.select(*by, "body", d.alias("d")).select(
        *by,
        "body",
        F.col("d.current").alias("current"),
        F.col("d.hourly").alias("hourly"),
        F.col("d.daily").alias("daily"),
    )
    return sections.withColumn("fault", _fault())


def _readable(v: Column, keys: Sequence[str]) -> Column:
    """Every needed key is there and the epoch is a number."""
    weather = F.get(v["weather"], F.lit(0))
    test = _number(v["dt"], "bigint").isNotNull()
    for item in (*(v[k] for k in keys), *(weather[k] for k in WEATHER_KEYS)):
        test = test & item.isNotNull()
    return test


def _readable_day(v: Column) -> Column:
    test = _readable(v, [k for k in READING_KEYS if k not in ("temp", "feels_like")])
    for k in DAY_TEMPS:
        test = test & v["temp"][k].isNotNull()
    return test


def _fault() -> Column:
    """First section that cannot be read. A typed section is NULL both when it is absent and when
    it is of another shape; the body is parsed again for that one question only."""

    def absent(section: str) -> Column:
        return ~is_present(F.try_parse_json("body"), f"$.{section}")

    def broken(section: str, readable: Column) -> Column:
        return F.when(F.col(section).isNotNull(), ~readable).otherwise(~absent(section))

    unread = F.col("current").isNull() & F.col("hourly").isNull() & F.col("daily").isNull()
    doc = F.try_parse_json("body")
    return (
        F.when(unread & doc.isNull(), "unreadable")
        .when(unread & ~is_object(doc), "not_an_object")
        .when(broken("current", _readable(F.col("current"), READING_KEYS)), "current_incomplete")
        .when(
            broken("hourly", F.forall("hourly", lambda h: _readable(h, READING_KEYS))),
            "hourly_incomplete",
        )
        .when(broken("daily", F.forall("daily", _readable_day)), "daily_incomplete")
    )


def combined_faults(docs: DataFrame) -> DataFrame:
    """Documents that yield no rows, with the reason."""
    keys = [c for c in docs.columns if c != "body"]
    checked = _typed(docs, keys).select(*keys, "body", F.col("fault").alias("reason"))
    return checked.filter(F.col("reason").isNotNull())


def validate_combined(docs: DataFrame) -> DataFrame:
    """Add ``is_valid`` and ``reason``: three sections, and eight fields in ``current``."""
    v = F.col("_doc")
    reason = F.when(v.isNull(), "unreadable")
    for section in SECTIONS:
        reason = reason.when(~is_present(v, f"$.{section}"), f"{section}_missing")
    for key in (*READING_KEYS, "weather"):
        reason = reason.when(~is_present(v, f"$.current.{key}"), f"current.{key}_missing")
    checked = parsed(docs, out="_doc").withColumn("reason", reason).drop("_doc")
    return checked.withColumn("is_valid", F.col("reason").isNull())


def _number(v: Column, type_name: str) -> Column:
    return F.try_variant_get(v, "$", type_name)


def _measures(e: Column) -> list[Column]:
    weather = F.get(e["weather"], F.lit(0))
    return [
        _number(e["humidity"], "int").alias("humidity"),
        _number(e["pressure"], "int").alias("pressure"),
        _number(e["wind_speed"], "double").alias("wind_speed"),
        _number(e["wind_deg"], "int").alias("wind_deg"),
        _number(weather["description"], "string").alias("description"),
        _number(weather["icon"], "string").alias("icon"),
    ]


def _reading(e: Column) -> list[Column]:
    return [
        epoch_to_utc(_number(e["dt"], "bigint")).alias("timestamp"),
        _number(e["temp"], "double").alias("temp"),
        _number(e["feels_like"], "double").alias("feels_like"),
        *_measures(e),
    ]


def _pop(e: Column) -> Column:
    """Probability as given (already 0…1); 0.0 only where the key is absent."""
    given = e["pop"]
    return F.when(given.isNull(), 0.0).otherwise(_number(given, "double")).alias("pop")


def _first(entries: Column, n: int | None) -> Column:
    return entries if n is None else F.slice(entries, 1, n)


def _entries(docs: DataFrame, by: Sequence[str], entries: Column) -> DataFrame:
    """One row ``e`` per entry of the readable documents; a fault in any entry counts."""
    return _typed(docs, by).select(
        *by, F.explode(F.when(F.col("fault").isNull(), entries)).alias("e")
    )


def combined_current(docs: DataFrame, by: Sequence[str] = DEFAULT_BY) -> DataFrame:
    """Current-weather rows of combined documents."""
    one = F.when(F.col("current").isNotNull(), F.array("current"))
    return _entries(docs, by, one).select(*by, *_reading(F.col("e")))


def combined_hourly(
    docs: DataFrame, by: Sequence[str] = DEFAULT_BY, max_entries: int | None = None
) -> DataFrame:
    """Hourly rows: all entries of each document, or its first ``max_entries``."""
    e = F.col("e")
    return _entries(docs, by, _first(F.col("hourly"), max_entries)).select(*by, *_reading(e), _pop(e))


def combined_daily(
    docs: DataFrame, by: Sequence[str] = DEFAULT_BY, max_entries: int | None = None
) -> DataFrame:
    """Daily rows: all entries of each document, or its first ``max_entries``."""
    e = F.col("e")
    return _entries(docs, by, _first(F.col("daily"), max_entries)).select(
        *by,
        epoch_to_utc(_number(e["dt"], "bigint")).cast("date").alias("date"),
        *[_number(e["temp"][k], "double").alias(f"temp_{k}") for k in DAY_TEMPS],
        *_measures(e),
        _pop(e),
    )
