"""Station observations: one document, one row of the current-weather table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger import DEFAULT_BY
from skyledger.functions.clock import iso_to_utc
from skyledger.functions.conditions import icon_code
from skyledger.functions.numbers import whole
from skyledger.functions.units import pressure_hpa, temperature_celsius, wind_mps
from skyledger.sources.documents import at, text_or_unknown

# A quantity that is no object parses to NULL, which is what its readers want. Only the air
# temperature and the text need to tell an absent key from a null one.
_QUANTITY = "STRUCT<value: STRING, unitCode: STRING>"
OBSERVATION = (
    "properties STRUCT<timestamp: STRING, textDescription: VARIANT, temperature: VARIANT, "
    f"heatIndex: {_QUANTITY}, windChill: {_QUANTITY}, relativeHumidity: {_QUANTITY}, "
    f"barometricPressure: {_QUANTITY}, windSpeed: {_QUANTITY}, windDirection: {_QUANTITY}>"
)


def observed(docs: DataFrame, by: Sequence[str]) -> DataFrame:
    """One row ``o`` per document that has a temperature key: its properties, with the air
    temperature read out of its VARIANT."""
    parsed = docs.select(
        *by, "ingested_at", F.from_json("body", OBSERVATION)["properties"].alias("o")
    )
    air = F.col("o.temperature")
    # An array of one or NULL through explode(): rejects without a filter, which Catalyst would push
    # below the projection where it would parse every document a second time.
    return parsed.select(
        *by,
        "ingested_at",
        F.explode(F.when(air.isNotNull(), F.array("o"))).alias("o"),
        at(air, "$.value", "string").alias("air_value"),
        at(air, "$.unitCode", "string").alias("air_unit"),
    )


def _quantity(name: str) -> tuple[Column, Column]:
    return F.col(f"o.{name}.value"), F.col(f"o.{name}.unitCode")


def _air() -> tuple[Column, Column]:
    return F.col("air_value"), F.col("air_unit")


def feels_like() -> Column:
    """Heat index, else wind chill, else air temperature: the first one that carries a value.

    The choice looks at the raw value, so a present but unreadable heat index gives NULL.
    """
    heat, chill = _quantity("heatIndex"), _quantity("windChill")
    use_heat, use_chill = heat[0].isNotNull(), chill[0].isNotNull()

    def chosen(part: int) -> Column:
        return (
            F.when(use_heat, heat[part]).when(use_chill, chill[part]).otherwise(_air()[part])
        )

    return temperature_celsius(chosen(0), chosen(1))


def observation_rows(docs: DataFrame, by: Sequence[str] = DEFAULT_BY) -> DataFrame:
    """Flatten observation documents into current-weather rows.

    Documents without a ``temperature`` key are rejected; a null or malformed temperature keeps the
    row. A missing or unreadable time falls back to ``ingested_at``.
    """
    rows = observed(docs, by).select(
        *by,
        F.coalesce(iso_to_utc(F.col("o.timestamp")), F.col("ingested_at")).alias("timestamp"),
        temperature_celsius(*_air()).alias("temp"),
        feels_like().alias("feels_like"),
        whole(F.col("o.relativeHumidity.value")).alias("humidity"),
        pressure_hpa(*_quantity("barometricPressure")).alias("pressure"),
        wind_mps(*_quantity("windSpeed")).alias("wind_speed"),
        whole(F.col("o.windDirection.value")).alias("wind_deg"),
        text_or_unknown(F.col("o.textDescription")).alias("description"),
    )
    return rows.withColumn("icon", icon_code(F.col("description")))
