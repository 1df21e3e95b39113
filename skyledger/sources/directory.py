"""Grid-point and station-list documents."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger import DEFAULT_BY
from skyledger.sources.documents import array_at, at, parsed


def points_directory(docs: DataFrame, by: Sequence[str] = DEFAULT_BY) -> DataFrame:
    """Forecast, hourly and station-list addresses per grid point; all three must be given."""

    def address(key: str) -> Column:
        return F.nullif(at(F.col("doc"), f"$.properties.{key}", "string"), F.lit(""))

    found = F.struct(
        address("forecast").alias("forecast_url"),
        address("forecastHourly").alias("hourly_url"),
        address("observationStations").alias("stations_url"),
    )
    return (
        parsed(docs)
        .select(*by, found.alias("found"))
        .select(*by, "found.*")
        .dropna(subset=["forecast_url", "hourly_url", "stations_url"])
    )


def _station_ids() -> Column:
    """Identifiers in list order; NULL where a station has none."""
    return F.transform(
        array_at(F.col("doc"), "$.features"),
        lambda f: F.nullif(at(f, "$.properties.stationIdentifier", "string"), F.lit("")),
    )


def first_station(docs: DataFrame, by: Sequence[str] = DEFAULT_BY) -> DataFrame:
    """Identifier of the first listed station; lists whose first station has none are dropped."""
    ids = parsed(docs).select(*by, F.get(_station_ids(), F.lit(0)).alias("station_id"))
    return ids.filter(F.col("station_id").isNotNull())


def first_usable_station(docs: DataFrame, by: Sequence[str] = DEFAULT_BY) -> DataFrame:
    """First station in list order that has an identifier."""
    usable = F.filter(_station_ids(), lambda s: s.isNotNull())
    ids = parsed(docs).select(*by, F.get(usable, F.lit(0)).alias("station_id"))
    return ids.filter(F.col("station_id").isNotNull())
