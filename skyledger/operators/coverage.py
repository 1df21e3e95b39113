"""Geographic coverage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# South, north, west, east edge of each covered region (inclusive).
REGIONS = {
    "continental": (24.5, 49.4, -125.0, -66.9),
    "alaska": (51.2, 71.4, -179.1, -129.9),
    "hawaii": (18.9, 28.4, -178.3, -154.8),
    "puerto_rico": (17.8, 18.6, -67.3, -65.2),
}


def is_coordinate(lat: Column, lon: Column) -> Column:
    """Plain sanity of a coordinate pair."""
    return lat.between(-90, 90) & lon.between(-180, 180)


def _inside(lat: Column, lon: Column, box: tuple[float, float, float, float]) -> Column:
    south, north, west, east = box
    return lat.between(south, north) & lon.between(west, east)


def is_covered(lat: Column, lon: Column) -> Column:
    """Inside any region; unlike a join this becomes a filter at the scan."""
    inside = [_inside(lat, lon, box) for box in REGIONS.values()]
    out = inside[0]
    for test in inside[1:]:
        out = out | test
    return out


def coverage_filter(df: DataFrame, lat: str = "lat", lon: str = "lon") -> DataFrame:
    """Rows with a covered coordinate."""
    return df.filter(is_covered(F.col(lat), F.col(lon)))


def coverage_region(df: DataFrame, lat: str = "lat", lon: str = "lon") -> DataFrame:
    """One row per covering region, named ``region``.

    The range join against the fixed region list is written as an explode of the regions that
    match: narrow, without a broadcast or a nested loop over two tables.
    """
    point = (F.col(lat), F.col(lon))
    names = [F.when(_inside(*point, box), name) for name, box in REGIONS.items()]
    return df.select("*", F.explode(F.array_compact(F.array(*names))).alias("region"))
