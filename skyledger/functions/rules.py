"""Plausibility ranges and label ladders, as data, with the two operators that apply them."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Inclusive plausible range per column; None leaves that side open.
TEMPERATURE_RANGE = (-50, 50)
COMMON_RANGES = {
    "humidity": (0, 100),
    "pressure": (800, 1200),
    "wind_speed": (0, None),
    "wind_deg": (0, 360),
}
CURRENT_RANGES = {"temp": TEMPERATURE_RANGE, "feels_like": TEMPERATURE_RANGE, **COMMON_RANGES}
HOURLY_RANGES = {**CURRENT_RANGES, "pop": (0, 1)}
DAILY_RANGES = {
    "temp_min": TEMPERATURE_RANGE,
    "temp_max": TEMPERATURE_RANGE,
    "temp_day": TEMPERATURE_RANGE,
    "temp_night": TEMPERATURE_RANGE,
    **COMMON_RANGES,
    "pop": (0, 1),
}


@dataclass(frozen=True)
class Ladder:
    """Labels for values below rising limits; ``otherwise`` takes the rest, NULL included."""

    steps: tuple[tuple[float, str], ...]
    otherwise: str

    @property
    def labels(self) -> tuple[str, ...]:
        return (*(label for _, label in self.steps), self.otherwise)


# Label ladders.
TEMP_CATEGORY = Ladder(((0, "freezing"), (10, "cold"), (20, "cool"), (30, "warm")), "hot")
WIND_CATEGORY = Ladder(((5, "light"), (15, "moderate"), (25, "strong")), "very_strong")
POP_CATEGORY = Ladder(((0.1, "low"), (0.5, "medium")), "high")
BUSINESS_TEMP = Ladder(((0, "Freezing"), (10, "Cold"), (20, "Cool"), (30, "Warm")), "Hot")
BUSINESS_WIND = Ladder(((5, "Calm"), (15, "Moderate"), (25, "Strong")), "Very Strong")
BUSINESS_POP_PERCENT = Ladder(((10, "Low"), (50, "Medium")), "High")


def in_range(c: Column | str, low: float | None, high: float | None) -> Column:
    """The value where it lies inside the closed range, else NULL."""
    c = F.col(c) if isinstance(c, str) else c
    checks = []
    if low is not None:
        checks.append(c >= F.lit(low))
    if high is not None:
        checks.append(c <= F.lit(high))
    if not checks:
        return c
    test = checks[0] if len(checks) == 1 else checks[0] & checks[1]
    return F.when(test, c)


def null_out_of_range(
    df: DataFrame, ranges: Mapping[str, tuple[float | None, float | None]]
) -> DataFrame:
    """Replace implausible values by NULL; every row is kept."""
    return df.select(
        *[in_range(c, *ranges[c]).alias(c) if c in ranges else F.col(c) for c in df.columns]
    )


def band(c: Column | str, ladder: Ladder) -> Column:
    """Label of the first limit the value is below. NULL ends in ``otherwise``, by contract."""
    c = F.col(c) if isinstance(c, str) else c
    (limit, label), *rest = ladder.steps
    out = F.when(c < F.lit(limit), label)
    for limit, label in rest:
        out = out.when(c < F.lit(limit), label)
    return out.otherwise(ladder.otherwise)


def season(month: Column) -> Column:
    """Meteorological season (northern) of a month number; NULL ends in fall."""
    return (
        F.when(month.isin(12, 1, 2), "winter")
        .when(month.isin(3, 4, 5), "spring")
        .when(month.isin(6, 7, 8), "summer")
        .otherwise("fall")
    )


def weather_pattern(temp: Column, pop: Column) -> Column:
    """Temperature class crossed with wet / dry.

    The classes share their edges (0, 15 and 25); the colder one wins at 15 and the milder one at
    25. Without a precipitation probability the pattern is unknown.
    """
    warmth = (
        F.when(temp < 0, "cold")
        .when(temp <= 15, "cool")
        .when(temp <= 25, "mild")
        .when(temp > 25, "warm")
    )
    moisture = F.when(pop > 0.5, "wet").when(pop <= 0.5, "dry")
    return F.coalesce(F.concat(warmth, F.lit("_"), moisture), F.lit("unknown"))


def extreme_indicator(temp: Column, wind: Column, pop: Column) -> Column:
    """First extreme that applies, in the order heat, cold, wind, precipitation."""
    return (
        F.when(temp > 30, "heat_wave")
        .when(temp < -10, "cold_snap")
        .when(wind > 20, "high_winds")
        .when(pop > 0.8, "heavy_precipitation_expected")
        .otherwise("normal")
    )


def temperature_anomaly(deviation: Column) -> Column:
    """Label of a deviation from the seasonal average (degrees)."""
    return (
        F.when(deviation > 5, "unusually_warm")
        .when(deviation < -5, "unusually_cold")
        .otherwise("seasonal_normal")
    )


def temperature_stability(volatility: Column) -> Column:
    """Label of a rolling standard deviation (degrees)."""
    return (
        F.when(volatility > 10, "high_variability")
        .when(volatility > 5, "moderate_variability")
        .otherwise("low_variability")
    )
