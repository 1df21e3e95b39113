"""Unit conversions for observed quantities and forecast texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from skyledger.functions.numbers import whole

# Unit codes and conversion factors.
DEG_F = "wmoUnit:degF"
KELVIN = "wmoUnit:K"
HECTOPASCAL = "wmoUnit:hPa"
KM_PER_HOUR = "wmoUnit:km_h-1"
MILES_PER_HOUR = "wmoUnit:mi_h-1"
MPS_PER_MPH = 0.44704
MPH_PER_MPS = 2.237


def fahrenheit_to_celsius(c: Column) -> Column:
    return (c - F.lit(32.0)) * F.lit(5.0) / F.lit(9.0)


def temperature_celsius(value: Column, unit: Column) -> Column:
    """Degrees Celsius. An unknown or missing unit is taken as Celsius; bad numbers give NULL."""
    number = value.try_cast("double")
    return (
        F.when(unit == DEG_F, fahrenheit_to_celsius(number))
        .when(unit == KELVIN, number - F.lit(273.15))
        .otherwise(number)
    )


def pressure_hpa(value: Column, unit: Column) -> Column:
    """Whole hectopascals, truncated. An unknown or missing unit is taken as pascal."""
    number = value.try_cast("double")
    return whole(F.when(unit == HECTOPASCAL, number).otherwise(number / F.lit(100.0)))


def wind_mps(value: Column, unit: Column) -> Column:
    """Metres per second. An unknown or missing unit is taken as m/s."""
    number = value.try_cast("double")
    return (
        F.when(unit == KM_PER_HOUR, number / F.lit(3.6))
        .when(unit == MILES_PER_HOUR, number * F.lit(MPS_PER_MPH))
        .otherwise(number)
    )


def forecast_celsius(value: Column, unit: Column) -> Column:
    """Forecast temperature: 'F' is converted, any other unit is kept as it is."""
    number = value.try_cast("double")
    return F.when(unit == "F", fahrenheit_to_celsius(number)).otherwise(number)


def wind_text_mps(text: Column) -> Column:
    """First number of a forecast wind text such as "5 to 10 mph", in m/s."""
    number = F.nullif(F.regexp_extract(text, r"(\d+(?:\.\d+)?)", 1), F.lit(""))
    return number.cast("double") * F.lit(MPS_PER_MPH)


def percent_to_fraction(percent: Column) -> Column:
    """Percent to 0…1; NULL and unreadable values give 0.0."""
    return F.coalesce(percent.try_cast("double") / F.lit(100.0), F.lit(0.0))
