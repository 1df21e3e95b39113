"""Rounding and tolerant casts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_to(c: Column | str, digits: int) -> Column:
    """Round half away from zero on the decimal value (twelve digits are kept before rounding).

    Binary doubles make 1.005 round either way; going through a decimal fixes the answer.
    Values beyond the decimal's sixteen whole digits are rounded as doubles.
    """
    c = F.col(c) if isinstance(c, str) else c
    exact = F.round(c.try_cast("decimal(28,12)"), digits).cast("double")
    return F.coalesce(exact, F.round(c.cast("double"), digits))


def whole(c: Column) -> Column:
    """Truncate toward zero to INT; NULL where it is no number or does not fit."""
    return c.try_cast("double").try_cast("int")
