"""Condition texts: compass labels, icon codes, one-line reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Degrees per compass label (multiples of 22.5, cut to whole degrees).
COMPASS_LABELS = (
    "N", "NNE", "NE", "ENE", "E", "ESE", "SE", "SSE",
    "S", "SSW", "SW", "WSW", "W", "WNW", "NW", "NNW",
)
COMPASS_DEGREES = {label: int(22.5 * i) for i, label in enumerate(COMPASS_LABELS)}

# Icon code per word found in the text; the first row that fits wins.
ICON_WORDS = (
    (("clear", "sunny"), "01d"),
    (("few clouds", "partly cloudy"), "02d"),
    (("scattered clouds",), "03d"),
    (("broken clouds", "overcast"), "04d"),
    (("shower", "light rain"), "09d"),
    (("rain",), "10d"),
    (("thunderstorm",), "11d"),
    (("snow",), "13d"),
    (("mist", "fog"), "50d"),
)
DEFAULT_ICON = "01d"


def compass_degrees(label: Column) -> Column:
    """Degrees of a compass label; unknown labels give 0, NULL and '' give NULL."""
    pairs = [F.lit(x) for item in COMPASS_DEGREES.items() for x in item]
    degrees = F.coalesce(F.try_element_at(F.create_map(*pairs), label), F.lit(0))
    return F.when(F.length(label) > 0, degrees)


def icon_code(text: Column) -> Column:
    """Icon code of a condition text; no match, NULL and '' give the clear-sky icon."""
    lowered = F.lower(text)
    out = None
    for words, code in ICON_WORDS:
        test = lowered.contains(words[0])
        for word in words[1:]:
            test = test | lowered.contains(word)
        out = F.when(test, code) if out is None else out.when(test, code)
    return out.otherwise(DEFAULT_ICON)


def describe(df: DataFrame) -> Column:
    """One-line report per row; columns the frame lacks and NULLs print as N/A or Unknown."""

    def shown(name: str, default: str) -> Column:
        if name not in df.columns:
            return F.lit(default)
        return F.coalesce(F.col(name).cast("string"), F.lit(default))

    return F.concat(
        shown("temp", "N/A"), F.lit("°C, "), shown("description", "Unknown"),
        F.lit(", Humidity: "), shown("humidity", "N/A"),
        F.lit("%, Wind: "), shown("wind_speed", "N/A"), F.lit(" m/s"),
    )
