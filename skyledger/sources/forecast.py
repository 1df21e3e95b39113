"""Forecast documents: hourly periods, and day/night periods folded to one row per date.

Both flatteners are narrow: a document is unpacked and folded inside its own row, so no shuffle and
no state is needed, and one flat query serves batch and streaming alike.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger import DEFAULT_BY
from skyledger.functions.clock import iso_local_date, iso_to_utc
from skyledger.functions.conditions import compass_degrees, icon_code
from skyledger.functions.numbers import whole
from skyledger.functions.units import forecast_celsius, percent_to_fraction, wind_text_mps
from skyledger.sources.documents import text, text_only, text_or_unknown

# Estimated spread between day and night when only one of the two is forecast (degrees).
HALF_DAY_SPREAD = 5.0

# VARIANT where an absent key has a default that JSON null has not, or the JSON type matters.
_WEATHER = (
    "startTime: STRING, temperature: STRING, temperatureUnit: VARIANT, windSpeed: VARIANT, "
    "windDirection: VARIANT, shortForecast: VARIANT, probabilityOfPrecipitation: STRING"
)
HOURLY_PERIOD = f"STRUCT<{_WEATHER}, relativeHumidity: STRING>"
DAILY_PERIOD = f"STRUCT<{_WEATHER}, isDaytime: VARIANT>"


def periods_of(docs: DataFrame, period: str, by: Sequence[str]) -> DataFrame:
    """The ``periods`` list of each document, typed; NULL where it is no list.

    One entry that is no object makes the typed parse give up on the whole list. Only such a
    document is read again entry by entry, where the stray entry becomes a period without a time.
    """
    body = F.col("body")
    typed = F.from_json(body, f"properties STRUCT<periods: ARRAY<{period}>>")
    loose = F.from_json(body, "properties STRUCT<periods: ARRAY<STRING>>")["properties"]["periods"]
    one_by_one = F.transform(loose, lambda entry: F.from_json(entry, period))
    return docs.select(*by, F.coalesce(typed["properties"]["periods"], one_by_one).alias("periods"))


def _temperature(p: Column) -> Column:
    unit = p["temperatureUnit"]
    return forecast_celsius(p["temperature"], F.when(unit.isNull(), "F").otherwise(text(unit)))


def _temperature_is_broken(p: Column) -> Column:
    """A temperature that is given but is no number; the period is then given up."""
    given = p["temperature"]
    return given.isNotNull() & given.try_cast("double").isNull()


def _quantity_or_number(raw: Column) -> Column:
    """Text of the number in a {value: n} object, or of a bare number."""
    return F.when(raw.startswith("{"), F.get_json_object(raw, "$.value")).otherwise(raw)


def _wind(p: Column) -> Column:
    """Wind speed; a period without the key counts as calm, null or '' as unknown."""
    wind = p["windSpeed"]
    return F.when(wind.isNull(), 0.0).otherwise(wind_text_mps(text_only(wind)))


def _direction(p: Column) -> Column:
    """Compass label; a period without the key counts as north."""
    label = p["windDirection"]
    return F.when(label.isNull(), "N").otherwise(text(label))


def _pop(p: Column) -> Column:
    return percent_to_fraction(_quantity_or_number(p["probabilityOfPrecipitation"]))


def _first(items: str | Column, n: int | None) -> Column:
    """The first n items of a list, or all of them."""
    items = F.col(items) if isinstance(items, str) else items
    return items if n is None else F.slice(items, 1, n)


def hourly_rows(
    docs: DataFrame, by: Sequence[str] = DEFAULT_BY, max_periods: int | None = None
) -> DataFrame:
    """Flatten hourly-forecast documents: one row per period, or for the first ``max_periods`` only.

    Periods without a readable start time, or with a temperature that is no number, are dropped.
    """
    listed = periods_of(docs, HOURLY_PERIOD, by)
    kept = _first("periods", max_periods)
    p = F.col("p")
    # Plain columns first: the derived ones below then reuse them instead of evaluating them anew.
    # Outer, as the plain explode would have the optimizer filter documents by the size of their parsed
    # list, at the scan, and so parse them twice. The filter drops the empty period that stands for none.
    plain = listed.select(*by, F.explode_outer(kept).alias("p")).filter(
        ~_temperature_is_broken(p) & iso_to_utc(p["startTime"]).isNotNull()
    )
    plain = plain.select(
        *by,
        iso_to_utc(p["startTime"]).alias("timestamp"),
        _temperature(p).alias("temp"),
        whole(_quantity_or_number(p["relativeHumidity"])).alias("humidity"),
        _wind(p).alias("wind_speed"),
        _direction(p).alias("label"),
        text_or_unknown(p["shortForecast"]).alias("description"),
        _pop(p).alias("pop"),
    )
    return plain.select(
        *by,
        "timestamp",
        "temp",
        F.col("temp").alias("feels_like"),
        "humidity",
        F.lit(None).cast("int").alias("pressure"),
        "wind_speed",
        compass_degrees(F.col("label")).alias("wind_deg"),
        "description",
        icon_code(F.col("description")).alias("icon"),
        "pop",
    )


_FOLD_ZERO = (
    "temp_day DOUBLE, temp_night DOUBLE, wind_speed DOUBLE, wind_deg INT, description STRING, "
    "described BOOLEAN, pop DOUBLE"
)


def _opens_date(p: Column, i: Column) -> Column:
    """Whether period i of a list in order of dates is the first of its date."""
    return (i == 0) | (p["date"] != F.get("periods", i - 1)["date"])


def _typed_period(p: Column, i: Column) -> Column:
    is_day = p["isDaytime"]
    return F.struct(
        iso_local_date(p["startTime"]).alias("date"),
        i.alias("i"),
        F.when(is_day.isNull(), True)
        .otherwise(F.coalesce(F.try_variant_get(is_day, "$", "boolean"), F.lit(False)))
        .alias("is_day"),
        _temperature_is_broken(p).alias("broken"),
        _temperature(p).alias("temp"),
        _wind(p).alias("wind_speed"),
        compass_degrees(_direction(p)).alias("wind_deg"),
        text_or_unknown(p["shortForecast"]).alias("description"),
        _pop(p).alias("pop"),
    )


def _fold_step(acc: Column, p: Column) -> Column:
    """Fold one period, in document order, into the state of its date.

    Temperatures go to their half-day. Wind and text come from the day; the night only fills what
    is still empty (speed and direction share one test, on the speed). The probability is the
    highest one. A period with a broken temperature changes nothing.
    """
    day = p["is_day"]
    takes_wind = day | acc["wind_speed"].isNull()
    takes_text = day | acc["description"].isNull()

    def pick(test: Column, new: Column, old: Column, name: str) -> Column:
        return F.when(test & new.isNotNull(), new).otherwise(old).alias(name)

    merged = F.struct(
        pick(day, p["temp"], acc["temp_day"], "temp_day"),
        pick(~day, p["temp"], acc["temp_night"], "temp_night"),
        pick(takes_wind, p["wind_speed"], acc["wind_speed"], "wind_speed"),
        pick(takes_wind, p["wind_deg"], acc["wind_deg"], "wind_deg"),
        F.when(takes_text, p["description"]).otherwise(acc["description"]).alias("description"),
        F.lit(True).alias("described"),
        F.greatest(acc["pop"], p["pop"]).alias("pop"),
    )
    return F.when(p["broken"], acc).otherwise(merged).cast(f"struct<{_as_struct(_FOLD_ZERO)}>")


def _as_struct(ddl: str) -> str:
    return ", ".join(":".join(field.split()) for field in ddl.split(", "))


def day_night_fold(
    docs: DataFrame, by: Sequence[str] = DEFAULT_BY, max_dates: int | None = None
) -> DataFrame:
    """One row per document and date (or its first ``max_dates``): the folded day/night periods."""
    typed = F.transform("periods", _typed_period)
    # By date, then in document order: each date's periods are then one stretch of the list.
    in_order = F.array_sort(F.filter(typed, lambda p: p["date"].isNotNull()))
    zero = F.struct(
        *[F.lit(None)] * 5, F.lit(False), F.lit(0.0)
    ).cast(f"struct<{_as_struct(_FOLD_ZERO)}>")
    listed = periods_of(docs, DAILY_PERIOD, by).select(*by, in_order.alias("periods"))
    opens = F.filter(
        F.transform("periods", lambda p, i: F.when(_opens_date(p, i), i + 1)), lambda i: i.isNotNull()
    )
    counted = listed.select(*by, "periods", opens.alias("opens"))
    stretch = F.transform(
        _first("opens", max_dates),
        lambda at, i: F.struct(
            at.alias("at"),
            (F.coalesce(F.get("opens", i + 1), F.size("periods") + 1) - at).alias("n"),
        ),
    )
    days = counted.select(*by, "periods", F.explode(stretch).alias("s")).select(
        *by, F.slice("periods", F.col("s.at"), F.col("s.n")).alias("own")
    )
    folded = F.aggregate("own", zero, _fold_step)
    days = days.select(*by, F.get("own", F.lit(0))["date"].alias("date"), folded.alias("f"))
    return days.select(
        *by,
        "date",
        F.col("f.temp_day").alias("temp_day"),
        F.col("f.temp_night").alias("temp_night"),
        F.col("f.wind_speed").alias("wind_speed"),
        F.col("f.wind_deg").alias("wind_deg"),
        F.col("f.description").alias("description"),
        F.when(F.col("f.described"), icon_code(F.col("f.description"))).alias("icon"),
        F.col("f.pop").alias("pop"),
    )


def daily_rows(
    docs: DataFrame, by: Sequence[str] = DEFAULT_BY, max_dates: int | None = None
) -> DataFrame:
    """Flatten day/night forecast documents into daily-weather rows.

    The day is the maximum and the night the minimum; a missing half is estimated from the other.
    The feed carries neither humidity nor pressure.
    """
    spread = F.lit(HALF_DAY_SPREAD)
    low = F.coalesce(F.col("temp_night"), F.col("temp_day") - spread)
    high = F.coalesce(F.col("temp_day"), F.col("temp_night") + spread)
    return day_night_fold(docs, by, max_dates).select(
        *by,
        "date",
        low.alias("temp_min"),
        high.alias("temp_max"),
        high.alias("temp_day"),
        low.alias("temp_night"),
        F.lit(None).cast("int").alias("humidity"),
        F.lit(None).cast("int").alias("pressure"),
        "wind_speed",
        "wind_deg",
        "description",
        "icon",
        "pop",
    )
