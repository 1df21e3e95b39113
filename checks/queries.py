"""Registered queries: every operator over the whole of the tables it is bound to."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import views as V
from checks.params import AS_OF, DAY, ENTRY_TTL_SECONDS, RECENT_ROWS, TTL_SECONDS
from skyledger.functions import clock, conditions, rules, units
from skyledger.functions.numbers import round_to
from skyledger.operators import asof, coverage, latest, ordered, quality, reconcile, regions, rollup, stats, trend
from skyledger.plans import daily, marts, staging
from skyledger.session import configure
from skyledger.sources import combined, directory, documents, forecast, observation
from skyledger.sources.tables import adhoc

Query = Callable[[SparkSession, str], DataFrame]

REGISTRY: dict[str, Query] = {}

DOC = ("doc_id",)
SITE_DAY = ("location_id", "date")


def register(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(configure(spark), sf_dir)

    REGISTRY[fn.__name__] = run
    return fn


def rounded(df: DataFrame, digits: int, *names: str) -> DataFrame:
    """Round derived figures, so that engines agree whatever their summation order."""
    return df.withColumns({n: round_to(n, digits) for n in names})


def days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily.int_weather_summary(*V.raw_views(spark, sf_dir))


def tables(spark: SparkSession, sf_dir: str) -> dict[str, tuple[DataFrame, str]]:
    current, hourly, forecasts = V.raw_views(spark, sf_dir)
    return {
        "current_weather": (current, "timestamp"),
        "hourly_weather": (hourly, "timestamp"),
        "daily_weather": (forecasts, "date"),
    }


# --- documents -------------------------------------------------------------------------------


@register
def ingest_observation(spark, sf_dir):
    rows = observation.observation_rows(V.observation_documents(spark, sf_dir), ("event_id",))
    return rounded(rows, 6, "temp", "feels_like", "wind_speed")


@register
def feels_like(spark, sf_dir):
    docs = observation.observed(V.observation_documents(spark, sf_dir), ("event_id",))
    return docs.select("event_id", round_to(observation.feels_like(), 6).alias("feels_like"))


@register
def parse_time(spark, sf_dir):
    docs = documents.parsed(V.observation_documents(spark, sf_dir))
    text = documents.at(F.col("doc"), "$.properties.timestamp", "string")
    return docs.select("event_id", text.alias("text")).select(
        "event_id",
        clock.iso_to_utc(F.col("text")).alias("utc_time"),
        clock.iso_local_date(F.col("text")).alias("local_date"),
    )


@register
def ingest_hourly(spark, sf_dir):
    rows = forecast.hourly_rows(V.hourly_documents(spark, sf_dir), DOC)
    return rounded(rows, 6, "temp", "feels_like", "wind_speed", "pop")


@register
def day_night_fold(spark, sf_dir):
    rows = forecast.day_night_fold(V.daily_documents(spark, sf_dir), DOC)
    return rounded(rows, 6, "temp_day", "temp_night", "wind_speed")


@register
def ingest_daily(spark, sf_dir):
    rows = forecast.daily_rows(V.daily_documents(spark, sf_dir), DOC)
    return rounded(rows, 6, "temp_min", "temp_max", "temp_day", "temp_night", "wind_speed")


@register
def points_directory(spark, sf_dir):
    return directory.points_directory(V.points_documents(spark, sf_dir), DOC)


@register
def first_station(spark, sf_dir):
    return directory.first_station(V.stations_documents(spark, sf_dir), DOC)


@register
def first_usable_station(spark, sf_dir):
    return directory.first_usable_station(V.stations_documents(spark, sf_dir), DOC)


@register
def ingest_combined_current(spark, sf_dir):
    return combined.combined_current(V.combined_documents(spark, sf_dir), DOC)


@register
def ingest_combined_hourly(spark, sf_dir):
    return combined.combined_hourly(V.combined_documents(spark, sf_dir), DOC)


@register
def ingest_combined_daily(spark, sf_dir):
    return combined.combined_daily(V.combined_documents(spark, sf_dir), DOC)


@register
def validate_documents(spark, sf_dir):
    docs = V.broken_documents(spark, sf_dir)
    return documents.validate_as_kinds(docs).select("doc_id", "kind", "reason", "is_valid")


@register
def validate_combined(spark, sf_dir):
    docs = V.combined_documents(spark, sf_dir)
    return combined.validate_combined(docs).select("doc_id", "reason", "is_valid")


# --- cleaning and staging --------------------------------------------------------------------


@register
def clean_current(spark, sf_dir):
    return staging.clean_current(V.view(spark, sf_dir, "raw_current"))


@register
def clean_hourly(spark, sf_dir):
    return staging.clean_hourly(V.view(spark, sf_dir, "raw_hourly"))


@register
def clean_daily(spark, sf_dir):
    return staging.clean_daily(V.view(spark, sf_dir, "raw_daily"))


@register
def stg_current_weather(spark, sf_dir):
    return staging.stg_current_weather(V.view(spark, sf_dir, "raw_current"))


@register
def stg_hourly_weather(spark, sf_dir):
    return staging.stg_hourly_weather(V.view(spark, sf_dir, "raw_hourly"))


@register
def stg_daily_weather(spark, sf_dir):
    return staging.stg_daily_weather(V.view(spark, sf_dir, "raw_daily"))


@register
def calendar_parts(spark, sf_dir):
    raw = V.view(spark, sf_dir, "raw_hourly").filter("timestamp IS NOT NULL")
    return raw.select(
        "location_id",
        "timestamp",
        F.hour("timestamp").alias("hour_of_day"),
        clock.day_of_week("timestamp").alias("day_of_week"),
        F.month("timestamp").alias("month"),
        F.year("timestamp").alias("year"),
    )


@register
def describe_row(spark, sf_dir):
    rows = staging.clean_current(V.view(spark, sf_dir, "raw_current"))
    return rows.select("location_id", "timestamp", conditions.describe(rows).alias("report"))


# --- daily models ----------------------------------------------------------------------------


@register
def current_daily_summary(spark, sf_dir):
    return rollup.current_daily_summary(stg_current_weather(spark, sf_dir))


@register
def daily_mode(spark, sf_dir):
    return rollup.daily_mode(stg_current_weather(spark, sf_dir), "description")


@register
def hourly_daily_summary(spark, sf_dir):
    return rollup.hourly_daily_summary(stg_hourly_weather(spark, sf_dir))


@register
def day_night_profile(spark, sf_dir):
    return rollup.day_night_profile(stg_hourly_weather(spark, sf_dir))


@register
def daily_reconcile_2way(spark, sf_dir):
    return reconcile.reconcile_two(
        current_daily_summary(spark, sf_dir), hourly_daily_summary(spark, sf_dir)
    )


@register
def int_weather_summary(spark, sf_dir):
    return days(spark, sf_dir)



@register
def source_gap(spark, sf_dir):
    return days(spark, sf_dir).select(*SITE_DAY, "temp_variance_current_vs_hourly")


@register
def day_night_gap(spark, sf_dir):
    return days(spark, sf_dir).select(*SITE_DAY, "day_night_temp_difference")


@register
def weather_summary(spark, sf_dir):
    return marts.weather_summary(days(spark, sf_dir))


@register
def weather_trends(spark, sf_dir):
    return marts.weather_trends(days(spark, sf_dir))


@register
def weather_trends_by_joins(spark, sf_dir):
    return marts.weather_trends_by_joins(days(spark, sf_dir))


@register
def weather_alerts(spark, sf_dir):
    return marts.weather_alerts(weather_trends(spark, sf_dir))


# --- windows ---------------------------------------------------------------------------------


@register
def moving_avg_7(spark, sf_dir):
    names = {
        "final_avg_temp": "temp_7day_moving_avg",
        "avg_humidity": "humidity_7day_moving_avg",
        "avg_wind_speed": "wind_7day_moving_avg",
    }
    rows = trend.moving_averages(days(spark, sf_dir), 7, names)
    return rounded(rows.select(*SITE_DAY, *names.values()), 4, *names.values())


@register
def moving_avg_30(spark, sf_dir):
    names = {"final_avg_temp": "temp_30day_moving_avg"}
    rows = trend.moving_averages(days(spark, sf_dir), 30, names)
    return rounded(rows.select(*SITE_DAY, *names.values()), 4, *names.values())


@register
def rolling_volatility(spark, sf_dir):
    rows = trend.rolling_volatility(days(spark, sf_dir))
    return rounded(rows.select(*SITE_DAY, "temp_7day_volatility"), 4, "temp_7day_volatility")


@register
def trend_direction(spark, sf_dir):
    return trend.trend_direction(days(spark, sf_dir)).select(*SITE_DAY, "temp_trend_direction")


@register
def seasonal_avg(spark, sf_dir):
    rows = trend.seasonal(days(spark, sf_dir)).select(*SITE_DAY, "season", "seasonal_avg_temp")
    return rounded(rows, 4, "seasonal_avg_temp")


@register
def seasonal_deviation(spark, sf_dir):
    name = "temp_deviation_from_seasonal_avg"
    return rounded(trend.seasonal(days(spark, sf_dir)).select(*SITE_DAY, "season", name), 4, name)


@register
def seasonal_rank(spark, sf_dir):
    return trend.seasonal(days(spark, sf_dir)).select(*SITE_DAY, "season", "temp_rank_in_season")


@register
def site_moving_avg(spark, sf_dir):
    known = trend.known_average(days(spark, sf_dir)).select("location_id", "date", "final_avg_temp")
    averaged = ordered.last_rows_measures(
        known,
        7,
        {"temp_7row_moving_avg": F.avg("final_avg_temp")},
        ordered.day_chunk("date"),
        [F.asc_nulls_last("date"), F.asc("location_id")],
    )
    return rounded(averaged, 4, "temp_7row_moving_avg").drop("final_avg_temp")


@register
def site_seasonal_rank(spark, sf_dir):
    known = trend.known_average(days(spark, sf_dir)).select("location_id", "date", "season", "final_avg_temp")
    shown = rounded(known, 4, "final_avg_temp")
    chunk = ordered.value_chunk("final_avg_temp", 1 / 16, descending=True)
    return ordered.ranked(shown, chunk, [F.desc("final_avg_temp")], "temp_rank_in_season", ["season"])


@register
def weather_pattern(spark, sf_dir):
    label = rules.weather_pattern(F.col("final_avg_temp"), F.col("avg_precipitation_probability"))
    return trend.known_average(days(spark, sf_dir)).select(
        *SITE_DAY, label.alias("weather_pattern")
    )



@register
def extreme_indicator(spark, sf_dir):
    label = rules.extreme_indicator(
        F.col("final_avg_temp"), F.col("avg_wind_speed"), F.col("avg_precipitation_probability")
    )
    return trend.known_average(days(spark, sf_dir)).select(
        *SITE_DAY, label.alias("extreme_weather_indicator")
    )



# --- scalar functions ------------------------------------------------------------------------


@register
def convert_temperature(spark, sf_dir):
    value = units.temperature_celsius(F.col("value"), F.col("temp_unit"))
    return V.view(spark, sf_dir, "quantity").select("event_id", round_to(value, 6).alias("celsius"))


@register
def convert_pressure(spark, sf_dir):
    value = units.pressure_hpa(F.col("value"), F.col("pressure_unit"))
    return V.view(spark, sf_dir, "quantity").select("event_id", value.alias("hpa"))


@register
def convert_wind(spark, sf_dir):
    value = units.wind_mps(F.col("value"), F.col("wind_unit"))
    return V.view(spark, sf_dir, "quantity").select("event_id", round_to(value, 6).alias("mps"))


LINE = ("l_orderkey", "l_linenumber", "l_partkey")


@register
def wind_text_to_mps(spark, sf_dir):
    value = units.wind_text_mps(F.col("wind_text"))
    return V.view(spark, sf_dir, "period").select(
        *LINE, "wind_text", round_to(value, 6).alias("mps")
    )


@register
def compass_to_degrees(spark, sf_dir):
    value = conditions.compass_degrees(F.col("wind_direction"))
    return V.view(spark, sf_dir, "period").select(*LINE, "wind_direction", value.alias("degrees"))


@register
def icon_code(spark, sf_dir):
    return V.view(spark, sf_dir, "raw_current").select(
        "location_id",
        "timestamp",
        "description",
        conditions.icon_code(F.col("description")).alias("icon"),
    )


@register
def pop_fraction(spark, sf_dir):
    value = units.percent_to_fraction(F.col("pop_percent"))
    return V.view(spark, sf_dir, "period").select(*LINE, round_to(value, 6).alias("pop"))


@register
def json_props(spark, sf_dir):
    events = documents.parsed(V.table(spark, sf_dir, "events"), "props")
    doc = F.col("doc")
    return events.select(
        "event_id",
        documents.at(doc, "$.k", "int").alias("k"),
        F.coalesce(documents.at(doc, "$.other", "int"), F.lit(-1)).alias("absent"),
    )


# --- latest rows -----------------------------------------------------------------------------

_CURRENT_ORDER = (
    "temp", "feels_like", "humidity", "pressure", "wind_speed", "wind_deg", "description",
)


@register
def latest_observation(spark, sf_dir):
    raw = V.view(spark, sf_dir, "raw_current")
    return latest.most_recent(raw, "timestamp", 1, ("location_id", *_CURRENT_ORDER))


@register
def latest_per_location(spark, sf_dir):
    raw = V.view(spark, sf_dir, "raw_current")
    return latest.latest_per_key(raw, ["location_id"], "timestamp", _CURRENT_ORDER)


@register
def adhoc_recent(spark, sf_dir):
    return adhoc(
        spark,
        f"""SELECT location_id, timestamp, temp, description FROM {{current_weather}}
        WHERE timestamp IS NOT NULL
        ORDER BY timestamp DESC, location_id, temp NULLS LAST, description LIMIT {RECENT_ROWS}""",
        current_weather=V.view(spark, sf_dir, "raw_current"),
    )


@register
def latest_per_key(spark, sf_dir):
    return latest.latest_per_key(V.daily_polls(spark, sf_dir), SITE_DAY, "poll_no")


@register
def unexpired_entries(spark, sf_dir):
    events = V.table(spark, sf_dir, "events").select("user_id", "ts", "event_id", "value")
    return latest.unexpired_entries(events, ["user_id"], "ts", AS_OF, TTL_SECONDS, ["event_id"])


@register
def freshness_stats(spark, sf_dir):
    events = V.table(spark, sf_dir, "events")
    return latest.freshness_stats(events, ["user_id"], "ts", AS_OF, TTL_SECONDS)


@register
def entry_at(spark, sf_dir):
    events = V.table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "event_type")
    entries = events.filter("event_type = 'purchase'").select("user_id", "ts", "event_id")
    joined = asof.entry_at(events, entries, ["user_id"], "ts", "ts", ENTRY_TTL_SECONDS, ["event_id"])
    return joined.select(
        "event_id", "user_id", "ts", F.col("entry.event_id").alias("entry_id"), F.col("entry.ts").alias("cached_at")
    )


# --- coverage --------------------------------------------------------------------------------


@register
def coverage_filter(spark, sf_dir):
    return coverage.coverage_filter(V.view(spark, sf_dir, "station"))


@register
def coordinate_sanity(spark, sf_dir):
    stations = V.view(spark, sf_dir, "station_report")
    valid = coverage.is_coordinate(F.col("lat"), F.col("lon"))
    return stations.select("station_id", "lat", "lon", F.coalesce(valid, F.lit(False)).alias("is_valid"))


@register
def coverage_region(spark, sf_dir):
    return coverage.coverage_region(V.view(spark, sf_dir, "station"))


@register
def coverage_join(spark, sf_dir):
    return regions.coverage_join(V.view(spark, sf_dir, "sensor"), V.view(spark, sf_dir, "region_box"))


# --- statistics and quality ------------------------------------------------------------------


@register
def table_stats(spark, sf_dir):
    return stats.table_stats(tables(spark, sf_dir))


@register
def warehouse_summary(spark, sf_dir):
    raw = {name: df for name, (df, _) in tables(spark, sf_dir).items()}
    analytics = {
        "weather_summary": weather_summary(spark, sf_dir),
        "weather_trends": weather_trends(spark, sf_dir),
    }
    return stats.warehouse_summary(raw, analytics)


@register
def counts_as_of(spark, sf_dir):
    return stats.counts_as_of(*V.raw_views(spark, sf_dir), DAY)


@register
def profile_report(spark, sf_dir):
    return stats.profile_report(*V.raw_views(spark, sf_dir))


@register
def quality_current(spark, sf_dir):
    return quality.current_quality(V.view(spark, sf_dir, "raw_current"))


@register
def quality_hourly(spark, sf_dir):
    return quality.hourly_quality(V.view(spark, sf_dir, "raw_hourly"))


@register
def quality_daily(spark, sf_dir):
    return quality.daily_quality(V.view(spark, sf_dir, "raw_daily"))


@register
def quality_verdict(spark, sf_dir):
    return quality.quality_verdict(*V.raw_views(spark, sf_dir))


@register
def dq_not_null(spark, sf_dir):
    failing = quality.failing_rows(tables(spark, sf_dir))
    return failing.select("table_name", "column_name", "location_id", "wind_deg", "description")


@register
def dq_severity(spark, sf_dir):
    return quality.not_null_report(tables(spark, sf_dir))


@register
def dq_failures(spark, sf_dir):
    return quality.failing_rows(tables(spark, sf_dir))
