"""Scalar rules at their edges."""

import math
from datetime import date, datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from skyledger.functions import clock, conditions, rules, units
from skyledger.functions.numbers import round_to
from skyledger.operators.coverage import coverage_filter, coverage_region


def values(spark, schema, data, column):
    named = spark.createDataFrame([(i, *d) for i, d in enumerate(data)], "i INT, " + schema)
    return [r[0] for r in named.orderBy("i").select(column).collect()]


def one(spark, kind, data, column):
    return values(spark, f"x {kind}", [(d,) for d in data], column)


def X():
    return F.col("x")


def test_ladders_at_their_limits(spark):
    t = [-0.01, 0.0, 9.99, 10.0, 19.99, 20.0, 29.99, 30.0, None]
    assert one(spark, "DOUBLE", t, rules.band("x", rules.TEMP_CATEGORY)) == [
        "freezing", "cold", "cold", "cool", "cool", "warm", "warm", "hot", "hot",
    ]
    assert one(spark, "DOUBLE", t, rules.band("x", rules.BUSINESS_TEMP)) == [
        "Freezing", "Cold", "Cold", "Cool", "Cool", "Warm", "Warm", "Hot", "Hot",
    ]
    w = [4.99, 5.0, 14.99, 15.0, 24.99, 25.0, None]
    assert one(spark, "DOUBLE", w, rules.band("x", rules.WIND_CATEGORY)) == [
        "light", "moderate", "moderate", "strong", "strong", "very_strong", "very_strong",
    ]
    assert one(spark, "DOUBLE", w, rules.band("x", rules.BUSINESS_WIND)) == [
        "Calm", "Moderate", "Moderate", "Strong", "Strong", "Very Strong", "Very Strong",
    ]
    p = [0.0999, 0.1, 0.4999, 0.5, None]
    assert one(spark, "DOUBLE", p, rules.band("x", rules.POP_CATEGORY)) == [
        "low", "medium", "medium", "high", "high",
    ]
    percent = [9.9, 10.0, 49.9, 50.0, None]
    assert one(spark, "DOUBLE", percent, rules.band("x", rules.BUSINESS_POP_PERCENT)) == [
        "Low", "Medium", "Medium", "High", "High",
    ]


def test_ranges_are_closed_and_keep_rows(spark):
    data = [(-50.0, 800), (50.0, 1200), (50.01, 799), (None, None), (math.nan, 1201)]
    df = spark.createDataFrame(data, "temp DOUBLE, pressure INT")
    got = [tuple(r) for r in rules.null_out_of_range(df, rules.CURRENT_RANGES).collect()]
    assert got == [(-50.0, 800), (50.0, 1200), (None, None), (None, None), (None, None)]
    wind = spark.createDataFrame([(0.0,), (-0.1,), (500.0,)], "wind_speed DOUBLE")
    got = [r[0] for r in rules.null_out_of_range(wind, rules.CURRENT_RANGES).collect()]
    assert got == [0.0, None, 500.0]


def test_patterns_share_their_edges(spark):
    data = [
        (-1.0, 0.6), (-1.0, 0.5), (0.0, 0.6), (15.0, 0.6), (15.01, 0.5), (25.0, 0.5),
        (25.01, 0.6), (25.01, 0.5), (20.0, None), (None, 0.6),
    ]
    label = rules.weather_pattern(F.col("t"), F.col("p"))
    assert values(spark, "t DOUBLE, p DOUBLE", data, label) == [
        "cold_wet", "cold_dry", "cool_wet", "cool_wet", "mild_dry", "mild_dry",
        "warm_wet", "warm_dry", "unknown", "unknown",
    ]


def test_first_extreme_wins(spark):
    data = [
        (31.0, 30.0, 0.9), (30.0, 20.5, 0.9), (-11.0, 30.0, 0.9), (-10.0, 20.0, 0.81),
        (0.0, None, 0.8), (None, None, None),
    ]
    label = rules.extreme_indicator(F.col("t"), F.col("w"), F.col("p"))
    assert values(spark, "t DOUBLE, w DOUBLE, p DOUBLE", data, label) == [
        "heat_wave", "high_winds", "cold_snap", "heavy_precipitation_expected", "normal", "normal",
    ]


def test_anomaly_and_stability(spark):
    d = [5.01, 5.0, -5.0, -5.01, None]
    assert one(spark, "DOUBLE", d, rules.temperature_anomaly(X())) == [
        "unusually_warm", "seasonal_normal", "seasonal_normal", "unusually_cold", "seasonal_normal",
    ]
    v = [10.01, 10.0, 5.0, None]
    assert one(spark, "DOUBLE", v, rules.temperature_stability(X())) == [
        "high_variability", "moderate_variability", "low_variability", "low_variability",
    ]


def test_seasons(spark):
    got = one(spark, "INT", list(range(1, 13)), rules.season(X()))
    assert got == ["winter"] * 2 + ["spring"] * 3 + ["summer"] * 3 + ["fall"] * 3 + ["winter"]


def test_unit_conversions(spark):
    def near(got, want):
        assert [g if g is None else pytest.approx(g, abs=1e-9) for g in want] == got

    pair = (F.col("v"), F.col("u"))
    t = [
        ("5", "wmoUnit:degC"), ("32", "wmoUnit:degF"), ("273.15", "wmoUnit:K"), ("20", "odd"),
        ("20", None), ("invalid", "wmoUnit:degC"), (None, "wmoUnit:degC"),
    ]
    near(
        values(spark, "v STRING, u STRING", t, units.temperature_celsius(*pair)),
        [5.0, 0.0, 0.0, 20.0, 20.0, None, None],
    )
    p = [
        ("101325", "wmoUnit:Pa"), ("1013", "wmoUnit:hPa"), ("101325", "odd"), ("101399", None),
        ("invalid", "wmoUnit:Pa"), ("NaN", "wmoUnit:Pa"), ("-150", "wmoUnit:Pa"),
    ]
    assert values(spark, "v STRING, u STRING", p, units.pressure_hpa(*pair)) == [
        1013, 1013, 1013, 1013, None, None, -1,
    ]
    w = [
        ("10", "wmoUnit:m_s-1"), ("36", "wmoUnit:km_h-1"), ("10", "wmoUnit:mi_h-1"), ("5", "odd"),
        (None, "wmoUnit:m_s-1"),
    ]
    near(
        values(spark, "v STRING, u STRING", w, units.wind_mps(*pair)),
        [10.0, 10.0, 4.4704, 5.0, None],
    )
    text = ["10 mph", "9 to 13 mph", "2.5 mph", "calm", "", None]
    near(
        one(spark, "STRING", text, units.wind_text_mps(X())),
        [4.4704, 9 * 0.44704, 2.5 * 0.44704, None, None, None],
    )
    near(one(spark, "STRING", ["20", "bad", None], units.percent_to_fraction(X())), [0.2, 0.0, 0.0])


def test_icons(spark):
    texts = {
        "Clear": "01d", "Mostly Sunny": "01d", "Few Clouds": "02d", "Partly Cloudy": "02d",
        "Scattered Clouds": "03d", "Broken Clouds": "04d", "Overcast": "04d", "Light Rain": "09d",
        "Rain Showers": "09d", "Showers And Thunderstorms": "09d", "Rain": "10d",
        "Thunderstorm": "11d", "Snow": "13d", "Mist": "50d", "Fog": "50d", "Fair": "01d",
        "Mostly Cloudy": "01d", "Unknown Weather": "01d", "": "01d", None: "01d",
    }
    assert one(spark, "STRING", list(texts), conditions.icon_code(X())) == list(texts.values())


def test_compass(spark):
    labels = ["N", "NNE", "ESE", "S", "NNW", "nw", "XX", "", None]
    assert one(spark, "STRING", labels, conditions.compass_degrees(X())) == [
        0, 22, 112, 180, 337, 0, 0, None, None,
    ]


def test_reports_name_missing_values(spark):
    df = spark.createDataFrame([(15.5, None)], "temp DOUBLE, humidity INT")
    assert df.select(conditions.describe(df)).first()[0] == (
        "15.5°C, Unknown, Humidity: N/A%, Wind: N/A m/s"
    )


def test_times(spark):
    texts = [
        "2024-01-15T18:00:00-05:00", "2024-01-15T20:00:00-05:00", "2024-01-15T10:00:00Z", "soon",
        "", None,
    ]
    assert one(spark, "STRING", texts, clock.iso_to_utc(X())) == [
        datetime(2024, 1, 15, 23), datetime(2024, 1, 16, 1), datetime(2024, 1, 15, 10), None, None,
        None,
    ]
    assert one(spark, "STRING", texts, clock.iso_local_date(X())) == [
        date(2024, 1, 15), date(2024, 1, 15), date(2024, 1, 15), None, None, None,
    ]
    assert one(spark, "BIGINT", [1704067200], clock.epoch_to_utc(X())) == [datetime(2024, 1, 1)]
    days = [date(2024, 1, 7), date(2024, 1, 13)]
    assert one(spark, "DATE", days, clock.day_of_week(X())) == [0, 6]


def test_rounding_goes_through_decimals(spark):
    data = [1.005, 2.675, -1.005, 2.5, 1e15, None]
    assert one(spark, "DOUBLE", data, round_to("x", 2)) == [1.01, 2.68, -1.01, 2.5, 1e15, None]
    assert one(spark, "DOUBLE", [0.5, 1.5, -0.5], round_to("x", 0)) == [1.0, 2.0, -1.0]
    # Rounded once: not to six digits first.
    assert one(spark, "DOUBLE", [0.4499999996, 0.44999999999999996], round_to("x", 1)) == [0.4, 0.5]


def test_coverage_boxes_and_edges(spark):
    points = [
        (42.36, -71.06), (61.2, -149.9), (21.3, -157.9), (18.2, -66.5), (51.5, -0.1), (24.5, -125.0),
        (49.4, -66.9), (49.41, -66.9), (17.8, -65.2), (None, -70.0),
    ]
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(points)], "i INT, lat DOUBLE, lon DOUBLE")
    inside = [0, 1, 2, 3, 5, 6, 8]
    assert [r.i for r in coverage_filter(df).orderBy("i").collect()] == inside
    named = [(r.i, r.region) for r in coverage_region(df).orderBy("i").collect()]
    assert named == list(
        zip(inside, ["continental", "alaska", "hawaii", "puerto_rico", "continental", "continental",
                     "puerto_rico"])
    )


@settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(st.lists(st.floats(-200, 200), min_size=1, max_size=50))
def test_bands_are_total_and_rise_and_ranges_are_idempotent(spark, xs):
    labels = one(spark, "DOUBLE", xs, rules.band("x", rules.TEMP_CATEGORY))
    order = rules.TEMP_CATEGORY.labels
    ranks = [order.index(label) for label in labels]
    assert [r for _, r in sorted(zip(xs, ranks))] == sorted(ranks)
    df = spark.createDataFrame([(x,) for x in xs], "temp DOUBLE")
    once = rules.null_out_of_range(df, rules.CURRENT_RANGES)
    twice = rules.null_out_of_range(once, rules.CURRENT_RANGES)
    assert once.exceptAll(twice).isEmpty() and twice.exceptAll(once).isEmpty()
