"""Flatteners on hand-written documents: defaults, absent against null, malformed input."""

from datetime import date, datetime, timedelta

import pytest

from skyledger.sources.combined import (
    combined_current,
    combined_daily,
    combined_faults,
    combined_hourly,
    validate_combined,
)
from skyledger.sources.directory import first_station, first_usable_station, points_directory
from skyledger.sources.documents import split_valid, validate_documents
from skyledger.sources.forecast import daily_rows, hourly_rows
from skyledger.sources.observation import observation_rows
from tests.conftest import rows

DOC = ("doc_id",)
ARRIVED = datetime(2024, 2, 1, 12)


def q(value, unit=None):
    return {"value": value} if unit is None else {"value": value, "unitCode": f"wmoUnit:{unit}"}


def obs(**properties):
    return {"properties": properties}


def periods(*items):
    return {"properties": {"periods": list(items)}}


def near(x):
    return pytest.approx(x, abs=1e-9)


def test_plain_observation(documents):
    docs = documents(
        obs(
            timestamp="2023-07-09T23:45:30-02:30",
            temperature=q(-11.25, "degC"),
            relativeHumidity=q(87.2),
            windSpeed=q(45.0, "km_h-1"),
            windDirection=q(233),
            barometricPressure=q(98760, "Pa"),
            textDescription="Blowing Snow",
            windChill=q(-20.5, "degC"),
        )
    )
    assert rows(observation_rows(docs, DOC)) == [
        {
            "doc_id": 0, "timestamp": datetime(2023, 7, 10, 2, 15, 30), "temp": -11.25,
            "feels_like": -20.5, "humidity": 87, "pressure": 987, "wind_speed": near(12.5),
            "wind_deg": 233, "description": "Blowing Snow", "icon": "13d",
        }
    ]


def test_observation_defaults_and_rejects(documents):
    docs = documents(
        obs(temperature=q(10.0), windChill=q(1.1), heatIndex=q(None)),
        obs(temperature="not a quantity", textDescription=None),
        obs(temperature=None, timestamp="bad"),
        obs(textDescription="no temperature"),
        {},
        obs(temperature=q(20.0, "odd"), barometricPressure=q(101325, "odd"), windSpeed=q(5.0, "odd")),
        obs(temperature=q("bad"), heatIndex=q("bad"), windChill=q(3.0)),
        '{"properties": ',
        '["a list"]',
        '{"properties": null}',
    )
    got = {r["doc_id"]: r for r in rows(observation_rows(docs, DOC))}
    assert sorted(got) == [0, 1, 2, 5, 6]
    assert (got[0]["temp"], got[0]["feels_like"], got[0]["humidity"]) == (10.0, 1.1, None)
    assert got[0]["description"] == "Unknown" and got[0]["timestamp"] == ARRIVED
    assert (got[1]["temp"], got[1]["description"], got[1]["icon"]) == (None, None, "01d")
    assert got[2]["temp"] is None and got[2]["timestamp"] == ARRIVED
    assert (got[5]["temp"], got[5]["pressure"], got[5]["wind_speed"]) == (20.0, 1013, 5.0)
    # A heat index that is there but unreadable is not replaced by the wind chill.
    assert (got[6]["temp"], got[6]["feels_like"]) == (None, None)


def test_hourly_periods(documents):
    start = "2023-11-30T21:00:00+01:00"
    docs = documents(
        periods(
            {
                "startTime": start, "temperature": 77, "temperatureUnit": "F",
                "windSpeed": "25 to 30 mph", "windDirection": "ESE", "shortForecast": "Heavy Thunderstorms",
                "probabilityOfPrecipitation": {"value": 85}, "relativeHumidity": {"value": 92.4},
            },
            {"startTime": start},
            {
                "startTime": start, "temperature": None, "windSpeed": None, "windDirection": None,
                "shortForecast": None, "probabilityOfPrecipitation": None,
            },
            {
                "startTime": start, "temperature": 7, "temperatureUnit": "C", "windSpeed": 12,
                "windDirection": "XX", "probabilityOfPrecipitation": 30, "relativeHumidity": 61,
            },
            {"startTime": start, "temperature": "warm"},
            {"temperature": 77},
            {"startTime": "soon", "temperature": 77},
            "not a period",
            {
                "startTime": start, "temperature": "50", "windDirection": "",
                "probabilityOfPrecipitation": {"value": "n/a"},
            },
        ),
        periods(),
        {"properties": {"periods": "not_a_list"}},
    )
    got = rows(hourly_rows(docs, DOC))
    assert len(got) == 5
    by_pop = [
        (r["temp"], r["humidity"], r["wind_speed"], r["wind_deg"], r["description"], r["icon"], r["pop"])
        for r in got
    ]
    assert (near(25.0), 92, near(11.176), 112, "Heavy Thunderstorms", "11d", near(0.85)) in by_pop
    assert (None, None, 0.0, 0, "Unknown", "01d", 0.0) in by_pop
    assert (None, None, None, None, None, "01d", 0.0) in by_pop
    assert (7.0, 61, None, 0, "Unknown", "01d", near(0.3)) in by_pop
    assert (near(10.0), None, 0.0, None, "Unknown", "01d", 0.0) in by_pop
    assert {r["timestamp"] for r in got} == {datetime(2023, 11, 30, 20)}
    assert all(r["feels_like"] == r["temp"] and r["pressure"] is None for r in got)


def test_hourly_keeps_every_period_unless_told_otherwise(documents):
    item = lambda i: {"startTime": f"2023-05-{1 + i // 24:02d}T{i % 24:02d}:00:00Z"}
    docs = documents(periods({"temperature": 1}, *[item(i) for i in range(60)]))
    got = rows(hourly_rows(docs, DOC), "timestamp")
    assert len(got) == 60 and got[-1]["timestamp"] == datetime(2023, 5, 3, 11)
    some = rows(hourly_rows(docs, DOC, max_periods=20), "timestamp")
    assert len(some) == 19 and some[-1]["timestamp"] == datetime(2023, 5, 1, 18)


def day(start, is_day, temp, wind="10 mph", direction="N", text="Sunny", pop=0, **more):
    return {
        "startTime": start, "isDaytime": is_day, "temperature": temp, "windSpeed": wind,
        "windDirection": direction, "shortForecast": text,
        "probabilityOfPrecipitation": {"value": pop}, **more,
    }


def test_day_and_night_become_one_row(documents):
    docs = documents(
        periods(
            day("2023-03-04T07:00:00+11:00", True, 86, "20 mph", "SSW", "Isolated Thunderstorms", 65),
            day("2023-03-04T19:00:00+11:00", False, 59, "15 to 25 mph", "W", "Mostly Clear", 40),
            day("2023-03-06T07:00:00+11:00", True, 95, "5 mph", "E", "Hot", 5),
            day("2023-03-09T22:00:00+11:00", False, 14),
        )
    )
    first, second, third = rows(daily_rows(docs, DOC), "date")
    assert first == {
        "doc_id": 0, "date": date(2023, 3, 4), "temp_min": near(15.0), "temp_max": near(30.0),
        "temp_day": near(30.0), "temp_night": near(15.0), "humidity": None, "pressure": None,
        "wind_speed": near(8.9408), "wind_deg": 202, "description": "Isolated Thunderstorms",
        "icon": "11d", "pop": near(0.65),
    }
    assert second["temp_min"] == second["temp_night"] == near(30.0)
    assert third["date"] == date(2023, 3, 9)
    assert third["temp_max"] == third["temp_day"] == near(-5.0)


def test_fold_order_rules(documents):
    at = "2024-01-15T0{}:00:00Z".format
    docs = documents(
        # Night first: it fills everything; the day then overrides, but not with unreadable wind.
        periods(
            day(at(1), False, 32, "5 mph", "S", "Fog", 50),
            day(at(2), True, 50, "calm", "E", None, 10),
            day(at(3), False, None, "9 mph", "W", "Rain", 20),
        ),
        # Two nights before a day without wind: direction stays with the first numeric night.
        periods(
            day(at(1), False, 32, "calm", "S", "Fog"),
            day(at(2), False, 33, "4 mph", "E", "Rain"),
            day(at(3), False, 34, "6 mph", "W", "Snow"),
        ),
        # A broken temperature: the date exists, the period's other values do not count.
        periods(day(at(1), True, "hot", "5 mph", "S", "Fog", 90)),
        periods(day(at(1), True, "hot", "5 mph", "S", "Fog", 90), day(at(2), False, 32, None, None)),
        # isDaytime absent means day, null means night.
        periods({"startTime": at(1), "temperature": 50}, {"startTime": at(2), "temperature": 32, "isDaytime": None}),
    )
    a, b, c, d, e = rows(daily_rows(docs, DOC), "doc_id")
    assert (a["wind_speed"], a["wind_deg"]) == (near(5 * 0.44704), 90)
    assert (a["description"], a["icon"], a["pop"]) == ("Rain", "10d", near(0.5))
    assert (a["temp_day"], a["temp_night"]) == (near(10.0), near(0.0))
    assert (b["wind_speed"], b["wind_deg"], b["description"]) == (near(4 * 0.44704), 90, "Fog")
    assert b["temp_night"] == near(10 / 9)
    assert c["date"] == date(2024, 1, 15)
    assert [c[k] for k in ("temp_min", "temp_max", "wind_speed", "description", "icon")] == [None] * 5
    assert c["pop"] == 0.0
    assert (d["temp_max"], d["wind_speed"], d["wind_deg"], d["pop"]) == (near(5.0), None, None, 0.0)
    assert (e["temp_day"], e["temp_night"], e["wind_speed"], e["wind_deg"]) == (near(10.0), near(0.0), 0.0, 0)


def test_every_date_is_kept_unless_told_otherwise(documents):
    docs = documents(periods(*[day(f"2023-06-{d:02d}T06:00:00Z", True, 50) for d in range(12, 0, -1)]))
    days = lambda **more: [r["date"].day for r in rows(daily_rows(docs, DOC, **more), "date")]
    assert days() == list(range(1, 13))
    assert days(max_dates=5) == [1, 2, 3, 4, 5]


def test_points_and_stations(documents):
    full = {"forecast": "f", "forecastHourly": "h", "observationStations": "s"}
    docs = documents(
        {"properties": full},
        {"properties": {**full, "forecast": ""}},
        {"properties": {"forecast": "f"}},
        {"properties": None},
    )
    assert rows(points_directory(docs, DOC)) == [
        {"doc_id": 0, "forecast_url": "f", "hourly_url": "h", "stations_url": "s"}
    ]
    station = lambda s: {"properties": {"stationIdentifier": s}}
    docs = documents(
        {"features": [station("A"), station("B")]},
        {"features": [station(None), {"properties": {}}, station("C")]},
        {"features": []},
        {},
        {"features": [station("")]},
    )
    assert [(r["doc_id"], r["station_id"]) for r in rows(first_station(docs, DOC))] == [(0, "A")]
    usable = rows(first_usable_station(docs, DOC), "doc_id")
    assert [(r["doc_id"], r["station_id"]) for r in usable] == [(0, "A"), (1, "C")]


def test_shape_checks(documents):
    def reasons(kind, *bodies):
        return [r["reason"] for r in rows(validate_documents(documents(*bodies), kind), "doc_id")]

    assert reasons("points", {"properties": {"forecast": 1, "forecastHourly": 2}}, {}) == [
        None, "properties_missing",
    ]
    assert reasons("current", obs(temperature=None), obs(), "[]", "nonsense") == [
        None, "temperature_missing", "not_an_object", "unreadable",
    ]
    for kind in ("hourly", "daily"):
        assert reasons(kind, periods(), obs(), obs(periods="no"), obs(periods=None)) == [
            None, "periods_missing", "periods_not_a_list", "periods_not_a_list",
        ]
    with pytest.raises(ValueError):
        validate_documents(documents({}), "weekly")
    good, bad = split_valid(documents(obs(temperature=1), {}), "current")
    assert good.columns == ["doc_id", "body", "ingested_at"] and good.count() == 1
    assert [r["reason"] for r in rows(bad)] == ["properties_missing"]


def reading(dt=1704067200, **changes):
    base = {
        "dt": dt, "temp": 1.5, "feels_like": 0.5, "humidity": 60, "pressure": 1000,
        "wind_speed": 3.25, "wind_deg": 90, "weather": [{"description": "mist", "icon": "50d"}],
    }
    return {k: v for k, v in {**base, **changes}.items() if v != "absent"}


def test_combined_documents(documents):
    span = {"min": 1.0, "max": 9.0, "day": 8.0, "night": 2.0}
    full = {
        "current": reading(),
        "hourly": [reading(1704067200 + 3600 * i, pop=0.5) for i in range(50)],
        "daily": [reading(1704067200 + 86400 * i, temp=span) for i in range(9)],
    }
    docs = documents(
        full,
        {"current": reading(temp="absent")},
        {"hourly": [reading(), reading(weather=[])]},
        {"hourly": [reading(temp=None)]},
        {"hourly": "none"},
        {},
        {**full, "hourly": [*full["hourly"][:49], reading(temp="absent")]},
    )
    assert [r["doc_id"] for r in rows(combined_current(docs, DOC), "doc_id")] == [0]
    hours = rows(combined_hourly(docs, DOC), "doc_id", "timestamp")
    assert [sum(r["doc_id"] == d for r in hours) for d in range(7)] == [50, 0, 0, 1, 0, 0, 0]
    assert hours[0]["pop"] == 0.5 and hours[50]["temp"] is None and hours[50]["pop"] == 0.0
    days = rows(combined_daily(docs, DOC), "doc_id", "date")
    assert len(days) == 9 and days[8]["date"] == date(2024, 1, 9)
    assert len(rows(combined_hourly(docs, DOC, max_entries=48))) == 49
    assert len(rows(combined_daily(docs, DOC, max_entries=7))) == 7
    assert (days[0]["temp_min"], days[0]["temp_night"], days[0]["icon"]) == (1.0, 2.0, "50d")
    faults = {r["doc_id"]: r["reason"] for r in rows(combined_faults(docs))}
    hours_broken = {i: "hourly_incomplete" for i in (2, 4, 6)}
    assert faults == {1: "current_incomplete", **hours_broken}
    checked = {r["doc_id"]: r["reason"] for r in rows(validate_combined(docs))}
    assert checked[0] is None and checked[1] == "hourly_missing" and checked[5] == "current_missing"


def test_a_document_of_many_dates_folds_as_one_date_each(spark, documents):
    """200 dates in mixed order, day and night apart: the same as a document for each date."""
    from skyledger.sources.forecast import day_night_fold

    def period(day, is_day):
        at = date(2024, 1, 1) + timedelta(days=day)
        return {
            "startTime": f"{at}T{'06' if is_day else '18'}:00:00-05:00", "isDaytime": is_day,
            "temperature": 20 + day % 40 + 9 * is_day, "windSpeed": f"{day % 30} mph" if day % 3 or is_day else None,
            "shortForecast": f"text {day} {is_day}", "probabilityOfPrecipitation": {"value": day % 100},
        }

    mixed = [(d * 77 % 200, i % 2 == 0) for i in (0, 1) for d in range(200)]
    whole = {"properties": {"periods": [period(*p) for p in mixed]}}
    single = [{"properties": {"periods": [period(*p) for p in mixed if p[0] == d]}} for d in range(200)]
    columns = ["date", "temp_day", "temp_night", "wind_speed", "wind_deg", "description", "icon", "pop"]
    got = day_night_fold(documents(whole), ("doc_id",)).select(columns).orderBy("date").collect()
    assert len(got) == 200
    assert got == day_night_fold(documents(*single), ("doc_id",)).select(columns).orderBy("date").collect()
    first = day_night_fold(documents(whole), ("doc_id",), max_dates=7).select(columns).orderBy("date").collect()
    assert first == got[:7]


def test_no_filter_parses_documents_again(spark):
    """A filter that holds the parse would be pushed to the scan and run it twice."""
    from checks.queries import REGISTRY
    from tests.conftest import SF

    for name in ("ingest_hourly", "ingest_daily", "ingest_observation", "day_night_fold"):
        plan = REGISTRY[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert not [x for x in plan.splitlines() if "Filter" in x and ("from_json" in x or "parse_json" in x)]
