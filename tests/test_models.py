"""Models: single-site form, one-pass against joins, fan-out, batch job, hot stations."""

import json
import uuid
import re
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from checks import views as V
from skyledger import schemas
from skyledger.job import arguments, run
from skyledger.operators.latest import freshness_stats, latest_per_key, unexpired_entries
from skyledger.operators.quality import failing_rows, not_null_report, quality_verdict
from skyledger.operators.rollup import current_daily_summary, daily_mode
from skyledger.operators.stats import table_stats
from skyledger.plans import marts
from skyledger.plans.daily import int_weather_summary
from skyledger.plans.staging import stg_current_weather
from skyledger.sources.tables import adhoc, append_raw, as_view, read_raw
from skyledger.sources.versions import read_table
from tests.conftest import SF, rows

CURRENT = (
    "location_id STRING, timestamp TIMESTAMP_NTZ, temp DOUBLE, feels_like DOUBLE, humidity INT, "
    "pressure INT, wind_speed DOUBLE, wind_deg INT, description STRING, icon STRING"
)


@pytest.fixture(scope="module")
def days(spark):
    return int_weather_summary(*V.raw_views(spark, SF)).cache()


def same(a, b):
    assert a.columns == b.columns
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_one_pass_trends_equal_the_join_form(days):
    same(marts.weather_trends(days), marts.weather_trends_by_joins(days))


def test_days_without_an_average_keep_their_row(days):
    trends = marts.weather_trends(days)
    assert trends.count() == days.count()
    lacking = days.filter("final_avg_temp IS NULL").select("location_id", "date")
    kept = trends.join(lacking, ["location_id", "date"])
    assert kept.count() == lacking.count() > 0
    assert kept.filter("temp_trend_direction IS NOT NULL OR weather_pattern IS NOT NULL").isEmpty()
    assert [tuple(r) for r in kept.select("temperature_anomaly", "temperature_stability").distinct().collect()] == [
        ("seasonal_normal", "low_variability")
    ]


def test_single_site_form_needs_no_location(spark, days):
    """At the smallest scale there is one location, so leaving the key out changes nothing."""
    assert days.select("location_id").distinct().count() == 1
    raw = [v.drop("location_id") for v in V.raw_views(spark, SF)]
    single = int_weather_summary(*raw, by=())
    same(single, days.drop("location_id"))
    same(marts.weather_summary(single, ()), marts.weather_summary(days).drop("location_id"))
    same(marts.weather_trends(single, ()), marts.weather_trends(days).drop("location_id"))
    same(marts.weather_trends(single, ()), marts.weather_trends_by_joins(single, ()))


def test_repeated_forecast_dates_fan_out_like_sql(spark):
    current, hourly, daily = V.raw_views(spark, SF)
    twice = int_weather_summary(current, hourly, daily.unionByName(daily))
    once = int_weather_summary(current, hourly, daily)
    repeated = daily.filter("date IS NOT NULL").count()
    assert twice.count() == once.count() + repeated
    joined = marts.weather_trends_by_joins(twice)
    day = daily.join(once.filter("final_avg_temp IS NOT NULL"), ["location_id", "date"]).first()
    same_day = (F.col("date") == F.lit(day.date)) & (F.col("location_id") == day.location_id)
    assert joined.filter(same_day).count() == 2**4


def observations(spark, *items):
    base = ("A", None, 1.0, 1.0, 50, 1000, 1.0, 0, "Fog", "50d")
    names = [f.split()[0] for f in CURRENT.split(", ")]
    data = [tuple({**dict(zip(names, base)), **i}[n] for n in names) for i in items]
    return spark.createDataFrame(data, CURRENT)


def test_daily_rollup_by_hand(spark):
    t = lambda h, d=1: datetime(2024, 1, d, h)
    raw = observations(
        spark,
        dict(timestamp=t(1), temp=-5.0, description="Snow", wind_speed=6.0),
        dict(timestamp=t(2), temp=99.0, description="Fog", humidity=101),
        dict(timestamp=t(3), temp=5.0, description="Snow", wind_speed=None),
        dict(timestamp=t(4), temp=5.0, description="Fog", humidity=60),
        dict(timestamp=t(5), temp=None, description=None),
        dict(timestamp=None, temp=40.0),
        dict(timestamp=t(1, 2), temp=None, feels_like=None, description=None, location_id="B"),
    )
    first, second = rows(current_daily_summary(stg_current_weather(raw)), "date")
    assert first == {
        "location_id": "A", "date": date(2024, 1, 1), "avg_temp": 5 / 3, "min_temp": -5.0,
        "max_temp": 5.0, "avg_feels_like": 1.0, "avg_humidity": 52.5, "avg_pressure": 1000.0,
        "avg_wind_speed": 2.25, "readings_count": 5,
        # Two each: the smaller text wins. NULL temperatures count as hot.
        "most_common_description": "Fog", "most_common_temp_category": "cold",
        "most_common_wind_category": "light",
    }
    assert second["avg_temp"] is None and second["avg_feels_like"] is None
    assert second["most_common_description"] is None
    assert (second["most_common_temp_category"], second["readings_count"]) == ("hot", 1)


def test_a_station_with_most_readings_gives_whole_results(spark):
    """One station and day hold most rows; the rollup and the mode equal a plain count."""
    n = 60_000
    base = spark.range(n).select(
        F.when(F.col("id") % 3 < 2, "HOT").otherwise(F.concat(F.lit("S"), F.col("id") % 50)).alias("location_id"),
        F.lit(datetime(2024, 1, 1, 5)).cast("timestamp_ntz").alias("timestamp"),
        (F.col("id") % 40 / 2).alias("temp"), F.lit(1.0).alias("feels_like"),
        F.lit(50).alias("humidity"), F.lit(1000).alias("pressure"), F.lit(1.0).alias("wind_speed"),
        F.lit(0).alias("wind_deg"), F.concat(F.lit("text "), F.col("id") % 7).alias("description"),
        F.lit("01d").alias("icon"),
    )
    got = {r["location_id"]: r for r in rows(current_daily_summary(stg_current_weather(base)))}
    data = base.toPandas()
    assert len(got) == data.location_id.nunique()
    for site, part in data.groupby("location_id"):
        counts = part.description.value_counts()
        top = sorted(counts[counts == counts.max()].index)[0]
        assert got[site]["readings_count"] == len(part)
        assert got[site]["avg_temp"] == pytest.approx(part.temp.mean())
        assert got[site]["most_common_description"] == top
    modes = daily_mode(base, "description", out="d")
    assert {r.location_id: r.d for r in modes.collect()} == {
        k: r["most_common_description"] for k, r in got.items()
    }


def test_latest_and_expiry(spark):
    now, ttl = datetime(2024, 1, 1, 12), 3600
    at = lambda m: datetime(2024, 1, 1, 11, m)
    df = spark.createDataFrame(
        [("a", at(0), 1), ("a", datetime(2024, 1, 1, 10), 2), ("b", datetime(2024, 1, 1, 10, 59, 59), 3),
         ("c", at(5), 4), ("c", at(5), 5), ("d", None, 6)],
        "k STRING, t TIMESTAMP_NTZ, v INT",
    )
    newest = {r.k: r.v for r in latest_per_key(df, ["k"], "t", ["v"]).collect()}
    assert newest == {"a": 1, "b": 3, "c": 5, "d": 6}
    # Exactly one hour old is fresh, one second more is not.
    fresh = {r.k: r.v for r in unexpired_entries(df, ["k"], "t", now, ttl, ["v"]).collect()}
    assert fresh == {"a": 1, "c": 5}
    stats = freshness_stats(df.filter("t IS NOT NULL"), ["k"], "t", now, ttl).first()
    assert tuple(stats) == (3, 1, 2, 3600)


def test_severities_and_verdict(spark):
    def with_nulls(n):
        return spark.range(200).select(
            F.when(F.col("id") >= n, F.lit(datetime(2024, 1, 1)).cast("timestamp_ntz")).alias("timestamp")
        )

    tables = {f"t{n}": (with_nulls(n), "timestamp") for n in (0, 10, 11, 100, 101)}
    report = {r.table_name: (r.failing_rows, r.status) for r in not_null_report(tables).collect()}
    assert report == {
        "t0": (0, "pass"), "t10": (10, "pass"), "t11": (11, "warn"), "t100": (100, "warn"),
        "t101": (101, "error"),
    }
    assert failing_rows(tables).count() == 222

    empty = [spark.createDataFrame([], v.schema) for v in V.raw_views(spark, SF)]
    assert quality_verdict(*empty).first().quality_passed is True
    current, hourly, daily = V.raw_views(spark, SF)
    verdict = quality_verdict(current, hourly, daily.limit(2)).first()
    assert verdict.daily_enough is False and verdict.quality_passed is False


def test_schema_checks_views_and_tables(spark):
    df = observations(spark, dict(timestamp=datetime(2024, 1, 1)))
    assert schemas.missing_columns(df, schemas.RAW_HOURLY) == ["pop"]
    as_view(df, "some_view")
    assert schemas.missing_relations(spark, ["some_view", "other_view"]) == ["other_view"]
    assert adhoc(spark, "SELECT count(*) AS n FROM some_view").first().n == 1
    schemas.create_raw_tables(spark)
    schemas.create_raw_tables(spark)
    schemas.insert_raw(df.select(*reversed(df.columns)), "current_weather")
    stored = spark.table("current_weather")
    assert stored.drop("location_id", "event_date").schema == schemas.RAW_CURRENT
    assert stored.first().temp == 1.0
    stats = {r.table_name: r.records for r in table_stats({"current_weather": (stored, "timestamp")}).collect()}
    assert stats == {"current_weather": 1, "total": 1}


def test_layout_prunes_days_and_pushes_times(spark, tmp_path):
    current, _, _ = V.raw_views(spark, SF)
    root = str(tmp_path)
    append_raw(current, root, "current_weather")
    append_raw(current.limit(0), root, "current_weather")
    back = read_raw(spark, root, "current_weather")
    assert back.count() == current.count()
    since, until = date(1997, 1, 1), date(1997, 3, 1)
    part = read_raw(spark, root, "current_weather", since, until).filter("location_id = '0'")
    plan = part._jdf.queryExecution().executedPlan().toString()
    filters = re.search(r"PartitionFilters: \[(.*?)\], PushedFilters: \[(.*?)\]", plan)
    assert "event_date" in filters[1] and "location_id" in filters[2]
    want = current.filter("timestamp >= '1997-01-01' AND timestamp < '1997-03-01'")
    assert part.count() == want.count() > 0


def land(folder, kind, name, body):
    place = folder / kind / "location_id=A"
    place.mkdir(parents=True, exist_ok=True)
    (place / name).write_text(json.dumps(body))


def test_batch_job_end_to_end(spark, tmp_path):
    landed, root = tmp_path / "landed", str(tmp_path / "out")
    observation = {"timestamp": "2024-01-15T10:00:00Z", "temperature": {"value": 5.0}}
    land(landed, "current", "1.json", {"properties": observation})
    land(landed, "current", "2.json", {"properties": {}})
    hours = [
        {"startTime": f"2024-01-15T{h:02d}:00:00Z", "temperature": 41, "temperatureUnit": "F"}
        for h in range(24)
    ]
    land(landed, "hourly", "1.json", {"properties": {"periods": hours}})
    forecast = [{"startTime": "2024-01-15T06:00:00Z", "isDaytime": True, "temperature": 50}]
    land(landed, "daily", "1.json", {"properties": {"periods": forecast}})
    run(spark, arguments(["ingest", "--landed", str(landed), "--root", root]))
    # The same forecast is polled once more, warmer: the newer one counts.
    again = tmp_path / "later"
    land(again, "daily", "1.json", {"properties": {"periods": [{**forecast[0], "temperature": 59}]}})
    import os

    os.utime(again / "daily" / "location_id=A" / "1.json", (2e9, 2e9))
    for kind in ("current", "hourly"):
        land(again, kind, "1.json", {"properties": {}})
    run(spark, arguments(["ingest", "--landed", str(again), "--root", root]))
    run(spark, arguments(["marts", "--root", root]))
    (day,) = read_table(spark, f"{root}/int_weather_summary").collect()
    assert (day.location_id, day.date) == ("A", date(2024, 1, 15))
    assert (day.readings_count, day.hourly_readings_count) == (1, 24)
    assert day.forecast_temp_max == pytest.approx(15.0) and day.final_avg_temp == 5.0
    (summary,) = read_table(spark, f"{root}/weather_summary").collect()
    assert summary.business_temperature_category == "Cold" and summary.last_updated_at is not None
    (trend,) = read_table(spark, f"{root}/weather_trends").collect()
    assert trend.temp_trend_direction == "stable" and trend.temperature_7day_volatility is None
    reasons = {
        r.reason for k in ("current", "hourly")
        for r in spark.read.parquet(f"{root}/quarantine/{k}").collect()
    }
    assert reasons == {"temperature_missing", "periods_missing"}


def counted(spark, root):
    (day,) = read_table(spark, f"{root}/int_weather_summary").filter("date = '2023-04-02'").collect()
    return day.readings_count, day.hourly_readings_count


def test_repeats_and_reruns_count_once_and_days_are_replaced_alone(spark, tmp_path):
    import glob
    import os

    landed, root = tmp_path / "landed", str(tmp_path / "out")
    for n in (1, 2, 3):  # three polls of the same readings
        seen = {"timestamp": "2023-04-02T09:00:00Z", "temperature": {"value": 11.0 + n}}
        land(landed, "current", f"{n}.json", {"properties": seen})
        hours = [{"startTime": f"2023-04-02T{h:02d}:00:00Z", "temperature": 60 + n} for h in range(6)]
        land(landed, "hourly", f"{n}.json", {"properties": {"periods": hours}})
        for kind in ("current", "hourly"):
            os.utime(landed / kind / "location_id=A" / f"{n}.json", (1.7e9 + n, 1.7e9 + n))
    land(landed, "daily", "1.json", {"properties": {"periods": []}})
    for _ in range(2):
        run(spark, arguments(["ingest", "--landed", str(landed), "--root", root]))
    run(spark, arguments(["marts", "--root", root]))
    assert counted(spark, root) == (1, 6)
    assert read_raw(spark, root, "current_weather").count() == 3
    assert read_table(spark, f"{root}/int_weather_summary").first().avg_temp == 14.0

    # A new day touches its own partition only, and gives what a full rebuild gives.
    old = glob.glob(f"{root}/int_weather_summary/data/*/event_date=2023-04-02/*.parquet")
    seen = {"timestamp": "2023-04-03T09:00:00Z", "temperature": {"value": 2.0}}
    land(landed, "current", "4.json", {"properties": seen})
    run(spark, arguments(["ingest", "--landed", str(landed), "--root", root]))
    run(spark, arguments(["marts", "--root", root, "--since", "2023-04-03"]))
    assert old == glob.glob(f"{root}/int_weather_summary/data/*/event_date=2023-04-02/*.parquet")
    days = lambda: sorted(map(str, read_table(spark, f"{root}/int_weather_summary").collect()))
    step = days()
    run(spark, arguments(["marts", "--root", root]))
    assert step == days() and len(step) == 2
    assert read_table(spark, f"{root}/weather_trends").count() == 2

    run(spark, arguments(["quality", "--root", root]))
    report = {r.table_name: r.status for r in spark.read.parquet(f"{root}/quality/report").collect()}
    assert report == {"current_weather": "pass", "hourly_weather": "pass", "daily_weather": "pass"}
    assert spark.read.parquet(f"{root}/quality/failures").count() == 0
    assert spark.read.parquet(f"{root}/quality/verdict").first().hourly_enough


def test_a_failed_rebuild_leaves_the_old_table(spark, tmp_path):
    from skyledger.sources.tables import rebuild_table

    path = str(tmp_path / "t")
    rebuild_table(spark.range(3), path)
    with pytest.raises(Exception, match="boom"):
        rebuild_table(spark.range(5).select(F.raise_error(F.lit("boom")).cast("long").alias("id")), path)
    assert spark.read.parquet(path).count() == 3
    rebuild_table(spark.read.parquet(path).union(spark.range(1)), path)
    assert spark.read.parquet(path).count() == 4


def test_rollup_job_emits_closed_days(spark, tmp_path):
    landed, root = tmp_path / "landed", str(tmp_path / "out")
    readings = [("04-01T05", 1.0), ("04-01T07", 3.0), ("04-01T07", 3.0), ("04-09T01", 8.0), ("05-02T01", 2.0)]
    action = ["rollup", "--landed", str(landed), "--root", root, "--job", uuid.uuid4().hex]
    for n, (time, temp) in enumerate(readings):
        seen = {"timestamp": f"2023-{time}:00:00Z", "temperature": {"value": temp}}
        land(landed, "current", f"{n}.json", {"properties": seen})
        if n >= 2:
            run(spark, arguments(action))
    days = spark.read.parquet(f"{root}/current_daily_summary").orderBy("date").collect()
    assert [(r.location_id, r.date, r.readings_count, r.avg_temp) for r in days] == [
        ("A", date(2023, 4, 1), 2, 2.0), ("A", date(2023, 4, 9), 1, 8.0),
    ]
