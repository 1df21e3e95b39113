import json
import time
import uuid
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from checks import views as V
from skyledger.operators.rollup import current_daily_summary
from skyledger.plans.staging import stg_current_weather
from skyledger.session import checkpoint_root
from skyledger.sources.documents import stream_documents
from skyledger.streaming.ingest import drop_repeated_polls, ingest_stream
from skyledger.streaming.rollup import daily_rollup_stream

from tests.conftest import SF


def land(folder, location, name, body):
    place = folder / f"location_id={location}"
    place.mkdir(parents=True, exist_ok=True)
    (place / name).write_text(json.dumps(body, indent=1))


def observation(temp, time):
    return {"properties": {"timestamp": time, "temperature": {"value": temp}}}


def run(query):
    query.awaitTermination(120)
    if query.exception() is not None:
        raise query.exception()


def test_ingest_takes_each_file_once(spark, tmp_path):
    landed, root, job = tmp_path / "landed", str(tmp_path / "out"), uuid.uuid4().hex
    chk = str(tmp_path / "chk")
    docs = lambda: stream_documents(spark, str(landed), max_files_per_trigger=1)
    land(landed, "A", "1.json", observation(5, "2023-08-22T10:00:00+00:00"))
    land(landed, "B", "1.json", observation(7, "2023-08-22T23:30:00-05:00"))
    land(landed, "B", "2.json", {"properties": {}})
    run(ingest_stream(docs(), "current", root, job, checkpoint=chk))
    run(ingest_stream(docs(), "current", root, job, checkpoint=chk))
    table = spark.read.parquet(f"{root}/current_weather")
    assert sorted((r.location_id, r.temp, r.event_date) for r in table.collect()) == [
        ("A", 5.0, date(2023, 8, 22)),
        ("B", 7.0, date(2023, 8, 23)),
    ]
    bad = spark.read.parquet(f"{root}/quarantine/current")
    assert [r.reason for r in bad.collect()] == ["temperature_missing"]
    land(landed, "A", "3.json", observation(6, "2023-08-22T11:00:00+00:00"))
    run(ingest_stream(docs(), "current", root, job, checkpoint=chk))
    assert spark.read.parquet(f"{root}/current_weather").count() == 3


def test_daily_documents_stream_without_state(spark, tmp_path):
    landed, root = tmp_path / "landed", str(tmp_path / "out")
    period = {"startTime": "2023-08-22T18:00:00-05:00", "isDaytime": False, "temperature": 32}
    land(landed, "A", "1.json", {"properties": {"periods": [period]}})
    query = ingest_stream(
        stream_documents(spark, str(landed)),
        "daily",
        root,
        uuid.uuid4().hex,
        checkpoint=str(tmp_path / "chk"),
    )
    run(query)
    assert all(not p["stateOperators"] for p in query.recentProgress)
    (row,) = spark.read.parquet(f"{root}/daily_weather").collect()
    assert (row.date, row.temp_min, row.temp_max) == (date(2023, 8, 22), 0.0, 5.0)


def stream_of(spark, df, tmp_path):
    """Write a frame as a few parquet files in time order and stream them one by one."""
    path = str(tmp_path / "rows")
    edges = [datetime(1995, 1, 1), datetime(1997, 6, 1), datetime(1999, 6, 1), datetime(2003, 1, 1)]
    for start, end in zip(edges, edges[1:]):
        part = df.filter((F.col("timestamp") >= F.lit(start)) & (F.col("timestamp") < F.lit(end)))
        part.coalesce(1).write.mode("append").parquet(path)
        time.sleep(1.1)
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(path)


def to_memory(df, name, chk):
    query = (
        df.writeStream.format("memory").queryName(name).outputMode("append")
        .option("checkpointLocation", chk).trigger(availableNow=True).start()
    )
    run(query)
    return df.sparkSession.table(name)


def test_daily_rollup_stream_equals_batch_for_closed_days(spark, tmp_path):
    raw = V.view(spark, SF, "raw_current")
    stream = daily_rollup_stream(stream_of(spark, raw, tmp_path), "1 day")
    got = to_memory(stream, "rollup_out", str(tmp_path / "chk"))
    want = current_daily_summary(stg_current_weather(raw))
    last = got.agg(F.max("date")).first()[0]
    newest = want.agg(F.max("date")).first()[0]
    assert (newest - last).days <= 40
    closed = want.filter(F.col("date") <= F.lit(last))
    assert got.count() == closed.count() > 1000
    assert got.exceptAll(closed).isEmpty()


def test_repeated_polls_are_dropped(spark, tmp_path):
    raw = V.view(spark, SF, "raw_current").select("location_id", "timestamp").distinct()
    twice = raw.unionByName(raw)
    stream = drop_repeated_polls(stream_of(spark, twice, tmp_path), "3000 days")
    got = to_memory(stream.drop("event_time"), "dedupe_out", str(tmp_path / "chk"))
    assert got.count() == raw.filter("timestamp IS NOT NULL").count()
    assert got.distinct().count() == got.count()


def test_checkpoint_folder_comes_from_the_session():
    class Session:
        def __init__(self, **settings):
            self.conf = settings

    named = Session(**{"spark.checkpoint.dir": "/shared/named/"})
    assert checkpoint_root(named, "/other") == "/shared/named"
    assert checkpoint_root(Session(), "/shared/fallback/") == "/shared/fallback"
    with pytest.raises(ValueError):
        checkpoint_root(Session())
