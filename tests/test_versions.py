"""Tables in versions, and rolling windows of changed days against a full rebuild."""

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from skyledger.plans import incremental
from skyledger.plans.incremental import refresh_rolling
from skyledger.plans.marts import rolled_days
from skyledger.sources import versions
from skyledger.sources.versions import Store, expire, publish, read_table, stored_days, table_exists

DAY0 = date(2024, 1, 1)


def frame(spark, *rows):
    return spark.createDataFrame(rows, "date date, x int")


def content(spark, path, *bounds):
    return sorted((str(r.date), r.x) for r in read_table(spark, path, *bounds).collect())


def test_days_are_replaced_and_readers_keep_their_version(spark, tmp_path):
    path = str(tmp_path / "t")
    assert not table_exists(spark, path)
    with pytest.raises(FileNotFoundError):
        read_table(spark, path)
    days = [DAY0 + timedelta(days=i) for i in range(4)]
    publish(frame(spark, *[(d, i) for i, d in enumerate(days)], (None, 9)), path)
    before = read_table(spark, path)
    publish(frame(spark, (days[2], 20), (days[2], 21)), path, since=days[1], until=days[3])
    assert content(spark, path) == sorted([(str(days[0]), 0), (str(days[2]), 20), (str(days[2]), 21), (str(days[3]), 3), ("None", 9)])
    assert before.count() == 5
    assert stored_days(spark, path) == [str(days[i]) for i in (0, 2, 3)]
    assert content(spark, path, days[2], days[3]) == [(str(days[2]), 20), (str(days[2]), 21)]
    # Only the folders of the days asked for are read.
    assert all(str(days[3]) in f for f in read_table(spark, path, days[3]).inputFiles())
    assert content(spark, path, date(2030, 1, 1)) == []
    with pytest.raises(ValueError, match="outside"):
        publish(frame(spark, (days[0], 1)), path, since=days[1])
    with pytest.raises(ValueError, match="columns"):
        publish(frame(spark, (days[1], 1)).withColumn("y", F.lit(1)), path, since=days[1])
    publish(frame(spark).limit(0), path, since=days[3])
    assert stored_days(spark, path) == [str(days[0]), str(days[2])]
    now = content(spark, path)
    expire(spark, path, keep=1)
    assert content(spark, path) == now
    kept = [f for f in (tmp_path / "t" / "data").rglob("*.parquet")]
    assert len({f.parent.name for f in kept}) == 3 and len((list((tmp_path / "t" / "manifests").glob("*.json")))) == 1
    publish(frame(spark).limit(0), path)
    assert content(spark, path) == []


@pytest.mark.parametrize("step", ["data", "create", "rename", "names"])
def test_a_stop_at_any_step_leaves_the_table(spark, tmp_path, monkeypatch, step):
    path = str(tmp_path / "t")
    publish(frame(spark, (DAY0, 1)), path)
    new = frame(spark, (DAY0, 2))
    with monkeypatch.context() as m:
        if step == "data":
            new = new.withColumn("x", F.raise_error(F.lit("stop")).cast("int"))
        elif step == "names":
            m.setattr(Store, "names", lambda *a: (_ for _ in ()).throw(RuntimeError("stop")))
        else:
            whole = Store.put

            def put(self, name, text):
                if step == "rename":  # the draft is whole, but never gets its name
                    whole(self, f"drafts/stopped-{len(text)}", text)
                raise RuntimeError("stop")

            m.setattr(Store, "put", put)
        with pytest.raises(Exception, match="stop"):
            publish(new, path)
    assert content(spark, path) == [(str(DAY0), 1)]
    publish(frame(spark, (DAY0, 3)), path)
    expire(spark, path, keep=1)
    assert content(spark, path) == [(str(DAY0), 3)]


def test_two_writers_of_different_days_both_count(spark, tmp_path, monkeypatch):
    path, other = str(tmp_path / "t"), DAY0 + timedelta(days=1)
    publish(frame(spark, (DAY0, 1), (other, 1)), path)
    whole, came = Store.put, []

    def put(self, name, text):
        if not came:  # another writer is faster
            came.append(1)
            publish(frame(spark, (other, 2)), path, since=other)
        return whole(self, name, text)

    monkeypatch.setattr(Store, "put", put)
    publish(frame(spark, (DAY0, 5)), path, until=other)
    assert content(spark, path) == [(str(DAY0), 5), (str(other), 2)]


def reconciled(spark, rows):
    schema = "location_id string, date date, final_avg_temp double, avg_humidity double, avg_wind_speed double, season string"
    return spark.createDataFrame(rows, schema)


def make_rows(rng, n_days):
    """Stations with gaps of days, weeks and months, and days without an average."""
    rows = []
    for station, step in (("dense", 1), ("gaps", 3), ("rare", 31)):
        day = 0
        while day < n_days:
            temp = rng.randrange(-80, 160) / 4 if rng.random() > 0.15 else None
            rows.append((station, DAY0 + timedelta(days=day), temp, rng.randrange(100) / 4, rng.randrange(80) / 4, "winter"))
            day += rng.randint(1, 2 * step - 1)
    return rows


@pytest.mark.parametrize("since,until", [(110, None), (50, 53), (0, 5), (30, 90)])
def test_changed_days_equal_a_full_rebuild(spark, tmp_path, since, until):
    rng = random.Random(since)
    old, new = make_rows(rng, 112), make_rows(rng, 125)
    first = DAY0 + timedelta(days=since)
    last = DAY0 + timedelta(days=until) if until is not None else None
    changed = [r for r in new if r[1] >= first and (last is None or r[1] < last)]
    changed = changed[: len(changed) // 2 + 1]  # some days and stations go
    days, rolling = str(tmp_path / "days"), str(tmp_path / "rolling")
    publish(reconciled(spark, old), days)
    refresh_rolling(spark, days, rolling)
    before = {f: f for f in read_table(spark, rolling).inputFiles()}
    publish(reconciled(spark, changed), days, since=first, until=last)
    refresh_rolling(spark, days, rolling, first, last)
    got = read_table(spark, rolling)
    want = rolled_days(read_table(spark, days))
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    # Files of earlier days stay as they are.
    early = [f for f in before if f.split("event_date=")[1][:10] < str(first)]
    assert set(early) <= set(got.inputFiles())


def test_few_days_are_read_for_one_new_day(spark, tmp_path):
    rows = [
        (s, DAY0 + timedelta(days=i), float(i % 9), 1.0, 1.0, "fall") for s in "ab" for i in range(150)
    ]
    days = str(tmp_path / "days")
    publish(reconciled(spark, rows), days)
    since = DAY0 + timedelta(days=149)
    start = incremental.halo_start(spark, days, since, None, 29)
    assert since - start == timedelta(days=58)
    plan = read_table(spark, days, start)
    assert len({f.split("event_date=")[1][:10] for f in plan.inputFiles()}) == 59
    assert incremental.reach_end(spark, days, DAY0 + timedelta(days=40), 29) == DAY0 + timedelta(days=98)
    assert versions.stored_days(spark, days)[0] == str(DAY0)
