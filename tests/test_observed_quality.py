"""Quality figures taken while rows are written, against scans of the raw tables."""

import json
from datetime import datetime

from skyledger.plans.batch import check_quality, ingest, quality_of_ingests


def docs(spark, *bodies):
    rows = [(f"s{i % 2}", datetime(2024, 2, 1, 12), json.dumps(b)) for i, b in enumerate(bodies)]
    return spark.createDataFrame(rows, "location_id string, ingested_at timestamp_ntz, body string")


def seen(i, **more):
    return {"properties": {"timestamp": f"2024-01-{i % 28 + 1:02d}T09:00:00Z", "temperature": {"value": float(i)}, **more}}


def forecast(n, day=True):
    return {
        "properties": {
            "periods": [
                {"startTime": f"2024-01-{i % 28 + 1:02d}T{6 if day else i % 24:02d}:00:00Z", "isDaytime": True,
                 "temperature": 40 + i, "probabilityOfPrecipitation": {"value": i % 100}}
                for i in range(n)
            ]
        }
    }


def same(spark, root):
    scanned, stored = check_quality(spark, root), quality_of_ingests(spark, root)
    for name in ("report", "verdict"):
        want, got = scanned[name], stored[name].select(scanned[name].columns)
        assert [f.dataType for f in got.schema] == [f.dataType for f in want.schema]
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    return stored


def test_figures_of_batches_equal_scans(spark, tmp_path):
    root = str(tmp_path)
    ingest(docs(spark, *[seen(i) for i in range(9)], {"properties": {}}), "current", root, batch="a")
    ingest(docs(spark, forecast(5, day=False)), "hourly", root, batch="a")
    ingest(docs(spark, forecast(2)), "daily", root, batch="a")
    assert not same(spark, root)["verdict"].first().quality_passed
    # A batch that runs again counts once; further batches add up.
    for _ in range(2):
        ingest(docs(spark, *[seen(i, relativeHumidity={"value": 50}) for i in range(20)]), "current", root, batch="b")
        ingest(docs(spark, forecast(20, day=False), forecast(3, day=False)), "hourly", root, batch="b")
        ingest(docs(spark, forecast(6)), "daily", root, batch="b")
    verdict = same(spark, root)["verdict"].first()
    assert (verdict.current_rows, verdict.hourly_rows, verdict.daily_rows) == (29, 28, 8)
    # A batch without rows stores zeros.
    ingest(docs(spark, {"properties": {}}), "current", root, batch="c")
    assert same(spark, root)["verdict"].first() == verdict
    plan = quality_of_ingests(spark, root)["verdict"]
    assert all("/quality/metrics/" in f for f in plan.inputFiles())
