"""Range join, as-of join and ordered windows against plain Python."""

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from skyledger.operators import ordered, regions
from skyledger.operators.asof import entry_at
from skyledger.operators.regions import GRIDS, box_cells, coverage_join, unrolled
from skyledger.operators.trend import rolling


def test_range_join_equals_comparing_all_pairs(spark):
    rng = random.Random(1)
    eighth = lambda a, b: rng.randrange(a * 8, b * 8 + 1) / 8
    points = [(i, eighth(-90, 90), eighth(-180, 180), "p") for i in range(300)]
    points += [(900, None, 5.0, "p"), (901, 5.0, None, "p"), (902, 10.0, 180.0, "p"), (903, 10.0, -180.0, "p")]
    points += [(0, *points[0][1:3], "p")]
    boxes = []
    for i in range(150):
        s, w = eighth(-90, 80), eighth(-180, 179)
        tall, wide = rng.choice([(0.0, 0.0), (0.125, 0.25), (3.0, 5.0), (60.0, 100.0), (180.0, 360.0)])
        e = w + wide
        boxes.append((i, s, s + tall, w, e - 360 if 180 < e < 540 - 1 and e - 360 < w else min(e, 180.0), "r"))
    boxes += [(900, None, 1.0, 0.0, 1.0, "r"), (901, 2.0, 1.0, 0.0, 1.0, "r"), (902, -90.0, 90.0, -180.0, 180.0, "r")]
    want = sorted(
        (p, r)
        for p, lat, lon, _ in points
        for r, s, n, w, e, _ in boxes
        if None not in (lat, lon, s) and s <= lat <= n and (w <= lon <= e if w <= e else lon >= w or lon <= e)
    )
    p = spark.createDataFrame(points, "point_id int, lat double, lon double, name string")
    r = spark.createDataFrame(boxes, "region_id int, south double, north double, west double, east double, label string")
    for grids in (GRIDS, (1.0,), (0.5, 90.0)):
        out = coverage_join(p, r, grids=grids)
        assert out.columns == ["point_id", "lat", "lon", "name", "region_id", "label"]
        if grids == GRIDS:
            plan = out._jdf.queryExecution().executedPlan().toString()
            assert "NestedLoop" not in plan and "Cartesian" not in plan
            assert box_cells(unrolled(r)).groupBy("region_id").count().agg(F.max("count")).first()[0] <= 2 * 72
        assert sorted((x.point_id, x.region_id) for x in out.collect()) == want
    assert coverage_join(p.limit(0), r).count() == 0 == coverage_join(p, r.limit(0)).count()


def test_range_join_with_clashing_columns(spark):
    p = spark.createDataFrame([(1, 1.0, 1.0, 7)], "id int, lat double, lon double, grid int")
    r = spark.createDataFrame([("a", 0.0, 2.0, 0.0, 2.0, 8)], "code string, south double, north double, west double, east double, x int")
    assert [tuple(t) for t in coverage_join(p, r).collect()] == [(1, 1.0, 1.0, 7, "a", 8)]


@pytest.mark.parametrize("ttl", [60, 3600, 86400])
def test_entry_at_equals_looking_back(spark, ttl):
    rng = random.Random(ttl)
    start = datetime(2024, 1, 1)
    moment = lambda: start + timedelta(seconds=rng.randrange(0, 40 * 60) * 60)
    key = lambda: rng.choice(["hot"] * 6 + ["a", "b", None])
    readings = [(i, key(), moment() if rng.random() > 0.03 else None) for i in range(400)]
    entries = [(key(), moment() if rng.random() > 0.03 else None, i) for i in range(150)]
    entries += [("hot", start, 900), ("hot", start, 901)]
    readings += [(900, "hot", start), (901, "hot", start + timedelta(seconds=ttl)), (902, "hot", start - timedelta(seconds=1))]
    want = {}
    for i, k, t in readings:
        fit = [(c, v) for e, c, v in entries if None not in (t, k, c) and e == k and c <= t and (t - c).total_seconds() <= ttl]
        want[i] = max(fit, default=None)
    r = spark.createDataFrame(readings, "id int, station string, at timestamp_ntz")
    e = spark.createDataFrame(entries, "station string, cached_at timestamp_ntz, value int")
    out = entry_at(r, e, ["station"], "at", "cached_at", ttl, ["value"]).collect()
    assert {x.id: (x.entry.cached_at, x.entry.value) if x.entry else None for x in out} == want
    assert len(out) == len(readings)
    assert entry_at(r, e.limit(0), ["station"], "at", "cached_at", ttl).filter("entry is null").count() == len(readings)


def site_days(spark):
    rng = random.Random(3)
    rows = []
    for i in range(900):
        d = date(1994, 1, 1) + timedelta(days=rng.choice([i, i, i * 7, -40_000 if i == 3 else i]))
        rows.append((None if i % 211 == 0 else d, i, rng.choice(["winter", "fall", None]), rng.randrange(-40, 40) / 4 if i % 50 else None))
    return spark.createDataFrame(rows, "date date, seq int, season string, temp double")


def test_windows_without_a_key_equal_the_plain_form(spark):
    days = site_days(spark)
    order = [F.asc_nulls_last("date"), F.asc("seq")]
    measures = {"avg7": F.avg("temp"), "n30": F.count("*"), "first": F.first("seq")}
    chunk = ordered.day_chunk("date")
    for rows, block in ((7, 16), (30, 30), (1, 5), (900, 900)):
        w = Window.orderBy(*order).rowsBetween(1 - rows, 0)
        want = days.withColumns({k: c.over(w) for k, c in measures.items()})
        got = ordered.last_rows_measures(days, rows, measures, chunk, order, block_rows=block)
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "SinglePartition" not in plan
        assert got.columns == want.columns
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    got = ordered.numbered(days, chunk, order).orderBy("row_no").select("row_no", "seq").collect()
    assert [r.row_no for r in got] == list(range(1, 901))
    assert ordered.numbered(days.limit(0), chunk, order).count() == 0


def test_ranks_without_a_key_equal_the_plain_form(spark):
    days = site_days(spark).union(spark.createDataFrame([(None, 1000, "fall", float("nan"))] * 2, site_days(spark).schema))
    for by in ([], ["season"]):
        want = days.withColumn("r", F.rank().over(Window.partitionBy(*by).orderBy(F.desc("temp"))))
        got = ordered.ranked(days, ordered.value_chunk("temp", 0.5, descending=True), [F.desc("temp")], "r", by)
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
        up = days.withColumn("r", F.rank().over(Window.partitionBy(*by).orderBy(F.asc_nulls_last("temp"))))
        got = ordered.ranked(days, ordered.value_chunk("temp", 0.5), [F.asc_nulls_last("temp")], "r", by)
        assert sorted(map(str, got.collect())) == sorted(map(str, up.collect()))


def test_a_hot_key_is_spread_too(spark):
    days = site_days(spark).withColumn("location_id", F.when(F.col("seq") % 3 > 0, "hot").otherwise("a"))
    days = days.filter("date is not null").dropDuplicates(["location_id", "date"])
    want = rolling(days, 7, {"m": F.avg("temp")})
    got = ordered.last_rows_measures(
        days, 7, {"m": F.avg("temp")}, ordered.day_chunk("date"), [F.asc("date")], ["location_id"], block_rows=50
    )
    assert sorted(map(str, got.select(want.columns).collect())) == sorted(map(str, want.collect()))


def test_range_join_cuts_full_cells_into_blocks(spark, monkeypatch):
    """Boxes and points of one cell are compared in many tasks, each pair once."""
    monkeypatch.setattr(regions, "BLOCK", 50)
    points = spark.range(1000).selectExpr("id as point_id", "5 + id % 10 as lat", "5.0 as lon")
    boxes = spark.range(300).selectExpr("id as region_id", "0.0 as south", "id % 20 as north", "-90.0 as west", "90.0 as east")
    out = coverage_join(points, boxes)
    want = sum(5 + p % 10 <= r % 20 for p in range(1000) for r in range(300))
    assert out.count() == want == out.distinct().count()
    sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) > 2 and max(sizes) < want / 2


def joined_rows(df):
    """Runs ``df`` and returns how many rows were shuffled for each side of its merge join."""
    execution = df._jdf.queryExecution()
    execution.toRdd().count()

    def nodes(node):
        below = node.children()
        inner = {"AdaptiveSparkPlan": "executedPlan", "ResultQueryStage": "plan", "ShuffleQueryStage": "plan"}.get(node.nodeName())
        for x in [below.apply(i) for i in range(below.size())] + ([getattr(node, inner)()] if inner else []):
            yield from nodes(x)
        yield node

    (join,) = (x for x in nodes(execution.executedPlan()) if x.nodeName() == "SortMergeJoin")
    sides = ([x for x in nodes(join.children().apply(i)) if x.nodeName() == "Exchange"][-1] for i in (0, 1))
    return [side.metrics().get("shuffleRecordsWritten").get().value() for side in sides]


def test_range_join_lists_points_once(spark):
    """A point goes to one cell, whatever the sizes of the boxes, and to none that no box meets."""
    points = spark.range(4000).selectExpr("id as point_id", "id * 37 % 401 / 8 as lat", "id * 53 % 401 / 8 as lon")
    sizes = "array(struct(0.375 as h, 1.5 as w), struct(3.0 as h, 4.0 as w), struct(40.0 as h, 45.0 as w))"
    boxes = spark.range(300).selectExpr("id as region_id", "id % 5 as south", "id % 7 as west", f"{sizes}[id % 3] as size")
    boxes = boxes.selectExpr("region_id", "cast(south as double)", "south + size.h as north", "cast(west as double)", "west + size.w as east")
    pairs = "lat between south and north and lon between west and east"
    want = sorted(map(tuple, points.join(boxes, F.expr(pairs)).select("point_id", "region_id").collect()))
    out = coverage_join(points, boxes)
    assert sorted((x.point_id, x.region_id) for x in out.collect()) == want
    at, listed = joined_rows(out)
    assert at <= 4000 and listed <= 3 * 300
    at, listed = joined_rows(coverage_join(points.withColumn("lon", F.col("lon") - F.col("point_id") % 2 * 120), boxes))
    assert at <= 2000 and listed <= 3 * 300


def test_range_join_beyond_the_globe(spark):
    """Edges and points out of range are compared like others and make no more cells."""
    nan, far = float("nan"), 1e9
    points = [(0, 95.0, 0.0), (1, -far, far), (2, 10.0, 200.0), (3, nan, 5.0), (4, 50.0, 5.0), (5, far, -180.5)]
    boxes = [(0, -far, far, -far, far), (1, 90.0, 100.0, -1.0, 1.0), (2, 40.0, nan, 0.0, 10.0), (3, 0.0, 20.0, 190.0, 210.0)]
    p = spark.createDataFrame(points, "point_id int, lat double, lon double")
    r = spark.createDataFrame(boxes, "region_id int, south double, north double, west double, east double")
    assert box_cells(r).groupBy("region_id").count().agg(F.max("count")).first()[0] <= 72
    got = sorted((x.point_id, x.region_id) for x in coverage_join(p, r).collect())
    assert got == [(0, 0), (0, 1), (0, 2), (1, 0), (2, 0), (2, 3), (3, 2), (4, 0), (4, 2), (5, 0)]
