"""Registered queries: equal to their oracle, and planned the way they should be."""

import glob
import os
import re

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_module
from checks import oracle
from checks.compare import check, duck
from checks.queries import REGISTRY
from tests.conftest import SF

SINGLE_ROW_OR_TOP_N = {
    "adhoc_recent", "counts_as_of", "dq_severity", "freshness_stats", "latest_observation",
    "profile_report", "quality_current", "quality_daily", "quality_hourly", "quality_verdict",
    "table_stats", "warehouse_summary",
}


SQL = oracle.sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_contract(spark):
    assert set(REGISTRY) == set(SQL)
    assert set(REGISTRY) <= set(entry_module.queries())
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())
    assert entry_module.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query_equals_oracle_and_plan_is_sound(spark, con, name):
    df = REGISTRY[name](spark, SF)
    assert check(df, con, SQL[name]) is None
    plan = df._jdf.queryExecution().executedPlan().toString()
    for bad in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin", "ObjectHashAggregate"):
        assert bad not in plan
    if name not in SINGLE_ROW_OR_TOP_N:
        assert "SinglePartition" not in plan


@pytest.mark.parametrize("name", [n for n in sorted(REGISTRY) if "combined" in n])
@pytest.mark.parametrize("shift", [500_000, 5_400_000])
def test_combined_documents_of_large_keys(spark, tmp_path, name, shift):
    """Their epochs pass 32 bits; the last keys are also beyond the oracle's own 32-bit product."""
    customers = spark.read.parquet(f"{SF}/customer.parquet").limit(60)
    customers.withColumn("c_custkey", F.col("c_custkey") + shift).write.parquet(str(tmp_path / "customer.parquet"))
    got = REGISTRY[name](spark, str(tmp_path))
    con = duckdb.connect()
    wide = "* replace (cast(c_custkey as bigint) as c_custkey)"
    con.execute(f"create view customer as select {wide} from '{tmp_path}/customer.parquet/*.parquet'")
    if shift < 596_000:
        assert check(got, con, SQL[name]) is None
        return
    # k is an INTEGER in the oracle: the same rows with the seed as BIGINT.
    text = re.sub(r"\bk \* 3600\b", "cast(k as bigint) * 3600", SQL[name])
    assert check(got, con, text) is None


def test_scans_read_only_what_they_need(spark):
    def read_columns(name):
        plan = REGISTRY[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        return [set(m.split(",")) for m in re.findall(r"ReadSchema: struct<(.*?)>", plan)]

    (events,) = read_columns("freshness_stats")
    assert {c.split(":")[0] for c in events} == {"ts", "user_id"}
    plan = REGISTRY["unexpired_entries"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts" in plan
    assert plan.count("WindowGroupLimit") == 2
    trends = REGISTRY["weather_trends"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"Exchange hashpartitioning\(location_id#\d+, has_avg", trends)) == 1


def test_library_stays_on_executors():
    """No collecting, no Python functions over rows, no local checkpoints in the library."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    banned = re.compile(r"\.(collect|toPandas|toLocalIterator|rdd|localCheckpoint|crossJoin)\b|udf\(")
    for path in glob.glob(f"{root}/skyledger/**/*.py", recursive=True):
        if os.sep + "llm" + os.sep in path:
            continue
        with open(path) as f:
            assert not banned.search(f.read()), path
