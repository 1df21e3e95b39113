"""Compare registered queries with their oracle: ``python -m checks.compare SF_DIR [names…]``."""

from __future__ import annotations

import glob
import os
import sys
import time

import duckdb
import pandas as pd
from pyspark.sql import DataFrame, SparkSession

from checks import oracle
from checks.queries import REGISTRY


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"create view {name} as select * from '{path}'")
    return con


def canonical(df: pd.DataFrame) -> list[tuple]:
    """Rows as sorted tuples of texts, columns in name order."""
    df = df[sorted(df.columns)]
    columns = []
    for name in df.columns:
        c = df[name]
        if pd.api.types.is_float_dtype(c):
            columns.append(["" if pd.isna(x) else repr(float(x) + 0.0) for x in c])
        elif pd.api.types.is_datetime64_any_dtype(c):
            columns.append(["" if pd.isna(x) else pd.Timestamp(x).isoformat() for x in c])
        else:
            columns.append(["" if x is None or x is pd.NA or x != x else str(x) for x in c])
    return sorted(zip(*columns)) if columns else []


def check(df: DataFrame, con, text: str) -> str | None:
    """None if the frame equals the result of the SQL text, else what differs."""
    got = df.toArrow()
    want = con.sql(text).to_arrow_table()
    if sorted(got.column_names) != sorted(want.column_names):
        return f"columns {sorted(set(got.column_names) ^ set(want.column_names))}"
    types = [
        (c, str(got.schema.field(c).type), str(want.schema.field(c).type))
        for c in got.column_names
        if _family(str(got.schema.field(c).type)) != _family(str(want.schema.field(c).type))
    ]
    if types:
        return f"types {types}"
    a, b = (canonical(t.to_pandas(types_mapper=_nullable)) for t in (got, want))
    if a != b:
        extra, lacking = sorted(set(a) - set(b))[:2], sorted(set(b) - set(a))[:2]
        return f"rows {len(a)} / {len(b)}\n   got  {extra}\n   want {lacking}\n   {sorted(got.column_names)}"
    return None


def _family(t: str) -> str:
    if t.startswith("timestamp"):
        return "timestamp"
    return {"large_string": "string", "int8": "int32", "int16": "int32"}.get(t, t)


def _nullable(t):
    import pyarrow as pa

    return {pa.int32(): pd.Int32Dtype(), pa.int64(): pd.Int64Dtype()}.get(t)


def main() -> int:
    sf_dir, names = sys.argv[1], sys.argv[2:] or list(REGISTRY)
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = duck(sf_dir), 0
    sql = oracle.sql()
    for name in names:
        start = time.time()
        try:
            fault = check(REGISTRY[name](spark, sf_dir), con, sql[name])
        except Exception as e:  # report and go on to the next query
            fault = f"{type(e).__name__}: {str(e)[:600]}"
        bad += fault is not None
        rows = con.execute(f"select count(*) from ({sql[name]})").fetchall()[0][0] if not fault else ""
        print(f"{'ok ' if fault is None else 'BAD'} {name} {rows} {time.time() - start:.1f}s {fault or ''}", flush=True)
    print(f"{len(names) - bad} of {len(names)} equal")
    return bad


if __name__ == "__main__":
    sys.exit(main())
