import os
import sys
from datetime import datetime

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from skyledger.session import configure

    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield configure(session)
    session.stop()


@pytest.fixture
def documents(spark):
    """Frame of JSON bodies, numbered from 0, all arriving at one time."""
    import json

    def make(*bodies):
        rows = [
            (i, b if isinstance(b, str) else json.dumps(b), datetime(2024, 2, 1, 12))
            for i, b in enumerate(bodies)
        ]
        return spark.createDataFrame(rows, "doc_id INT, body STRING, ingested_at TIMESTAMP_NTZ")

    return make


def rows(df, *order):
    return [r.asDict() for r in (df.orderBy(*order) if order else df).collect()]
