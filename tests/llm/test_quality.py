import zlib

from pyspark.sql import functions as F

from skyledger.llm import quality_classifier as Q
from tests.conftest import SF
from tests.llm.common import frame


def test_held_out_accuracy(spark):
    sf = SF.replace("0.001", "0.01")
    out = Q.op2_quality_classifier(spark, sf)
    assert out.columns[:4] == ["doc_id", "held_out", "score", "predicted"]
    judged = out.join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").collect()
    for r in judged:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7)
    held = [r for r in judged if r.held_out]
    assert sum(r.predicted == r.quality for r in held) >= 0.95 * len(held)
    assert out.count() == spark.read.parquet(f"{sf}/documents.parquet").count()


def test_edges(spark):
    docs = frame(spark, None, "", "plain words here", "x" * 300_000, "BAD!! BAD!! BAD!!", "BAD!! BAD!! BAD!!")
    docs = docs.withColumn("quality_score", F.lit("clash"))
    labels = spark.createDataFrame(
        [(2, 1), (3, 1), (4, 0), (5, 0), (5, None), (None, 1), (77, 1)], "doc_id long, quality int"
    )
    rows = Q.score(docs, Q.train(docs, labels)).orderBy("doc_id").collect()
    assert len(rows) == 6
    assert rows[0].quality_score == rows[1].quality_score
    assert rows[4].quality_score == rows[5].quality_score
    assert Q.score(docs.limit(0), Q.train(docs.limit(0), labels)).count() == 0
    untaught = Q.score(docs, Q.train(docs, labels.limit(0))).select("quality_score").distinct().collect()
    assert [r[0] for r in untaught] == [0.5]


def test_held_out_labels_do_not_train(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    flipped = labels.withColumn("quality", F.when(Q.fold("doc_id") == 2, 1 - F.col("quality")).otherwise(F.col("quality")))
    assert (Q.train(docs, labels) == Q.train(docs, flipped)).all()
