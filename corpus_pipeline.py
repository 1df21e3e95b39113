"""Training corpus: documents that pass the quality classifier, once each, without benchmark items and
without personal data, as token digests.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of
``docs``. ``run`` writes each stage's rows to the shared checkpoint folder and reads them for the next.

Edge cases: a NULL text is judged as the empty one and stays NULL. Documents without an id are not
compared with others and stay; rows that repeat an id and its text become one. Where no label can be
learnt from, the classifier rejects nothing. An empty table passes through. Extra columns are carried,
except that a column named like a stage's own working column has that stage's value.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.llm import byte_pairs, jaccard_join, personal_data, quality_classifier
from skyledger.llm.decontaminate import decontaminated
from skyledger.llm.store import staged

#: Near duplicates of the pipeline share four fifths of their five-word shingles.
NEAR = jaccard_join.Rule(shingle=5, percent=80)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the classifier does not reject."""
    weights = quality_classifier.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    if not weights.any():
        return docs
    scored = quality_classifier.score(docs, weights)
    return scored.filter(F.col("quality_score") >= quality_classifier.THRESHOLD).select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each component of near duplicates."""
    first = F.col("doc_id") == F.col("component_id")
    ids = jaccard_join.joined(docs, NEAR).groupBy("doc_id").agg(F.min(first).alias("first"))
    others = staged(ids.filter(~F.col("first")).select(F.col("doc_id").alias("other_id")), "duplicates")
    kept = docs.join(others, F.col("doc_id") == F.col("other_id"), "left_anti")
    return kept.dropDuplicates(["doc_id", "text"]).select(docs.columns)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def personal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, each span of personal data replaced by its kind; n_chars follows the text."""
    found = personal_data.with_spans(docs, personal_data.train(docs))
    hit = F.size("pii_spans") > 0
    new = {"text": F.when(hit, F.col("pii_text")).otherwise(F.col("text"))}
    if "n_chars" in docs.columns:
        length = F.length("pii_text").cast(docs.schema["n_chars"].dataType)
        new["n_chars"] = F.when(hit, length).otherwise(F.col("n_chars"))
    return found.withColumns(new).select(docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token number and digests of each document's ids and decoded text."""
    return byte_pairs.digests(docs, "doc_id")


STAGES = [
    ("quality classifier", quality),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", benchmark),
    ("personal data", personal),
    ("BPE encoding and decoding", tokens),
]

#: No stage but the last could be said in SQL; tests hold ``run`` against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the last stage over the whole ``documents`` table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
