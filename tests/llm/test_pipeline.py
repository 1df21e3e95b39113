import hashlib

import numpy as np
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__
import corpus_pipeline
from skyledger.llm import byte_pairs, personal_data, queries
from skyledger.llm.store import staged
from tests.conftest import SF
from tests.llm.common import DOCS, linked


def test_registration():
    names = __spark_entry__.queries()
    assert names["pipeline"] is corpus_pipeline.run
    assert {f"op{n}" for n in range(1, 11)} == {k.split("_")[0] for k in queries.REGISTRY}
    assert set(queries.SQL) <= set(queries.REGISTRY) and set(queries.REGISTRY) <= set(names)
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality classifier", "n-gram Jaccard join", "benchmark decontamination", "personal data",
        "BPE encoding and decoding",
    ]


def test_each_stage_equals_a_plain_version(spark):
    stages = dict(corpus_pipeline.STAGES)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = staged(stages["quality classifier"](spark, docs, SF), "t")
    assert kept.columns == docs.columns and kept.schema == docs.schema
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    own = {r.doc_id for r in kept.collect()}
    clean = [i for i, q in labels.items() if q == 1]
    junk = [i for i, q in labels.items() if q == 0]
    assert sum(i in own for i in clean) >= 0.95 * len(clean) and sum(i in own for i in junk) <= 0.2 * len(junk)

    rows = [(r.doc_id, r.text) for r in kept.collect()]
    once = staged(stages["n-gram Jaccard join"](spark, kept, SF), "t")
    first = {rows[i][0] for i, (_, c) in linked(rows, 5, 80).items() if rows[i][0] == c or not rows[i][1].split()}
    assert {r.doc_id for r in once.collect()} == first and once.columns == docs.columns

    clear = staged(stages["benchmark decontamination"](spark, once, SF), "t")
    passages = [" ".join(r.text.split()) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    wanted = {r.doc_id for r in once.collect() if not any(p in " ".join(r.text.split()) for p in passages)}
    assert {r.doc_id for r in clear.collect()} == wanted and clear.columns == docs.columns

    masked = staged(stages["personal data"](spark, clear, SF), "t")
    before = {r.doc_id: r for r in clear.collect()}
    for r in masked.collect():
        assert not personal_data.base_spans(r.text) and r.n_chars == len(r.text)
        if not any(c in before[r.doc_id].text for c in "0123456789@"):
            assert r == before[r.doc_id]
    assert masked.count() == len(before)

    library = Tokenizer.from_file(byte_pairs.VOCABULARY)
    texts = {r.doc_id: r.text for r in masked.collect()}
    last = stages["BPE encoding and decoding"](spark, masked, SF).collect()
    assert {r.doc_id for r in last} == set(texts)
    for r in last:
        ids = library.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest())
    whole = {tuple(r) for r in corpus_pipeline.run(spark, SF).collect()}
    assert whole == {tuple(r) for r in last}


def test_edges(spark):
    good = "Is and retitioning the words of that text with mail a@b.co and some more of them in the end"
    rows = [
        (1, good, "en", "s", 3), (1, good, "en", "s", 3), (2, None, None, None, None), (None, good + " x", "en", "s", 1),
        (3, "", "en", "s", 0), (4, good, "en", "s", 3), (5, "word " * 60_000, "en", "s", 9),
    ]
    docs = spark.createDataFrame(rows, DOCS).withColumn("label_is", F.lit(1))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns
        assert stage(spark, docs.limit(0), SF).count() == 0
        ids = sorted((r.doc_id is None, r.doc_id or 0) for r in out.collect())
        if name == "n-gram Jaccard join":
            assert ids == [(False, 1), (False, 2), (False, 3), (False, 5), (True, 0)]
        elif name == "personal data":
            texts = {r.text for r in out.collect()}
            assert good.replace("a@b.co", "[EMAIL]") in texts and None in texts
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() == len(rows)
