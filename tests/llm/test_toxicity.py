import itertools
import random
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from skyledger.llm import toxicity as X
from skyledger.llm import words as W
from tests.conftest import SF
from tests.llm.common import WORD, frame, lower


def part_of(*texts):
    (part,) = W.slices(pa.array(texts, pa.string()))
    return part


def test_terms_equal_plain_sets():
    texts = ["Ab abcd  ABCDefgh", "", "éàü ßßßßß", "one one one", "x" * 40]
    row, slot = X.terms(part_of(*texts))
    for i, text in enumerate(texts):
        w = WORD.findall(lower(text))
        plain = {("w", x) for x in w} | {("p", *x) for x in zip(w, w[1:], strict=False)}
        for x in (x.encode() for x in w):
            plain |= {(k, x[j : j + k]) for k in X.RUNS for j in range(len(x) - k + 1)}
        assert (row == i).sum() == len(plain)
    assert (row == 1).sum() == 0


def test_score_equals_the_sum_over_pairs():
    rng = np.random.default_rng(3)
    model = X.Machine(np.arange(30), rng.normal(size=30), rng.normal(size=(30, X.FACTORS)), 0.3)
    rows = [sorted(rng.choice(30, n, replace=False)) for n in (0, 1, 2, 9, 30)]
    row = np.repeat(np.arange(5), [len(r) for r in rows])
    got = model.score(row, np.array([i for r in rows for i in r], np.int64), 5)
    for r, score in zip(rows, got, strict=True):
        x = max(len(r), 1) ** -0.25
        z = 0.3 + sum(model.weights[i] * x for i in r)
        z += sum(model.factors[i] @ model.factors[j] * x * x for i, j in itertools.combinations(r, 2))
        assert abs(score - 1 / (1 + np.exp(-z))) < 1e-9


def test_learns_what_weights_alone_cannot(monkeypatch):
    # Insult alone and group alone are clean, both together or neither of them ... the label is the pair.
    rng = random.Random(4)
    slots, label = [], []
    for _ in range(1200):
        a, b = rng.random() < 0.5, rng.random() < 0.5
        slots.append(np.array(sorted({0} & {0 if a else 9} | {1 if b else 9} | {rng.randrange(20, 60)})))
        label.append(int(a == b))
    monkeypatch.setattr(X, "LEAST_CHI", 0.0)
    model = X.fit(slots, np.array(label), epochs=40)
    number = model.numbers()
    own = [number[s] for s in slots]
    row = np.repeat(np.arange(len(own)), [len(o) for o in own])
    right = (model.score(row, np.concatenate(own), len(own)) >= 0.5) == np.array(label, bool)
    assert right.mean() > 0.95
    model.factors[:] = 0
    alone = (model.score(row, np.concatenate(own), len(own)) >= 0.5) == np.array(label, bool)
    assert alone.mean() < 0.8


def test_held_out_accuracy(spark):
    sf = SF.replace("0.001", "0.1")
    out = X.op13_toxicity(spark, sf)
    assert out.columns[:4] == ["doc_id", "held_out", "score", "predicted"]
    judged = out.join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").collect()
    for r in judged:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5)
    toxic = [r.predicted for r in judged if r.held_out and r.toxic]
    clean = [r.predicted for r in judged if r.held_out and not r.toxic]
    assert sum(toxic) >= 0.85 * len(toxic) and sum(clean) <= 0.01 * len(clean)
    assert out.count() == spark.read.parquet(f"{sf}/documents.parquet").count()


def test_edges(spark):
    docs = frame(spark, None, "", "plain words here", "x y " * 100_000, "you idiot", "you idiot", "ba\u0000d")
    docs = docs.withColumn("toxicity", F.lit("clash"))
    labels = spark.createDataFrame(
        [(2, 0), (3, 0), (4, 1), (6, 1), (6, None), (None, 1), (77, 1), (2, 7)], "doc_id long, toxic int"
    )
    rows = X.score(docs, X.train(docs, labels)).orderBy("doc_id").collect()
    assert len(rows) == 7
    assert rows[0].toxicity == rows[1].toxicity
    assert rows[4].toxicity == rows[5].toxicity
    assert X.score(docs.limit(0), X.train(docs.limit(0), labels)).count() == 0
    for few in (labels.limit(0), labels.filter("toxic = 1")):
        assert {r.toxicity for r in X.score(docs, X.train(docs, few)).collect()} == {0.5}


def test_held_out_labels_do_not_train(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    flipped = labels.withColumn("toxic", F.when(X.fold("doc_id") == 0, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    one, other = X.train(docs, labels), X.train(docs, flipped)
    assert (one.slots == other.slots).all() and (one.factors == other.factors).all()
