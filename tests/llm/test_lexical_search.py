import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from skyledger.llm import lexical_search as L
from tests.conftest import SF
from tests.llm.common import frame, lower

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def plain(docs, items, k=10):
    """{item row: [(doc_id, score)]} by scoring every document."""
    terms = [TERM.findall(lower(t)) for _, t in docs]
    n_docs, n_terms = sum(map(bool, terms)), sum(map(len, terms))
    df = Counter(t for own in terms for t in set(own))
    counts = [Counter(own) for own in terms]
    out = []
    for item_id, text in items:
        scored = []
        for (doc_id, _), own, tf in zip(docs, terms, counts, strict=True):
            score = 0
            for t in TERM.findall(lower(text)):
                if tf[t]:
                    m = 100 - 75 + (75 * len(own) * n_docs) // n_terms
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    score += w * ((1000000000 * tf[t]) // (1000 * tf[t] + 8 * m))
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0, doc_id))
        best = sorted(scored)[:k]
        out += [(item_id, i + 1, d, -s) for i, (s, _, _, d) in enumerate(best)]
    return sorted(out, key=repr)


def result(docs, items, **kw):
    out = L.search(docs, items, **kw)
    assert out.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted((tuple(r) for r in out.collect()), key=repr)


def test_query_equals_scoring_all(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    got = sorted((tuple(r) for r in L.op11_lexical_search(spark, SF).collect()), key=repr)
    assert got == plain(docs, items) and got


@pytest.mark.parametrize("segment", [1, 7, 1 << 15])
def test_ties_odd_texts_and_blocks(spark, monkeypatch, segment):
    rng = random.Random(segment)
    words = ["a", "A", "b2", "Élan", "élan", "über", "x-y", "ß", "日本", "z", "\x00", "zz_z", "\x7f", "̈n"]
    texts = [" ".join(rng.choices(words, weights=range(14, 0, -1), k=rng.randint(0, 12))) for _ in range(150)]
    texts += [None, "", " .,", "a " * 60_000, *["tied words here"] * 14]
    docs = frame(spark, *texts).withColumn("score", F.lit("clash")).withColumn("item_id", F.lit("clash"))
    docs = docs.withColumn("doc_id", F.when(F.col("doc_id") % 40 != 5, F.col("doc_id")))
    docs = docs.unionByName(docs.filter("doc_id between 20 and 23"))
    asked = [(i, " ".join(rng.choices(words, k=rng.randint(1, 8)))) for i in range(25)]
    asked += [(30, "tied here tied"), (30, "A a"), (None, "ß"), (31, None), (32, ""), (33, "!!"), (34, "unheard")]
    items = spark.createDataFrame(asked, "item_id long, text string").withColumn("rank", F.lit("clash"))
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    monkeypatch.setattr(L, "SEGMENT_DOCS", segment)
    want = plain(rows, asked)
    assert result(docs, items) == want
    assert result(docs, items, block_bytes=200) == want
    assert result(docs, items, k=3) == plain(rows, asked, 3)


def test_no_documents_or_items(spark):
    docs = frame(spark, "a b", "b c")
    items = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert result(docs.limit(0), items) == []
    assert result(docs, items.limit(0)) == []
    assert result(frame(spark, None, ""), items) == []


def test_reading_stops_before_the_end_and_loses_nothing():
    rng = np.random.default_rng(6)
    n = 20_000
    doc = np.concatenate([rng.permutation(n), rng.permutation(n)[:9000], rng.permutation(n)[:40]])
    term = np.repeat([0, 1, 2], [n, 9000, 40])
    impact = np.concatenate([rng.integers(1, 50, n), rng.integers(1, 4000, 9000), rng.integers(5000, 9000, 40)])
    lists = L.Lists(term, doc, impact, n, 3)
    score = np.bincount(doc, impact * np.array([1, 2, 1])[term], n)
    own, times = np.arange(3), np.array([1, 2, 1])
    docs, scores, read = L.best_positions(lists, own, times, 10, 0)
    best = np.lexsort((np.arange(n), -score))[:10]
    assert set(best) <= set(docs.tolist())
    assert dict(zip(docs.tolist(), scores.tolist(), strict=True)).items() <= dict(enumerate(score)).items()
    assert read < len(doc) / 5
    assert len(L.best_positions(lists, own, times, 10, 10**6)[0]) == 0
