import random

import pytest

from checks.compare import check, duck
from skyledger.llm import jaccard_join as J
from skyledger.llm import queries
from tests.conftest import SF
from tests.llm.common import frame, linked


def same(docs, rule):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in J.joined(docs, rule).collect()}
    wanted = linked(rows, rule.shingle, rule.percent)
    assert got == {rows[i][0]: v for i, v in wanted.items()}
    return got


def edited(rng, words, share):
    return [rng.choice("pqrstuv") * rng.randint(1, 9) if rng.random() < share else w for w in words]


def test_query_equals_sql(spark):
    assert check(J.op9_jaccard_join(spark, SF), duck(SF), queries.SQL["op9_jaccard_join"]) is None


@pytest.mark.parametrize("cell", [6, 512])
def test_copies_chains_and_shared_passages(spark, monkeypatch, cell):
    monkeypatch.setattr(J, "CELL", cell)
    rng = random.Random(cell)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7)))
    base, passage = [word() for _ in range(120)], [word() for _ in range(60)]
    texts = [" ".join(edited(rng, base, rng.choice([0, 0.01, 0.02, 0.04]))) for _ in range(60)]
    texts += [" ".join([word() for _ in range(40)] + passage) for _ in range(25)]
    chain = list(base)
    for _ in range(12):  # each differs a little from the one before
        chain[rng.randrange(len(chain))] = word()
        texts.append(" ".join(chain).upper())
    texts += ["one two", "One TWO", "one", "", " ", "\t"] + [" ".join(passage)] * 3
    rng.shuffle(texts)
    got = same(frame(spark, *texts), J.Rule())
    assert 20 < len({c for _, c in got.values()}) < len(texts)


def test_other_sizes_and_shares(spark):
    same(spark.read.parquet(f"{SF}/documents.parquet"), J.Rule(5, 80))


def test_bits_never_exceed_the_symmetric_difference():
    import numpy as np

    rng = np.random.default_rng(3)
    for _ in range(200):
        pool = rng.integers(0, 1 << 63, 400, dtype=np.uint64)
        a, b = (np.unique(rng.choice(pool, rng.integers(1, 300))) for _ in range(2))
        p, q = sorted((np.frombuffer(J.bits(s), np.uint8) for s in (a, b)), key=len)
        assert J.differing(p, J.folded(q, len(p))) <= len(np.setxor1d(a, b))


def test_edges(spark):
    schema = frame(spark, "").schema
    text = "a b c d e f g h i j k l m n o p"
    rows = [
        (5, text, "en", "s", 1), (5, text, "en", "s", 1), (9, text, None, None, None), (None, text, "en", "s", 1),
        (None, "no other row has this text at all", "en", "s", 1), (2, None, "en", "s", 1), (1, "", "en", "s", 1),
        (7, "word " * 50_000, "en", "s", 1),
    ]
    docs = spark.createDataFrame(rows, schema).withColumnsRenamed({"source": "node", "lang": "component_id"})
    got = [(r.doc_id, r.n_shingles, r.component_id) for r in J.joined(docs).collect()]
    assert sorted(got, key=str) == sorted(
        [(5, 13, 5), (5, 13, 5), (9, 13, 5), (None, 13, 5), (None, 5, None), (2, 0, 2), (1, 0, 1), (7, 1, 7)], key=str
    )
    assert J.joined(docs.limit(0)).count() == 0


def test_texts_of_one_id_are_one_component(spark):
    rng = random.Random(5)
    first, second, third = (" ".join(rng.choice("abcdefgh") * rng.randint(1, 9) for _ in range(30)) for _ in range(3))
    rows = [(5, first), (9, first), (9, second), (9, second), (7, second), (3, third), (7, ""), (4, "other words of " + third)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in J.joined(docs).collect())
    assert [(i, c) for i, n, c in got if n] == [(3, 3), (4, 3), (5, 5), (7, 5), (9, 5), (9, 5), (9, 5)]
    assert [(i, c) for i, n, c in got if not n] == [(7, 7)]


def test_labels_settle_over_long_chains(spark):
    n = 300  # a chain in no order of its numbers
    order = random.Random(1).sample(range(n), n)
    links = spark.createDataFrame([tuple(sorted(p)) for p in zip(order, order[1:])], "a long, b long")
    assert {r.label for r in J.components(links).collect()} == {0}
