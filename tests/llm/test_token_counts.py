import random

from skyledger.llm import token_counts as T
from tests.conftest import SF
from tests.llm.common import frame


def greedy(word, pieces, longest):
    n = i = 0
    while i < len(word):
        j = min(len(word), i + longest)
        while word[i:j] not in pieces:
            j -= 1
            if j == i:
                return -1
        n, i = n + 1, j
    return n


def test_small_vocabularies_equal_greedy_cutting():
    rng = random.Random(4)
    for _ in range(300):
        pieces = {bytes(rng.choice(b"abc") for _ in range(rng.randint(1, 5))) for _ in range(rng.randint(1, 9))}
        own = T.Automaton(sorted(pieces))
        for _ in range(30):
            word = bytes(rng.choice(b"abc") for _ in range(rng.randint(0, 12)))
            assert own.count(word) == greedy(word, pieces, 5), (pieces, word)


def test_query_equals_greedy_cutting(spark):
    with open(T.VOCABULARY, encoding="utf-8") as f:
        pieces = set(T.pieces(f.read()))
    longest = max(map(len, pieces))
    got = {r.doc_id: r for r in T.op6_token_counts(spark, SF).collect()}
    texts = spark.read.parquet(f"{SF}/documents.parquet").collect()
    assert len(got) == len(texts)
    for d in texts[:40]:
        words = T.WORD.findall(d.text.lower())
        assert got[d.doc_id].n_words == len(words)
        assert got[d.doc_id].n_pieces == sum(greedy(w.encode(), pieces, longest) for w in words)


def test_edges(spark):
    docs = frame(spark, None, "", " \n", "a" * 200_000, "é 中", "é 中").withColumnRenamed("source", "n_pieces")
    rows = T.with_counts(docs).orderBy("doc_id").collect()
    assert [r.n_words for r in rows] == [0, 0, 0, 1, 2, 2]
    assert rows[3].n_pieces > 1000 and rows[4].n_pieces == rows[5].n_pieces
    assert T.with_counts(docs.limit(0)).count() == 0
