import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from skyledger.llm import alignment as A
from skyledger.llm.store import staged
from tests.conftest import SF
from tests.llm.common import frame


@pytest.fixture(scope="module")
def pair():
    with open(A.BYTE_VOCABULARY, encoding="utf-8") as f, open(A.PIECE_VOCABULARY, "rb") as g:
        return A.Pair(f.read(), g.read())


def plain_tokens(pair, text):
    """Ids of both tokenizers with their byte ranges, one text at a time."""
    if not text:
        return [], []
    out = []
    letters = {v: k for k, v in A.byte_letters().items()}
    for kind in "ab":
        if kind == "a":
            ids = pair.a.encode(" " + text, add_special_tokens=False).ids
            back = {c: b for b, c in letters.items()}
            parts = [bytes(back[c] for c in pair.a.id_to_token(i)) for i in ids]
        else:
            ids = pair.b.encode(text)
            parts = []
            for i in ids:
                p = pair.b.id_to_piece(i)
                parts.append(bytes.fromhex(p[3:5]) if pair.b.is_byte(i) else p.replace("▁", " ").encode())
        if b"".join(parts) != (" " + text).encode():
            return [], []
        at, own = 0, []
        for i, p in zip(ids, parts, strict=True):
            own.append((i, at, at + len(p)))
            at += len(p)
        out.append(own)
    return tuple(out)


def plain(pair, texts):
    """Rows of the query by comparing every token with every other."""
    tokens = [plain_tokens(pair, t) for t in texts]
    linked = [[(i, j) for i, s, e in a for j, u, v in b if s < v and u < e] for a, b in tokens]
    counts = Counter(x for own in linked for x in own)
    most = Counter()
    for (_, j), n in counts.items():
        most[j] = max(most[j], n)
    rows = []
    for (a, b), own in zip(tokens, linked, strict=True):
        ends = sorted({e for _, _, e in a} & {e for _, _, e in b})
        shown, start = [], 0
        for end in ends:
            shown.append("|".join(",".join(str(i) for i, _, e in side if start < e <= end) for side in (a, b)))
            start = end
        digest = hashlib.sha256(";".join(shown).encode()).hexdigest() if a else ""
        best = sum(counts[x] == most[x[1]] for x in own)
        rows.append((len(a), len(b), len(ends), len(own), best, sum(counts[x] for x in own), digest))
    return rows


COLUMNS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def result(docs, head=A.HEAD):
    digest = F.when(F.col("n_a") > 0, F.sha2(F.col("groups").cast("binary"), 256)).otherwise(F.lit(""))
    found = A.aligned(docs).withColumn("groups_sha256", digest)
    rows = A.with_counts(found, A.piece_count(), head).orderBy("doc_id").collect()
    return [tuple(r[c] for c in COLUMNS) for r in rows]


def odd_texts():
    rng = random.Random(5)
    points = [*range(1, 0x180), 0x2581, 0x3000, 0x4E00, 0x1F600, 0x301, 0xFEFF]
    parts = ["the", " of", "<|endoftext|>", "<s>", "</s>", "<unk>", "<0x41>", "  ", "\n\n", "ing", "'s"]
    made = ["".join(chr(rng.choice(points)) if rng.random() < 0.3 else rng.choice(parts) for _ in range(rng.randint(1, 25)))
            for _ in range(150)]
    return [None, "", " ", "same text", "same text", "▁", *made]


def test_equals_comparing_all_tokens(spark, pair):
    texts = odd_texts()
    want = plain(pair, texts)
    assert sum(w[0] == 0 for w in want) < len(texts) / 2
    docs = frame(spark, *texts).withColumn("n_best", F.lit("clash"))
    assert result(docs) == want
    # Nearly all pairs looked up by the join, and all of them.
    assert result(docs, head=20) == want
    assert result(docs, head=0) == want


def test_query_equals_comparing_all_tokens(spark, pair):
    docs = spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect()
    got = {r.doc_id: tuple(r[c] for c in COLUMNS) for r in A.op12_alignment(spark, SF).collect()}
    # Comparing all tokens takes too long for long texts; their counts and groups are built by sweeping.
    tokens = {d.doc_id: plain_tokens(pair, d.text) for d in docs}
    linked = {}
    for k, (a, b) in tokens.items():
        own, j = [], 0
        for i, s, e in a:
            while b[j][2] <= s:
                j += 1
            m = j
            while m < len(b) and b[m][1] < e:
                own.append((i, b[m][0]))
                m += 1
        linked[k] = own
    counts = Counter(x for own in linked.values() for x in own)
    most = Counter()
    for (_, j), n in counts.items():
        most[j] = max(most[j], n)
    assert len(got) == len(docs)
    for k, own in linked.items():
        a, b = tokens[k]
        ends = {e for _, _, e in a} & {e for _, _, e in b}
        want = (len(a), len(b), len(ends), len(own), sum(counts[x] == most[x[1]] for x in own), sum(counts[x] for x in own))
        assert got[k][:6] == want
        assert (got[k][6] == "") == (not a)


def test_texts_by_units_equal_whole_texts(pair):
    assert pair.by_units
    rng = random.Random(9)
    parts = ["word", "Größe", "\u00a0", "\t", "\n", " ", "  ", "\x1c", "\u2003", "'s", "'", "12", "...", "▁", "\u0301", "\u200b", "\u3000", "\u1680", "\x85"]
    texts = ["".join(rng.choices([*parts, " "], [1] * len(parts) + [8], k=rng.randint(1, 14))) for _ in range(4000)]
    memory, whole = A.Memory(pair), A.align(pair, texts)
    for first in range(0, len(texts), 500):
        got = memory.columns(texts[first : first + 500])
        assert got[4].to_pylist() == whole.groups[first : first + 500]
        for c in range(4):
            assert got[c].to_pylist() == whole.sizes[first : first + 500, c].tolist()
        for i, (pairs, times) in enumerate(zip(got[5].to_pylist(), got[6].to_pylist(), strict=True), first):
            span = slice(whole.borders[i], whole.borders[i + 1])
            assert np.array_equal(np.frombuffer(pairs, "<u4"), whole.pairs[span])
            assert np.array_equal(np.frombuffer(times, "<u4"), whole.times[span])


def test_long_chains_and_lone_tokens():
    # Tokens of three bytes that never end together but at the end: one group, whatever its length.
    a = np.append(np.arange(3, 30_000, 3), 30_000)
    b = np.append(np.arange(1, 30_000, 3), 30_000)
    last = A.terminals(a, b)
    assert set(last.tolist()) == {len(a) + len(b) - 1}
    assert set(A.terminals(np.arange(1, 9), np.arange(1, 9)).tolist()) == set(range(8, 16))


def test_counts_hold_when_tasks_add_up_in_parts(spark, monkeypatch):
    docs = frame(spark, *["the cat sat on the mat", "another, longer text of words"] * 20, None)
    found = staged(A.aligned(docs), "found")
    whole = {r.pair: r.n for r in A.counted(found).collect()}
    monkeypatch.setattr(A, "HELD", 3)
    assert {r.pair: r.n for r in A.counted(found.repartition(3)).collect()} == whole
    assert A.with_counts(A.aligned(docs.limit(0)), A.piece_count()).count() == 0


def test_repeated_ids_and_long_texts(spark, pair):
    long = "Größe und Maß; " * 20_000
    docs = spark.createDataFrame([(7, "a b c"), (7, "a b c"), (None, "d e"), (8, long)], "doc_id long, text string")
    rows = A.with_counts(A.aligned(docs), A.piece_count()).collect()
    assert len(rows) == 4
    assert sorted(r.n_links for r in rows)[-1] > 100_000
    same = [r for r in rows if r.doc_id == 7]
    assert same[0] == same[1] and same[0].count_sum >= 2 * same[0].n_links
