from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from skyledger.llm import perplexity as P
from tests.conftest import SF
from tests.llm.common import WORD, frame


def base(text):
    text = text or ""
    w, seen, repeated = WORD.findall(text), set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            repeated += line in seen
            seen.add(line)
    count, marked = Counter(zip(w, w[1:], w[2:], strict=False)), set()
    for i in range(len(w) - 2):
        if count[tuple(w[i : i + 3])] > 1:
            marked.update((i, i + 1, i + 2))
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), repeated, len(marked)


def test_base_counts_and_verdicts(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = {r.doc_id: r for r in P.op3_perplexity(spark, SF).collect()}
    texts = docs.collect()
    assert len(out) == len(texts)
    for d in texts:
        r = out[d.doc_id]
        own = base(d.text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == own
        assert r.base_failed == (own[0] < 50 or 100 * own[4] > 50 * own[0])
        assert not (r.base_failed and r.kept)
    labels = spark.read.parquet(f"{SF}/labels.parquet").filter("quality = 1").collect()
    clean = [out[x.doc_id] for x in labels if not out[x.doc_id].base_failed]
    assert sum(r.kept for r in clean) >= 0.97 * len(clean)


def test_probabilities_of_each_context_add_up_to_one():
    gram, n = np.unique(P.grams(["the cat sat on the mat", "a cat", "tttt"])[0], return_counts=True)
    model = P.Model({"en": (gram, n)})
    contexts = [gram[0] >> 6, gram[-1] >> 6, 0, (5 << 12) | (7 << 6) | 9]
    for context in contexts:
        every = (np.uint32(context) << np.uint32(6)) | np.arange(64, dtype=np.uint32)
        assert abs(np.exp(model.log_probability("en", every)).sum() - 1) < 1e-4
    seen = model.log_probability("en", gram)
    assert (seen > model.log_probability("xx", gram)).mean() > 0.9


def test_edges(spark):
    long = "some words of a usual kind " * 20_000
    docs = frame(spark, None, "", "one", long, "\0 \0a\n\n\na", "the same text", "the same text")
    docs = docs.withColumn("lang", F.when(F.col("doc_id") != 2, F.col("lang"))).withColumn("n_words", F.lit("clash"))
    own = docs.select("doc_id", "lang", "text")
    rows = {r.doc_id: r for r in P.judge(P.scores(own, P.fit(own))).collect()}
    assert len(rows) == 7 and rows[0].n_words == 0 and rows[0].base_failed
    assert rows[3].n_words == 120_000 and rows[3].n_repeat_words == 120_000
    assert rows[4].n_dup_lines == 0 and rows[5].perplexity == rows[6].perplexity
    none = own.limit(0)
    assert P.judge(P.scores(none, P.fit(none))).count() == 0


def grammar(rng, n):
    """Sentences of one fixed word order each."""
    words = [[f"{a}{b}{c}" for b in "aeiou" for c in "nrt"] for a in ("th", "qu", "m", "gr", "pl", "sw")]
    return [w for _ in range(n) for w in (rng.choice(k) for k in words)]


def test_shuffled_words_are_rejected_and_the_tables_grow(spark):
    rng = np.random.default_rng(3)
    texts = [" ".join(grammar(rng, 30)) for _ in range(60)]
    order = [" ".join(rng.permutation(grammar(rng, 30))) for _ in range(2)]
    docs = frame(spark, *texts, *order).select("doc_id", "lang", "text")
    assert P.word_counts(docs).count() > 1.3 * P.word_counts(docs.filter("doc_id < 20")).count()
    kept = {r.doc_id for r in P.judge(P.scores(docs, P.fit(docs))).filter("kept").collect()}
    assert kept == set(range(60))


def test_word_probabilities_equal_plain_kneser_ney(spark):
    texts = ["a b a b c", "a b c d", "b c a b", "c d a b c a", "d a b", "a a b c d d"]
    docs = frame(spark, *texts).select("doc_id", "lang", "text")
    keys = [r[0] for r in docs.orderBy("doc_id").select(P.text_key()).collect()]
    rows = {r.doc_id: r.log_perplexity for r in P.scores(docs, P.fit(docs)).collect()}
    grams = [list(zip(s, s[1:], s[2:])) for s in (["", "", *t.split(), "."] for t in texts)]
    for i, own in enumerate(grams):
        three = Counter(g for j, other in enumerate(grams) if (keys[j] ^ keys[i]) & 1 for g in other)
        two = Counter(g[1:] for g in three)
        one = Counter(g[1:] for g in two)
        assert three

        def p(gram, counts=(one, two, three), order=None):
            order = len(gram)
            table = counts[order - 1]
            below = p(gram[1:]) if order > 1 else 1 / (len(one) + 1)
            cut = P.discounts(np.array(list(table.values())))
            after = [n for g, n in table.items() if g[:-1] == gram[:-1]]
            if not after:
                return below
            n = table[gram]
            return (n - cut[min(n, 3)] + sum(cut[min(m, 3)] for m in after) * below) / sum(after)

        assert abs(rows[i] + np.mean([np.log(p(g)) for g in own])) < 1e-5


def test_dealt_grams_are_small_and_hot_words_change_nothing(spark):
    rng = np.random.default_rng(5)
    texts = [" ".join(rng.choice([f"w{i}" for i in range(300)], 400, p=np.arange(300, 0, -1) / 45150)) for _ in range(60)]
    docs = frame(spark, *texts, texts[0], None).select("doc_id", "lang", "text")
    none = P.Deal(2, np.zeros(0, np.uint64))
    grams = sum(len(t.split()) + 1 for t in [*texts, texts[0], ""])
    blocks = [r for i in range(P.ROUNDS) for r in P.word_blocks(docs, none, i).collect()]
    assert sum(P.unpacked(r.block)[3].shape[1] for r in blocks) == grams
    assert sum(len(r.block) for r in blocks) < 16 * grams
    hot = np.sort(P.W.words(next(P.W.slices(P.pa.array(["w0 w1 w2"]))), lower=True).hash)
    one, other = ({r[0]: r[2] for r in P.word_scores(docs, d).collect()} for d in (none, P.Deal(2, hot)))
    assert one.keys() == other.keys() and len(one) == 61
    assert all(abs(one[k] - other[k]) < 1e-9 for k in one)
