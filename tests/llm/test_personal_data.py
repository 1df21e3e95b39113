import hashlib
import random
import re

import numpy as np
import pytest

from skyledger.llm import personal_data as P
from tests.conftest import SF
from tests.llm.common import frame

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def plain_base(text):
    n = lambda m: len(re.sub("[^0-9]", "", m.group()))
    out = [("email", *m.span()) for m in EMAIL.finditer(text)]
    out += [("ip", *m.span()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m.group().split("."))]
    out += [("card", *m.span()) for m in CARD.finditer(text) if 12 <= n(m) <= 19 and P.luhn(re.sub("[^0-9]", "", m.group()))]
    out += [("phone", *m.span()) for m in PHONE.finditer(text) if 9 <= n(m) <= 15]
    return sorted(out, key=lambda s: (s[1], P.KINDS.index(s[0]), s[2]))


@pytest.fixture(scope="module")
def model(spark):
    return P.train(spark.read.parquet(f"{SF.replace('0.001', '0.01')}/documents.parquet"))


def test_base_spans_equal_the_patterns():
    rng = random.Random(1)
    for _ in range(20_000):
        text = "".join(rng.choice("0123 4.-+()@a%b\n٣é") for _ in range(rng.randint(0, 40)))
        assert sorted(P.base_spans(text)) == sorted(plain_base(text)), text


def test_long_runs_take_linear_time():
    for text in ("1" * 300_000, "a" * 300_000 + "@", "1." * 150_000, "+(" * 150_000, "@" * 300_000):
        P.base_spans(text)


def test_gradient_equals_differences():
    model = {k: v.astype(np.float64) for k, v in P.blank_model().items()}
    x, tags = P.labelled(["some text 12 here " * 20], 3)
    x, tags = x[:12], tags[:12]
    for t in np.flatnonzero((tags[0] > 0) & (tags[0] % 2 == 0)):
        tags[0, t] -= 1
    _, slopes = P.gradient(model, x, tags)
    for name in model:
        at = np.unravel_index(np.argmax(np.abs(slopes[name])), slopes[name].shape)
        step = 1e-2
        ends = []
        for sign in (1, -1):
            moved = {k: v.copy() for k, v in model.items()}
            moved[name][at] += sign * step
            ends.append(P.gradient(moved, x, tags)[0])
        assert abs((ends[0] - ends[1]) / (2 * step) - slopes[name][at]) < 0.05 * abs(slopes[name][at]) + 0.02, name


def test_held_out_labels(model, spark):
    texts = [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    x, tags = P.labelled(texts, 400, seed=77)
    got = P.decode(model, x)
    assert (got == tags).mean() > 0.95
    assert (got == tags)[tags > 0].mean() > 0.85


def test_windows_without_digit_or_sign_add_nothing(model):
    text = ("plain words " * 30 + "call (269) 555-3296 now " + "plain words " * 30) * 2
    every = range(0, max(len(text) - P.WINDOW, 0) + P.STRIDE, P.STRIDE)
    kept = P.window_starts(text)
    assert set(kept) < set(every)
    for start in set(every) - set(kept):
        assert not re.search("[0-9@]", text[start : start + P.WINDOW])
    covered = set().union(*(range(s, s + P.WINDOW) for s in kept))
    assert all(m.start() in covered for m in re.finditer("[0-9@]", text))


def test_query(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = P.op7_personal_data(spark, SF).collect()
    assert len(got) == len(texts)
    for r in got:
        base = [":".join(map(str, s)) for s in plain_base(texts[r.doc_id])]
        assert r.base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s.startswith(k + ":") for s in base) for k in P.KINDS]
        spans = r.spans.split(",") if r.spans else []
        assert len(spans) == len(set(spans)) == len(base) + r.n_added and set(base) <= set(spans)


def test_edges(spark, model):
    texts = [None, "", "a@b.co", "x" * 100_000 + " 9.8.7.6", "a@b.co", "1.2.3.4 é 中 +1 (826) 555-4081 190.137.223.20"]
    docs = frame(spark, *texts).withColumnRenamed("source", "pii_text")
    rows = P.with_spans(docs, model).orderBy("doc_id").collect()
    assert [len(r.pii_spans) for r in rows[:3]] == [0, 0, 1]
    assert rows[2].pii_text == rows[4].pii_text == "[EMAIL]"
    assert rows[3].pii_text.endswith(" [IP]") and rows[0].pii_text == ""
    assert rows[5].pii_text.startswith("[IP] é 中 ")
    assert P.with_spans(docs.limit(0), P.train(docs.limit(0))).count() == 0
