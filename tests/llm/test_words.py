import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from skyledger.llm import words as W
from tests.llm.common import WORD, lower, shingles

TEXT = st.text(st.sampled_from("aAbé \n\t\x0b\x1c\u2003中"), max_size=30)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.none() | TEXT, max_size=8), st.integers(1, 40))
def test_words_and_shingles_equal_the_pattern(texts, limit):
    seen, sets, first = [], [], 0
    for part in W.slices(pa.array(texts, pa.string()), limit):
        assert part.first == first
        first += part.n
        found = W.words(part)
        data = part.data.tobytes()
        cut = [data[a:b].decode() for a, b in zip(found.starts, found.ends, strict=True)]
        seen += [cut[a:b] for a, b in zip(found.borders[:-1], found.borders[1:], strict=True)]
        sets += W.shingle_sets(part, 3)
    assert first == len(texts)
    assert seen == [WORD.findall(t or "") for t in texts]
    wanted = [shingles(t, 3) for t in texts]
    assert [len(s) for s in sets] == [len(s) for s in wanted]
    for i in range(len(texts)):
        for j in range(i):
            assert len(np.intersect1d(sets[i], sets[j])) == len(wanted[i] & wanted[j])


def test_hashes_of_equal_words_are_equal_wherever_they_stand():
    part = next(iter(W.slices(pa.array(["abc x abc", "ABC é abc"]))))
    exact, folded = W.words(part).hash, W.words(part, lower=True).hash
    assert exact[0] == exact[2] == exact[5] != exact[3]
    assert folded[0] == folded[3]
    assert lower("ABCÉ") == "abcÉ"


def test_sliced_columns_and_clashing_names(spark):
    column = pa.array(["drop", "a b", None, "c"]).slice(1)
    assert [p.n for p in W.slices(column)] == [3]
    df = spark.createDataFrame([("a b", 7, "x")], "text string, N int, other string")
    out = W.with_columns(df, "text", lambda t: [pa.array([len(x) for x in t.to_pylist()], pa.int64())], "n long")
    assert out.columns == ["text", "other", "n"] and out.first() == ("a b", "x", 3)
