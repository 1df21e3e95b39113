import hashlib
import random

import numpy as np
import pytest
from tokenizers import Tokenizer

from skyledger.llm import byte_pairs as B
from tests.conftest import SF
from tests.llm.common import frame


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(B.VOCABULARY)


@pytest.fixture(scope="module")
def own():
    with open(B.VOCABULARY, encoding="utf-8") as f:
        return B.encoder(f.read())


def test_odd_texts_equal_the_library(library, own):
    rng = random.Random(8)
    points = [*range(0, 0x250), 0x3A3, 0x3C2, 0x130, 0x1E9E, 0x301, 0x1100, 0x1161, 0xAC00, 0x2028, 0x3000, 0x661, 0xBD]
    points += [0x4E00, 0x1F600, 0x1D7CE, 0xFB01, 0x345, 0xFEFF, 0x200B]
    parts = ["'s", "'LL", "<|endoftext|>", "<|startoftext|>", "<|end", " ", "the", "  ", "lower"]
    texts = ["a" * 3000, "ab" * 4000 + "!" * 900, "<|endoftext|>"]
    texts += [
        "".join(chr(rng.choice(points)) if rng.random() < 0.6 else rng.choice(parts) for _ in range(rng.randint(0, 30)))
        for _ in range(3000)
    ]
    for text in texts:
        ids = library.encode(text, add_special_tokens=False).ids
        got = own.encode(text)
        assert np.frombuffer(got, "<u4").tolist() == ids, text
        assert own.decode(got) == library.decode(ids, skip_special_tokens=False)


def test_scan_and_heap_give_the_same_parts(own):
    rng = random.Random(9)
    for _ in range(300):
        ids = [rng.choice(own.letters[97:110]) for _ in range(rng.randint(1, 90))]
        assert own.scan(list(ids)) == own.heap(list(ids))


def test_query_equals_the_library(spark, library):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = B.op10_byte_pairs(spark, SF).collect()
    assert len(got) == len(texts)
    for r in got:
        ids = library.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        decoded = library.decode(ids, skip_special_tokens=False).encode()
        assert r.decoded_sha256 == hashlib.sha256(decoded).hexdigest()


def test_edges(spark):
    docs = frame(spark, None, "", " \n ", "é" * 100_000, "same", "same").withColumnRenamed("source", "token_ids")
    rows = B.encode_decode(docs).orderBy("doc_id").collect()
    assert [bytes(r.token_ids) for r in rows[:3]] == [b""] * 3 and [r.decoded for r in rows[:3]] == [""] * 3
    assert rows[4].decoded == rows[5].decoded == "same</w>"
    assert B.digests(docs.limit(0), "doc_id").count() == 0
