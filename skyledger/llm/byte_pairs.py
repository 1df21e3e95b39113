"""BPE encoding and decoding with a contiguous array of ranks per word.

A text is cut at special tokens, normalised (NFC, white space to one space, lower case per code point)
and split into words by ``SPLIT``. A word starts as one part per UTF-8 byte, the last one carrying the
word end; next to the parts stands the array of ranks of neighbouring parts. The smallest rank is
looked for by a scan, its boundary deleted and the two ranks beside it refreshed, until no pair has a
rank. Words of over ``SHORT`` parts take a heap instead, as repeated scans would be quadratic there; both
give the same parts. Results of short words are remembered in each worker, up to ``REMEMBERED`` of them.

Decoding joins the vocabulary's strings by one space, as a tokenizer file without a decoder asks for.

Edge cases: NULL and empty texts have no tokens and decode to the empty text. Repeated rows are encoded
each. Columns named like the results are replaced; others are kept.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm import words as W

VOCABULARY = "/opt/tokenizers/word_bpe_49k.json"
SHORT = 48
REMEMBERED = 150_000
NO_RANK = 1 << 30

# The white space and word patterns of the tokenizer file.
SPACE = r"\t-\r \x85\xa0  -     　"
SPLIT = rf"'s|'t|'re|'ve|'m|'ll|'d|[\p{{L}}]+|[\p{{N}}]|[^{SPACE}\p{{L}}\p{{N}}]+"
WORD_END = "</w>"


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in the vocabulary's strings."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters, extra = {b: chr(b) for b in plain}, 256
    for b in range(256):
        if b not in letters:
            letters[b], extra = chr(extra), extra + 1
    return [letters[b] for b in range(256)]


class Encoder:
    """Ranks and ids of one tokenizer file of the kind described above."""

    def __init__(self, described: dict) -> None:
        vocabulary = described["model"]["vocab"]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in described["model"]["merges"]]
        self.specials = {t["content"]: t["id"] for t in described["added_tokens"]}
        self.letters = [vocabulary[c] for c in byte_letters()]
        self.finals = [vocabulary[c + WORD_END] for c in byte_letters()]
        self.rank = {(vocabulary[a], vocabulary[b]): i for i, (a, b) in enumerate(pairs)}
        self.merged = [vocabulary[a + b] for a, b in pairs]
        self.strings = [""] * (1 + max([*vocabulary.values(), *self.specials.values()]))
        for string, i in [*vocabulary.items(), *self.specials.items()]:
            self.strings[i] = string
        self.cut = re.compile("(" + "|".join(map(re.escape, self.specials)) + ")") if self.specials else None
        self.find = regex.compile(SPLIT).findall
        self.space = re.compile(f"[{SPACE}]+")
        self.known: dict[str, bytes] = {}
        self.units: dict[str, bytes] = {}

    def parts(self, word: str) -> list[int]:
        """Ids of one word."""
        data = word.encode()
        ids = [self.letters[b] for b in data[:-1]]
        ids.append(self.finals[data[-1]])
        return self.scan(ids) if len(ids) <= SHORT else self.heap(ids)

    def scan(self, ids: list[int]) -> list[int]:
        rank = self.rank.get
        ranks = [rank(pair, NO_RANK) for pair in zip(ids, ids[1:], strict=False)]
        while ranks:
            least = min(ranks)
            if least == NO_RANK:
                break
            i = ranks.index(least)
            ids[i] = self.merged[least]
            del ids[i + 1], ranks[i]
            if i:
                ranks[i - 1] = rank((ids[i - 1], ids[i]), NO_RANK)
            if i < len(ranks):
                ranks[i] = rank((ids[i], ids[i + 1]), NO_RANK)
        return ids

    def heap(self, ids: list[int]) -> list[int]:
        """The same by a queue of pairs over linked parts, for long words."""
        n = len(ids)
        after, before = [*range(1, n), -1], [*range(-1, n - 1)]
        queue = [
            (r, i) for i in range(n - 1) if (r := self.rank.get((ids[i], ids[i + 1]), NO_RANK)) < NO_RANK
        ]
        heapq.heapify(queue)
        while queue:
            least, i = heapq.heappop(queue)
            j = after[i]
            if ids[i] < 0 or j < 0 or self.rank.get((ids[i], ids[j]), NO_RANK) != least:
                continue
            ids[i], ids[j] = self.merged[least], -1
            after[i] = after[j]
            if after[i] >= 0:
                before[after[i]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b >= 0:
                    r = self.rank.get((ids[a], ids[b]), NO_RANK)
                    if r < NO_RANK:
                        heapq.heappush(queue, (r, a))
        return [i for i in ids if i >= 0]

    def word(self, word: str) -> bytes:
        got = self.known.get(word)
        if got is None:
            got = np.array(self.parts(word), "<u4").tobytes()
            if len(word) <= SHORT:
                if len(self.known) >= REMEMBERED:
                    self.known.clear()
                self.known[word] = got
        return got

    def unit(self, unit: str) -> bytes:
        """Ids of a stretch without white space."""
        got = self.units.get(unit)
        if got is None:
            got = b"".join([self.word(word) for word in self.find(unit)])
            if len(unit) <= SHORT:
                if len(self.units) >= REMEMBERED:
                    self.units.clear()
                self.units[unit] = got
        return got

    def plain(self, text: str) -> bytes:
        """Ids of a text without special tokens."""
        if not unicodedata.is_normalized("NFC", text):
            text = unicodedata.normalize("NFC", text)
        text = self.space.sub(" ", text)
        # Lower case by code point: str.lower() alone would look around a capital sigma.
        text = "".join(map(str.lower, text)) if "Σ" in text else text.lower()
        known = self.units.get
        return b"".join([known(u) or self.unit(u) for u in text.split(" ")])

    def encode(self, text: str) -> bytes:
        """Ids of a whole text as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        if self.cut is None or "<|" not in text:
            return self.plain(text)
        special = self.specials
        return b"".join(
            np.array([special[s]], "<u4").tobytes() if s in special else self.plain(s)
            for s in self.cut.split(text)
        )

    def decode(self, ids: bytes) -> str:
        return " ".join(map(self.strings.__getitem__, np.frombuffer(ids, "<u4").tolist()))


_encoders: dict[str, Encoder] = {}


def encoder(described: str) -> Encoder:
    """One encoder per worker and tokenizer, so that what it remembers serves all its tasks."""
    if described not in _encoders:
        _encoders.clear()
        _encoders[described] = Encoder(json.loads(described))
    return _encoders[described]


def encode_decode(docs: DataFrame, text: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """``docs`` with ``token_ids`` (little-endian unsigned 32-bit integers) and ``decoded``, which is
    made from the ids alone. The vocabulary file, of fixed size, is read here and sent to executors."""
    with open(vocabulary, encoding="utf-8") as f:
        sent = docs.sparkSession.sparkContext.broadcast(f.read())

    def run(texts):
        own = encoder(sent.value)
        ids = [own.encode(t or "") for t in texts.to_pylist()]
        return [pa.array(ids, pa.binary()), pa.array(map(own.decode, ids), pa.string(), size=len(ids))]

    return W.with_columns(docs, text, run, "token_ids binary, decoded string", W.SLICE_BYTES)


def digests(docs: DataFrame, *kept: str, vocabulary: str = VOCABULARY) -> DataFrame:
    """The kept columns, the number of tokens, and digests of the ids and of the decoded text."""
    return encode_decode(docs, vocabulary=vocabulary).select(
        *kept,
        (F.length("token_ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("token_ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op10_byte_pairs(spark, sf_dir: str) -> DataFrame:
    """Encode and decode every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return digests(docs, "doc_id")
