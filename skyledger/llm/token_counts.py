"""Token counts: greedy longest-match word pieces, counted in linear time by an automaton.

The pieces form a trie. Each node has a failure link and the number of pieces that are complete when the
link is taken; both are computed once. Reading a word then moves along the trie, and at a missing edge
adds the node's number and follows its link, so no piece is built and no character read twice.

The pieces are the strings of a public vocabulary file without its word-end marks; every byte is one of
them, so each word can be cut. A word is ``[^\\x20\\x09-\\x0D]+`` of the lower-cased text.

Edge cases: NULL and empty texts have no words and no pieces. Repeated rows are counted each. Columns
named like the results are replaced; others are kept.
"""

from __future__ import annotations

import json
import re

import pyarrow as pa
from pyspark.sql import DataFrame

from skyledger.llm import words as W
from skyledger.llm.byte_pairs import VOCABULARY, WORD_END, byte_letters

REMEMBERED = 200_000
REMEMBERED_BYTES = 64
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def pieces(described: str) -> list[bytes]:
    """The distinct pieces of a byte-level vocabulary, as bytes."""
    byte = {c: i for i, c in enumerate(byte_letters())}
    names = {t.removesuffix(WORD_END) for t in json.loads(described)["model"]["vocab"]}
    return sorted(bytes(map(byte.__getitem__, n)) for n in names if n)


class Automaton:
    """Trie edges by (node, byte); per node the failure link (-1: none) and the popped pieces."""

    def __init__(self, vocabulary: list[bytes]) -> None:
        self.edge: dict[int, int] = {}
        whole, parents = [False], [(0, 0)]
        for piece in vocabulary:
            node = 0
            for b in piece:
                key = node << 8 | b
                if key not in self.edge:
                    self.edge[key] = len(whole)
                    whole.append(False)
                    parents.append((node, b))
                node = self.edge[key]
            whole[node] = True
        self.link, self.popped = [-1] * len(whole), [0] * len(whole)
        order, depth = [], [0] * len(whole)
        for node in range(1, len(whole)):  # a parent is numbered before its children
            depth[node] = depth[parents[node][0]] + 1
            order.append(node)
        for node in sorted(order, key=depth.__getitem__):
            if whole[node]:
                self.link[node], self.popped[node] = 0, 1
                continue
            parent, b = parents[node]
            at, popped = self.link[parent], self.popped[parent]
            while at >= 0 and at << 8 | b not in self.edge:
                popped += self.popped[at]
                at = self.link[at]
            if at >= 0:
                self.link[node], self.popped[node] = self.edge[at << 8 | b], popped
        self.known: dict[str, int] = {}

    def count(self, word: bytes) -> int:
        """Number of pieces of a word; -1 if it can't be cut into pieces."""
        edge, link, popped = self.edge.get, self.link, self.popped
        node = total = 0
        for b in word:
            step = edge(node << 8 | b)
            while step is None:
                total += popped[node]
                node = link[node]
                if node < 0:
                    return -1
                step = edge(node << 8 | b)
            node = step
        while node > 0:
            total += popped[node]
            node = link[node]
        return total if node == 0 else -1

    def length(self, word: str) -> int:
        got = self.known.get(word)
        if got is None:
            data = word.encode()
            got = self.count(data)
            if len(data) <= REMEMBERED_BYTES:
                if len(self.known) >= REMEMBERED:
                    self.known.clear()
                self.known[word] = got
        return got


_automata: dict[str, Automaton] = {}


def automaton(described: str) -> Automaton:
    """One automaton per worker and vocabulary."""
    if described not in _automata:
        _automata.clear()
        _automata[described] = Automaton(pieces(described))
    return _automata[described]


def with_counts(docs: DataFrame, text: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """``docs`` with n_words and n_pieces; the vocabulary file, of fixed size, is sent to executors."""
    with open(vocabulary, encoding="utf-8") as f:
        sent = docs.sparkSession.sparkContext.broadcast(f.read())

    def run(texts):
        length = automaton(sent.value).length
        found = [WORD.findall((t or "").lower()) for t in texts.to_pylist()]
        return [
            pa.array([len(w) for w in found], pa.int64()),
            pa.array([sum(map(length, w)) for w in found], pa.int64()),
        ]

    return W.with_columns(docs, text, run, "n_words long, n_pieces long", W.SLICE_BYTES)


def op6_token_counts(spark, sf_dir: str) -> DataFrame:
    """Words and greedy word pieces of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return with_counts(docs).select("doc_id", "n_words", "n_pieces")
