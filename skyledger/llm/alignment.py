"""Cross-tokenizer alignment: groups of tokens of two tokenizers that cover the same bytes.

Both tokenizers encode a space and the text. Tokens of the one and the other are linked where their
byte ranges overlap; linked tokens form groups, which end where both tokenizers end a token. Groups are
labelled by pointer jumping: each token points to the farthest-right token that it overlaps, the last
one to itself, and the pointers of all tokens of many texts are doubled at once (``to = to[to]``) until
nothing changes, which takes the logarithm of the longest chain. Each token then points to the terminal
token of its group. Words that come again are not aligned again.

A pair of ids counts as often as links of the whole corpus hold it. Texts are encoded once; the pairs of
each text are written with it, summed within tasks and then over all. Of the counted pairs, those with
the highest counts (at most ``HEAD``, by powers of two) are sent to the tasks; what remains, none of
which is frequent, is looked up by a join. The counts are exact either way.

Edge cases: a text that is NULL or empty, or whose tokens' bytes do not give the space and the text back
for both tokenizers, has no tokens: zeros and an empty string. Rows that repeat an id are documents of
their own and each count; a NULL id stays. An empty table gives none. Extra columns stay, except those
named like new ones or ``row_id``.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import chain, pairwise

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm import words as W
from skyledger.llm.store import staged

BYTE_VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
PIECE_VOCABULARY = public_tokenizers.path("piece_bpe_32k.model")

#: Most pairs that are sent to every task (16 bytes each).
HEAD = 1 << 20
#: Bytes of distinct units that a worker remembers.
REMEMBERED = 1 << 22
#: Units that go through the tokenizers as one text.
TOGETHER = 256
#: Name of the rule that leaves a text as it is, as a piece model holds it.
UNCHANGED = b"\x08identity"
#: Pairs that a task holds before it adds them up.
HELD = 1 << 22


def byte_letters() -> dict[str, int]:
    """Letter of each byte in a byte-level vocabulary: printable bytes stand for themselves, the others
    follow from code point 256 on."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Pair:
    """Both tokenizers, and the bytes of their tokens; texts are given as space and text."""

    def __init__(self, byte_json: str, piece_model: bytes) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has one task for each core
        import sentencepiece
        import tokenizers

        self.a = tokenizers.Tokenizer.from_str(byte_json)
        self.a.no_truncation()
        self.a.no_padding()
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=piece_model)
        letters = byte_letters()
        size_a = self.a.get_vocab_size()
        self.bytes_a = [bytes(map(letters.__getitem__, self.a.id_to_token(i))) for i in range(size_a)]
        self.bytes_b = [self.piece(i) for i in range(self.b.get_piece_size())]
        self.sizes_a = np.array([len(x) for x in self.bytes_a])
        self.sizes_b = np.array([len(x) for x in self.bytes_b])
        self.n_pairs = len(self.bytes_a) * len(self.bytes_b)
        self.shown_a = [f"{i}{end}" for end in ",|" for i in range(len(self.bytes_a))]
        self.shown = self.shown_a + [f"{i}{end}" for end in ",;" for i in range(len(self.bytes_b))]
        # Whether a text may be encoded unit by unit: see Memory.
        given = json.loads(byte_json)
        cuts = given["normalizer"] is None and (given["pre_tokenizer"] or {}).get("use_regex", False)
        spaced = any("▁" in self.b.id_to_piece(i).lstrip("▁") for i in range(self.b.get_piece_size()))
        self.by_units = bool(cuts) and not spaced and UNCHANGED in piece_model

    def piece(self, i: int) -> bytes:
        piece = self.b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()

    def encode(self, texts: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Ids of texts that both tokenizers give back byte by byte; empty for the others."""
        both = [], []
        given = [" " + t for t in texts]
        found_a = self.a.encode_batch_fast(given, add_special_tokens=False)
        found_b = self.b.encode(texts, num_threads=1)
        for text, in_a, b in zip(given, found_a, found_b, strict=True):
            a, whole = in_a.ids, text.encode()
            if (
                len(text) == 1
                or b"".join(map(self.bytes_a.__getitem__, a)) != whole
                or b"".join(map(self.bytes_b.__getitem__, b)) != whole
            ):
                a = b = []
            both[0].append(np.array(a, np.int64))
            both[1].append(np.array(b, np.int64))
        return both

    def encode_units(self, units: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """As ``encode``, for units: those without white space at their ends go through the tokenizers
        together and are cut apart by their bytes."""
        if not self.by_units:
            return self.encode(units)
        inner = [i for i, u in enumerate(units) if not u[0].isspace() and not u[-1].isspace()]
        chunks = [inner[i : i + TOGETHER] for i in range(0, len(inner), TOGETHER)]
        joined = self.encode([" ".join([units[i] for i in chunk]) for chunk in chunks])
        out = [np.zeros(0, np.int64)] * len(units), [np.zeros(0, np.int64)] * len(units)
        alone = sorted(set(range(len(units))) - set(inner))
        for chunk, a, b in zip(chunks, *joined, strict=True):
            if not len(a):  # at least one of them has no tokens
                alone += chunk
                continue
            ends = np.cumsum([1 + len(units[i].encode()) for i in chunk])
            for ids, sizes, kept in ((a, self.sizes_a, out[0]), (b, self.sizes_b, out[1])):
                cuts = [0, *np.searchsorted(np.cumsum(sizes[ids]), ends, side="right").tolist()]
                for i, x, y in zip(chunk, cuts[:-1], cuts[1:], strict=True):
                    kept[i] = ids[x:y]
        for i, a, b in zip(alone, *self.encode([units[i] for i in alone]), strict=True):
            out[0][i], out[1][i] = a, b
        return out


def terminals(ends_a: np.ndarray, ends_b: np.ndarray) -> np.ndarray:
    """For each token, first those of A, then those of B, the number of its group's last token, which
    is one of B. Both lists of ends rise and end alike."""
    n = len(ends_a)
    over_b = np.searchsorted(ends_b, ends_a, side="left")
    over_a = np.searchsorted(ends_a, ends_b, side="left")
    own = np.arange(len(ends_b)) + n
    to = np.concatenate([over_b + n, np.where(ends_a[over_a] > ends_b, over_a, own)])
    while True:
        further = to[to]
        if np.array_equal(further, to):
            return to
        to = further


def links(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of all tokens of A and of B that overlap, pair by pair."""
    starts = np.concatenate([[0], ends_a[:-1]])
    first = np.searchsorted(ends_b, starts, side="right")
    n = np.searchsorted(ends_b, ends_a, side="left") - first + 1
    return np.repeat(np.arange(len(ends_a)), n), np.repeat(first - np.cumsum(n) + n, n) + np.arange(n.sum())


@dataclass
class Units:
    """Aligned units in order: the numbers of tokens of A and B, groups and links (columns of ``sizes``),
    the groups in decimals, and the id pairs with their times, cut at ``borders``."""

    sizes: np.ndarray
    groups: list[str]
    pairs: np.ndarray
    times: np.ndarray
    borders: np.ndarray

    @classmethod
    def none(cls) -> Units:
        empty = np.zeros(0, np.int64)
        return cls(np.zeros((0, 4), np.int64), [], empty, empty, np.zeros(1, np.int64))

    def plus(self, other: Units) -> Units:
        return Units(
            np.concatenate([self.sizes, other.sizes]),
            self.groups + other.groups,
            np.concatenate([self.pairs, other.pairs]),
            np.concatenate([self.times, other.times]),
            np.concatenate([self.borders, other.borders[1:] + self.borders[-1]]),
        )


def align(pair: Pair, texts: list[str], encode: Callable | None = None) -> Units:
    """Each text aligned by itself; one that has no tokens has zeros."""
    encode = encode or pair.encode
    ids_a, ids_b = encode(texts)
    n_a, n_b = (np.array([len(x) for x in ids], np.int64) for ids in (ids_a, ids_b))
    a, b = (np.concatenate([np.zeros(0, np.int64), *ids]) for ids in (ids_a, ids_b))
    if not len(a):
        none = np.zeros(0, np.int64)
        return Units(np.zeros((len(texts), 4), np.int64), [""] * len(texts), none, none, np.zeros(len(texts) + 1, int))
    # The byte ranges of the texts lie end to end, and every text ends a group.
    ends_a, ends_b = np.cumsum(pair.sizes_a[a]), np.cumsum(pair.sizes_b[b])
    row_a, row_b = (np.repeat(np.arange(len(texts)), n) for n in (n_a, n_b))
    last = terminals(ends_a, ends_b)
    closing = np.flatnonzero(last[len(a) :] == np.arange(len(b)) + len(a))
    group = np.searchsorted(closing, last - len(a))
    group_a, group_b = group[: len(a)], group[len(a) :]

    shown = np.empty(len(a) + len(b), np.int64)
    closes_a = np.append(group_a[1:] != group_a[:-1], True)
    closes_b = np.append(group_b[1:] != group_b[:-1], True)
    shown[np.arange(len(a)) + np.searchsorted(group_b, group_a, side="left")] = a + closes_a * len(pair.bytes_a)
    shown[np.arange(len(b)) + np.searchsorted(group_a, group_b, side="right")] = (
        b + closes_b * len(pair.bytes_b) + len(pair.shown_a)
    )
    strings = list(map(pair.shown.__getitem__, shown.tolist()))
    cuts = np.concatenate([[0], np.cumsum(n_a + n_b)]).tolist()
    groups = ["".join(strings[x:y])[:-1] for x, y in pairwise(cuts)]

    at_a, at_b = links(ends_a, ends_b)
    row = row_a[at_a]
    key, times = np.unique(row * pair.n_pairs + a[at_a] * len(pair.bytes_b) + b[at_b], return_counts=True)
    n_groups, n_links = (np.bincount(x, minlength=len(texts)) for x in (row_b[closing], row))
    borders = np.searchsorted(key, np.arange(len(texts) + 1) * pair.n_pairs)
    return Units(np.stack([n_a, n_b, n_groups, n_links], 1), groups, key % pair.n_pairs, times, borders)


#: A single space between two characters that are not white space ends a token of both tokenizers.
BETWEEN = re.compile(r"(?<=\S) (?=\S)")


class Memory:
    """Aligns texts unit by unit and remembers the units. A unit starts at a single space; the pattern
    of A takes a space to the word after it, and no piece of B has a space behind another character, so
    a text's tokens and groups are those of its units. With other tokenizers a text is one unit."""

    def __init__(self, pair: Pair) -> None:
        self.pair, self.known, self.bytes, self.units = pair, {}, 0, Units.none()

    def learn(self, new: list[str]) -> None:
        self.known.update(zip(new, range(len(self.known), len(self.known) + len(new)), strict=True))
        self.units = self.units.plus(align(self.pair, new, self.pair.encode_units))

    def columns(self, texts: list[str | None]) -> list[pa.Array]:
        """The columns of ``ALIGNED``."""
        cut = BETWEEN.split if self.pair.by_units else lambda t: [t]
        own = [cut(t) if t else [] for t in texts]
        flat = list(chain.from_iterable(own))
        if self.bytes > REMEMBERED:
            self.known, self.bytes, self.units = {}, 0, Units.none()
        numbers = list(map(self.known.get, flat))
        if None in numbers:
            new = list(dict.fromkeys(u for u, n in zip(flat, numbers, strict=True) if n is None))
            self.learn(new)
            self.bytes += sum(map(len, new))
            numbers = list(map(self.known.get, flat))
        found, n_texts = self.units, len(texts)
        unit = np.array(numbers, np.int64)
        n_units = [len(units) for units in own]
        row = np.repeat(np.arange(n_texts), n_units)
        # A unit without tokens leaves its whole text without.
        lost = np.bincount(row[found.sizes[unit, 0] == 0], minlength=n_texts) > 0
        left = ~lost[row]
        unit, row = unit[left], row[left]
        sizes = np.stack([np.bincount(row, found.sizes[unit, c], n_texts) for c in range(4)]).astype(np.int64)
        shown = found.groups
        strings = list(map(shown.__getitem__, numbers))
        cuts = np.concatenate([[0], np.cumsum(n_units, dtype=np.int64)]).tolist()
        groups = ["" if gone else ";".join(strings[x:y]) for (x, y), gone in zip(pairwise(cuts), lost, strict=True)]

        # Each distinct unit of a text once, then its pairs.
        key, often = np.unique(row * len(shown) + unit, return_counts=True)
        row, unit = key // max(len(shown), 1), key % max(len(shown), 1)
        first = found.borders[unit]
        n = found.borders[unit + 1] - first
        at = np.repeat(first - np.cumsum(n) + n, n) + np.arange(n.sum())
        n_pairs = self.pair.n_pairs
        key, back = np.unique(np.repeat(row, n) * n_pairs + found.pairs[at], return_inverse=True)
        times = np.bincount(back, np.repeat(often, n) * found.times[at], len(key)).astype("<u4")
        cuts = np.searchsorted(key, np.arange(n_texts + 1) * n_pairs).tolist()
        key = (key % n_pairs).astype("<u4")
        return [
            *map(pa.array, sizes),
            pa.array(groups, pa.string()),
            pa.array([key[x:y].tobytes() for x, y in pairwise(cuts)], pa.binary()),
            pa.array([times[x:y].tobytes() for x, y in pairwise(cuts)], pa.binary()),
        ]


#: ``groups`` in decimals; ``pairs`` are the distinct id pairs (A's id times the size of B, plus B's id)
#: in order, ``times`` how often the text links each, both little-endian unsigned 32-bit integers.
ALIGNED = "n_a long, n_b long, n_groups long, n_links long, groups string, pairs binary, times binary"

_memories: dict[tuple[str, bytes], Memory] = {}


def memory(sent: Broadcast) -> Memory:
    """One memory for each worker and each pair of files, so that it serves all tasks."""
    if sent.value not in _memories:
        _memories.clear()
        _memories[sent.value] = Memory(Pair(*sent.value))
    return _memories[sent.value]


def aligned(
    docs: DataFrame, text: str = "text", byte_vocabulary: str = BYTE_VOCABULARY, piece_vocabulary: str = PIECE_VOCABULARY
) -> DataFrame:
    """``docs`` with the columns of ``ALIGNED``. The files, of fixed size, are sent to the executors."""
    with open(byte_vocabulary, encoding="utf-8") as f, open(piece_vocabulary, "rb") as g:
        sent = docs.sparkSession.sparkContext.broadcast((f.read(), g.read()))
    return W.with_columns(
        docs, text, lambda texts: memory(sent).columns(texts.to_pylist()), ALIGNED, W.SLICE_BYTES
    )


def packed(batch: pa.RecordBatch, name: str) -> np.ndarray:
    """The 32-bit integers of all cells of a binary column, end to end."""
    return np.frombuffer(b"".join(batch.column(name).to_pylist()), "<u4").astype(np.int64)


def added(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    own, back = np.unique(np.concatenate(keys), return_inverse=True)
    total = np.zeros(len(own), np.int64)
    np.add.at(total, back, np.concatenate(counts))
    return own, total


def counted(found: DataFrame) -> DataFrame:
    """(pair, n) over all rows of ``aligned``; each task adds up its own pairs first, some millions at a
    time."""
    most = HELD

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts, held = [], [], 0

        def summed():
            own, total = added(keys, counts)
            for i in range(0, len(own), 1 << 16):
                some = slice(i, i + (1 << 16))
                yield pa.RecordBatch.from_arrays([pa.array(own[some]), pa.array(total[some])], ["pair", "n"])

        for batch in batches:
            keys.append(packed(batch, "pairs"))
            counts.append(packed(batch, "times"))
            held += len(keys[-1])
            if held > most:
                own, total = added(keys, counts)
                keys, counts, held = [own], [total], len(own)
                if held > most // 2:
                    yield from summed()
                    keys, counts, held = [], [], 0
        if keys:
            yield from summed()

    partial = found.select("pairs", "times").mapInArrow(add_up, "pair long, n long")
    return partial.groupBy("pair").agg(F.sum("n").alias("n"))


def split(counts: DataFrame, head: int) -> tuple[DataFrame, DataFrame | None]:
    """The pairs with the highest counts, at most ``head``, and the others if there are any. The border
    is a power of two, so no pair below it is much more frequent than ``head`` others."""
    bits = F.length(F.bin("n"))
    sizes = dict(counts.groupBy(bits.alias("bits")).count().collect())  # one row for each power of two
    border, room = 64, head
    while border and sizes.get(border - 1, 0) <= room:
        border -= 1
        room -= sizes.get(border, 0)
    if not any(n for b, n in sizes.items() if b < border):
        return counts, None
    return counts.filter(bits >= border), counts.filter(bits < border)


def with_counts(found: DataFrame, size_b: int, head: int = HEAD) -> DataFrame:
    """``found``, a written result of ``aligned``, with ``n_best`` and ``count_sum`` in place of its
    pairs: the links whose pair is the most frequent of its B id, ties included, and the sum of all
    links' counts."""
    found = found.drop("n_best", "count_sum").withColumn("row_id", F.monotonically_increasing_id())
    rows = staged(found, "aligned")
    counts = staged(counted(rows), "pair-counts")
    of_b = F.pmod("pair", F.lit(size_b))
    # One row for each id of B: bounded by its vocabulary.
    best = counts.groupBy(of_b.alias("b")).agg(F.max("n").alias("most"))
    best = staged(best, "best-pairs").select("b", "most")
    flagged = counts.join(F.broadcast(best), of_b == F.col("b")).select(
        "pair", "n", (F.col("n") == F.col("most")).alias("is_best")
    )
    often, others = split(flagged, head)
    table = often.orderBy("pair").toArrow()  # at most ``head`` rows
    numbers = [table.column(c).to_numpy(zero_copy_only=False) for c in ("pair", "n", "is_best")]
    sent = found.sparkSession.sparkContext.broadcast(numbers)

    def known(batch: pa.RecordBatch) -> tuple[np.ndarray, ...]:
        """Row, pair and times of all pairs of a batch; number in the table of frequent pairs, or -1."""
        pair, times = packed(batch, "pairs"), packed(batch, "times")
        sizes = batch.column("pairs").to_pylist()
        row = np.repeat(np.arange(batch.num_rows), [len(x) // 4 for x in sizes])
        keys = sent.value[0]
        at = np.searchsorted(keys, pair)
        at[at == len(keys)] = 0
        if len(keys):
            at = np.where(keys[at] == pair, at, -1)
        else:
            at = np.full(len(pair), -1)
        return row, pair, times, at

    def look_up(batches):
        _, n, is_best = sent.value
        for batch in batches:
            row, _, times, at = known(batch)
            hit = at >= 0
            row, times, at = row[hit], times[hit], at[hit]
            sums = [np.zeros(batch.num_rows, np.int64) for _ in range(2)]
            np.add.at(sums[0], row, times * is_best[at])
            np.add.at(sums[1], row, times * n[at])
            kept = batch.drop_columns(["pairs", "times"])
            yield pa.RecordBatch.from_arrays(
                [*kept.columns, *map(pa.array, sums)], [*kept.schema.names, "n_best", "count_sum"]
            )

    kept = [f for f in rows.schema if f.name not in ("pairs", "times")]
    schema = rows.select(*[f"`{f.name}`" for f in kept]).schema.add("n_best", "long").add("count_sum", "long")
    out = rows.mapInArrow(look_up, schema)
    if others is None:
        return out.drop("row_id")

    def left_over(batches):
        for batch in batches:
            row, pair, times, at = known(batch)
            rare = at < 0
            ids = batch.column("row_id").to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays(
                [pa.array(x[rare]) for x in (ids[row], pair, times)], ["row", "pair", "times"]
            )

    rare = rows.select("row_id", "pairs", "times").mapInArrow(left_over, "row long, pair long, times long")
    more = rare.join(others, "pair").groupBy("row").agg(
        F.sum(F.when(F.col("is_best"), F.col("times")).otherwise(0)).alias("more_best"),
        F.sum(F.col("times") * F.col("n")).alias("more_sum"),
    )
    joined = out.join(more, F.col("row_id") == F.col("row"), "left")
    return joined.select(
        *[f"`{f.name}`" for f in kept if f.name != "row_id"],
        (F.col("n_best") + F.coalesce("more_best", F.lit(0))).alias("n_best"),
        (F.col("count_sum") + F.coalesce("more_sum", F.lit(0))).alias("count_sum"),
    )


def piece_count(piece_vocabulary: str = PIECE_VOCABULARY) -> int:
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=piece_vocabulary).get_piece_size()


def op12_alignment(spark, sf_dir: str) -> DataFrame:
    """Align the tokens of every document; returns the counts and the digest of its groups."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(F.col("doc_id").cast("long"), "text")
    digest = F.when(F.col("n_a") > 0, F.sha2(F.col("groups").cast("binary"), 256)).otherwise(F.lit(""))
    found = aligned(docs).withColumn("groups_sha256", digest).drop("text", "groups")
    return with_counts(found, piece_count()).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"
    )
