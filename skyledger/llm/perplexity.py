"""Quality rules: base counts of a text, and bands of n-gram perplexity per language.

Two interpolated modified Kneser-Ney models see each text. The word model counts word 1-, 2- and 3-grams
(A-Z without case, as 64-bit hashes) of all texts in tables that grow with the corpus and never leave the
executors; continuation counts, discounts and back-off weights follow by grouping. Texts are dealt into two
halves by their hash, and each is judged by the model of the half that does not hold it: exact copies do not
vouch for each other, and no text for itself. The letter model sees the spelling: 4-grams of the
64 symbols of ``SYMBOL`` (letters without case, one digit, single signs, classes for all else; white space
runs are one space), framed by borders. It has at most 64**4 grams a language and is broadcast.

``log_perplexity`` is the negative log-probability of the word model per word and text end;
``spelling`` that of the letter model per word. For each language (and half, for the word model) the
quartiles of the scores of all texts that pass the base rules give a band, quartile distance times ``FENCE``
(at least ``LEAST_WIDTH``) beyond the quartiles. A text above one of its two bands or below the one of
its spelling is rejected; a low score of the word model only says that other texts share passages.

Edge cases: NULL texts have no words and fail the base rules. A NULL language is the language ''. A
language with one text keeps it, as the band holds its own quartiles. Repeated rows count and are
returned each. Columns named like the results are replaced; others are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyledger.llm import words as W
from skyledger.llm.store import forget, passing, staged

ORDER = 4
BITS = 6
FENCE = 4.0
LEAST_WIDTH = 1.0
BIN = 1 / 64
#: Texts are cut into words so many bytes at a time; the arrays stay in the processor's cache.
SLICE_BYTES = 1 << 16
#: Word grams: rounds in which they are dealt, grams that a group holds about, grams that a task packs at once, letters
#: and white space a word, texts of which one is searched for hot words.
ROUNDS = 3
GROUP_GRAMS = 1 << 22
BLOCK_GRAMS = 1 << 22
LETTERS = 6
HOT_TEXTS = 64
#: Slices of the texts a group of a round, in which sums are brought together.
SLICES = 8
MIN_WORDS = 50
MAX_REPEATED_PERCENT = 50

# Signs that are symbols of their own.
SIGNS = ".,!?'\"-|#*$%&:;()/=+@_<>"
SYMBOL = (53 + np.arange(0x250) % 11).astype(np.uint32)
SYMBOL[0] = 0
SYMBOL[[9, 10, 11, 12, 13, 32]] = 1
SYMBOL[97:123] = SYMBOL[65:91] = np.arange(2, 28)
SYMBOL[48:58] = 28
SYMBOL[[ord(c) for c in SIGNS]] = np.arange(29, 29 + len(SIGNS))

SIGN_BYTES = np.zeros(256, bool)
SIGN_BYTES[[ord(c) for c in "#*$%&|<>"]] = True


def base_counts(texts: pa.Array) -> list[pa.Array]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of each text."""
    out = np.zeros((5, len(texts)), np.int64)
    for part in W.slices(texts, SLICE_BYTES):
        found = W.words(part)
        own = slice(part.first, part.first + part.n)
        letters = (part.data & 0xC0) != 0x80
        out[0, own] = found.per_row
        out[1, own] = W.sums(letters & ~W.WHITE[part.data], part.offsets)
        out[2, own] = W.sums(SIGN_BYTES[part.data], part.offsets)
        starts, ends = part.spans(part.data != 10)
        worded = np.searchsorted(found.starts, ends) > np.searchsorted(found.starts, starts)
        starts, ends = starts[worded], ends[worded]
        row = part.rows_of(starts)
        key = W.mix(part.hashes(starts, ends) + row.astype(np.uint64) * W.MULTIPLIERS[0])
        _, first = np.unique(key, return_index=True)
        out[3, own] = np.bincount(row, minlength=part.n) - np.bincount(row[first], minlength=part.n)
        hashed, at = W.windows(found, 3)
        key = W.mix(hashed + found.row[at].astype(np.uint64) * W.MULTIPLIERS[0])
        _, which, count = np.unique(key, return_inverse=True, return_counts=True)
        at = at[count[which] > 1]
        marked = np.zeros(len(found.row), bool)
        for j in range(3):
            marked[at + j] = True
        out[4, own] = W.sums(marked, found.borders)
    return [pa.array(row) for row in out]


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The 4-gram ending at each symbol of the texts and at each text's closing border; the text's
    number for each."""
    frame = "\0" * (ORDER - 1)
    whole = "".join([f"{frame}{t.replace(chr(0), ' ')}\0" for t in texts])
    points = np.frombuffer(whole.encode("utf-32-le", "surrogatepass"), "<u4")
    symbols = SYMBOL[np.where(points < len(SYMBOL), points, 0x240 + points % 11)]
    lengths = np.array([len(t) + ORDER for t in texts])
    text = np.repeat(np.arange(len(texts)), lengths)
    keep = np.ones(len(symbols), bool)
    keep[1:] = (symbols[1:] != 1) | (symbols[:-1] != 1)
    predicted = np.ones(len(symbols), bool)
    for j in range(ORDER - 1):
        predicted[np.cumsum(lengths) - lengths + j] = False
    symbols, text, predicted = symbols[keep], text[keep], predicted[keep]
    gram = symbols.copy()
    for j in range(1, ORDER):
        gram[j:] |= symbols[:-j] << np.uint32(BITS * j)
    return gram[predicted], text[predicted]


def by_language(languages: list, texts: list, limit: int = W.SLICE_BYTES):
    """Groups of row numbers of one language whose texts have about ``limit`` characters in total."""
    groups: dict[str, list[int]] = {}
    size: dict[str, int] = {}
    for i, (language, text) in enumerate(zip(languages, texts, strict=True)):
        name = language or ""
        groups.setdefault(name, []).append(i)
        size[name] = size.get(name, 0) + len(text or "")
        if size[name] >= limit:
            yield name, groups.pop(name)
            size[name] = 0
    yield from groups.items()


def added(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]):
    """Sum of two sparse counts with sorted keys."""
    keys, at = np.unique(np.concatenate([a[0], b[0]]), return_inverse=True)
    return keys, np.bincount(at, np.concatenate([a[1], b[1]]), len(keys)).astype(np.int64)


def gram_counts(docs: DataFrame) -> DataFrame:
    """lang, gram, n over all texts."""

    def count(batches):
        totals: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            languages, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for name, rows in by_language(languages, texts, 4 * W.SLICE_BYTES):
                found = np.unique(grams([texts[i] or "" for i in rows])[0], return_counts=True)
                totals[name] = added(totals[name], found) if name in totals else found
        for name, (keys, n) in totals.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(keys), pa.string()), pa.array(keys.astype(np.int32)), pa.array(n)],
                ["lang", "gram", "n"],
            )

    own = docs.select(F.col("lang").cast("string").alias("lang"), "text")
    counted = own.mapInArrow(count, "lang string, gram int, n long")
    return counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def discounts(count: np.ndarray) -> np.ndarray:
    """Discounts of counts 1, 2 and 3 or more; index 0 is 0."""
    return discounts_of(kinds(count))


def discounts_of(ones: list[int]) -> np.ndarray:
    """The discounts from how many grams have counts 1 to 4."""
    y = ones[0] / (ones[0] + 2 * ones[1]) if ones[0] else 0.5
    out = [0.0]
    for i in range(1, 4):
        d = i - (i + 1) * y * ones[i] / ones[i - 1] if ones[i - 1] else i / 2
        out.append(min(max(d, 0.05 * i), 0.95 * i))
    return np.array(out)


def hashed(language: str, order: int, gram: np.ndarray) -> np.ndarray:
    seed = np.frombuffer(language.encode().ljust(8, b"\0")[:8], "<u8")[0] ^ np.uint64(len(language))
    return W.mix(W.mix(gram.astype(np.uint64) + np.uint64(order << 32)) ^ seed)


class Table:
    """Sorted hashes of (language, order, gram) with a logarithm each."""

    def __init__(self, entries: list[tuple[np.ndarray, np.ndarray]]) -> None:
        key = np.concatenate([*(k for k, _ in entries), np.zeros(0, np.uint64)])
        order = np.argsort(key)
        self.key = key[order]
        self.log = np.log(np.concatenate([*(v for _, v in entries), np.zeros(0)]))[order].astype(np.float32)

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The logarithms (0 where absent) and which keys are there."""
        if not len(self.key):
            return np.zeros(len(keys), np.float32), np.zeros(len(keys), bool)
        at = np.minimum(np.searchsorted(self.key, keys), len(self.key) - 1)
        seen = self.key[at] == keys
        return np.where(seen, self.log[at], np.float32(0)), seen


class Model:
    """Probabilities of seen grams, and back-off weights of seen contexts."""

    def __init__(self, counts: dict[str, tuple[np.ndarray, np.ndarray]]) -> None:
        grams_, contexts = [], []
        for language, (gram, n) in counts.items():
            for order, (own, p, context, weight) in enumerate(kneser_ney(gram, n), 1):
                grams_.append((hashed(language, order, own), p))
                contexts.append((hashed(language, order - 1, context), weight))
        self.grams, self.contexts = Table(grams_), Table(contexts)

    def log_probability(self, language: str, gram: np.ndarray) -> np.ndarray:
        """Of each gram's last symbol after the ones before it; unseen grams back off."""
        out = np.zeros(len(gram))
        open_ = np.arange(len(gram))
        for order in range(ORDER, 0, -1):
            own = gram[open_] & np.uint32((1 << BITS * order) - 1)
            logs, seen = self.grams.find(hashed(language, order, own))
            out[open_] += logs
            open_, own = open_[~seen], own[~seen]
            if not len(open_):
                return out
            out[open_] += self.contexts.find(hashed(language, order - 1, own >> np.uint32(BITS)))[0]
        out[open_] -= BITS * np.log(2)
        return out


def kneser_ney(gram: np.ndarray, n: np.ndarray) -> list[tuple[np.ndarray, ...]]:
    """For orders 1 to 4: grams, their probabilities, contexts, and the contexts' back-off weights.

    Counts below the highest order are numbers of different symbols before a gram."""
    counts = {ORDER: (gram, n)}
    for order in range(ORDER - 1, 0, -1):
        longer = counts[order + 1][0]
        counts[order] = np.unique(longer & np.uint32((1 << BITS * order) - 1), return_counts=True)
    lower_key, lower_p = np.zeros(1, np.uint32), np.full(1, 1 / (1 << BITS))
    out = []
    for order in range(1, ORDER + 1):
        key, count = counts[order]
        discount = discounts(count)[np.minimum(count, 3)]
        context, at = np.unique(key >> np.uint32(BITS), return_inverse=True)
        total = np.bincount(at, count, len(context))
        weight = np.bincount(at, discount, len(context)) / total
        suffix = key & np.uint32((1 << BITS * (order - 1)) - 1)
        p = (count - discount) / total[at] + weight[at] * lower_p[np.searchsorted(lower_key, suffix)]
        out.append((key, p, context, weight))
        lower_key, lower_p = key, p
    return out


def letter_model(docs: DataFrame) -> Model:
    """The letter model of all texts; the counts have at most 64**4 rows a language."""
    table = gram_counts(docs).orderBy("lang", "gram").toArrow()
    language, gram, n = (table.column(i) for i in range(3))
    gram, n = gram.to_numpy().astype(np.uint32), n.to_numpy()
    code = language.combine_chunks().dictionary_encode() if table.num_rows else pa.array([], pa.string()).dictionary_encode()
    codes = code.indices.to_numpy()
    return Model({name: (gram[codes == i], n[codes == i]) for i, name in enumerate(code.dictionary.to_pylist())})


def text_key() -> Column:
    return F.xxhash64(F.coalesce("text", F.lit("")))


def language_key() -> Column:
    return F.xxhash64(F.coalesce("lang", F.lit("")))


@dataclass
class Deal:
    """How word 3-grams (u, v, w) are dealt: by v, into so many groups a round; those of ``hot`` (sorted)
    words v, too many for one group, by u and v."""

    groups: int
    hot: np.ndarray

    def bucket(self, u: np.ndarray, v: np.ndarray) -> np.ndarray:
        """Numbers below ``ROUNDS * groups``; round r has those from r * groups on."""
        key = v.copy()
        hot = np.flatnonzero(np.isin(v, self.hot)) if len(self.hot) else []
        key[hot] += W.mix(u[hot] + W.MULTIPLIERS[0])
        return (W.mix(key + W.MULTIPLIERS[1]) % np.uint64(ROUNDS * self.groups)).astype(np.int32)


def deal(docs: DataFrame) -> Deal:
    """Groups by the length of all texts. Hot words are found in one text of ``HOT_TEXTS``: which words are
    hot decides where grams are counted, never what is counted."""
    letters = docs.agg(F.sum(F.length("text"))).first()[0] or 0
    groups = max(1, -(-letters // (LETTERS * ROUNDS * GROUP_GRAMS)))

    def count(batches):
        for batch in batches:
            for part in W.slices(batch.column(0), SLICE_BYTES):
                word, n = np.unique(W.words(part, lower=True).hash, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(word.view(np.int64)), pa.array(n)], ["word", "n"])

    some = docs.select("text").filter(F.pmod(text_key(), F.lit(HOT_TEXTS)) == 0).mapInArrow(count, "word long, n long")
    hot = some.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") * HOT_TEXTS > GROUP_GRAMS).select("word")
    # At most as many words as there are groups.
    words = [] if letters < LETTERS * GROUP_GRAMS else [r.word for r in hot.collect()]
    return Deal(groups, np.sort(np.array(words, np.int64).view(np.uint64)))


def packed(keys: np.ndarray, grams_: np.ndarray) -> bytes:
    """The grams (three rows: u, v, w) of neighbouring texts: each text's key and number of grams, the words,
    and their numbers, frequent ones first, byte by byte."""
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    lengths = np.diff(np.concatenate([starts, [len(keys)]]))
    code = pa.array(grams_.ravel()).dictionary_encode()
    word, number = code.dictionary.to_numpy(), code.indices.to_numpy()
    order = np.argsort(-np.bincount(number), kind="stable")
    rank = np.empty(len(order), np.int32)
    rank[order] = np.arange(len(order))
    number = rank[number]
    planes = [((number >> 8 * j) & 255).astype(np.uint8).tobytes() for j in range(_bytes(len(word)))]
    sizes = np.array([len(starts), len(word), len(keys)])
    whole = b"".join([sizes.tobytes(), keys[starts].tobytes(), lengths.tobytes(), word[order].tobytes(), *planes])
    return len(whole).to_bytes(8, "little") + pa.compress(whole, "zstd", asbytes=True)


def _bytes(n: int) -> int:
    """Bytes that hold numbers below ``n``."""
    return max(1, ((n - 1).bit_length() + 7) // 8)


def unpacked(block: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The texts' keys and numbers of grams, the words, and three rows of their numbers."""
    whole = pa.decompress(memoryview(block)[8:], int.from_bytes(block[:8], "little"), "zstd", asbytes=True)
    texts, words, n = np.frombuffer(whole, np.int64, 3)
    at = 24 + 8 * texts
    keys, lengths = np.frombuffer(whole, np.int64, texts, 24), np.frombuffer(whole, np.int64, texts, at)
    word = np.frombuffer(whole, np.uint64, words, at + 8 * texts)
    planes = np.frombuffer(whole, np.uint8, offset=at + 8 * (texts + words)).reshape(_bytes(int(words)), 3 * n)
    number = planes[0].astype(np.int32)
    for j in range(1, len(planes)):
        number |= planes[j].astype(np.int32) << 8 * j
    return keys, lengths, word, number.reshape(3, n)


def word_blocks(docs: DataFrame, dealt: Deal, number: int) -> DataFrame:
    """language_key, bucket, block: the word 3-grams of the texts that are dealt in a round, packed; one gram
    for each word and one for the text's end."""
    own = docs.select(text_key(), language_key(), "text")

    def blocks(held):
        language, bucket, keys = (np.concatenate([h[i] for h in held]) for i in range(3))
        grams_ = np.concatenate([h[3] for h in held], axis=1)
        names, at = np.unique(language, return_inverse=True)
        at = at * np.int64(ROUNDS * dealt.groups) + bucket
        order = np.argsort(at, kind="stable")
        starts = np.flatnonzero(np.diff(at[order], prepend=-1))
        for rows in np.split(order, starts[1:]) if len(order) else []:
            block = packed(keys[rows], grams_[:, rows])
            first = [pa.array([x[rows[0]]]) for x in (language, bucket)]
            yield pa.RecordBatch.from_arrays([*first, pa.array([block], pa.binary())], ["language_key", "bucket", "block"])

    def run(batches):
        held, size = [], 0
        for batch in batches:
            keys, language = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for part in W.slices(batch.column(2), SLICE_BYTES):
                found = W.words(part, lower=True)
                row = np.repeat(np.arange(part.n), found.per_row + 3)
                ends = np.cumsum(found.per_row + 3)
                words = np.zeros(len(row), np.uint64)
                words[np.arange(len(found.row)) + 3 * found.row + 2] = found.hash
                words[ends - 1] = 1
                at = np.flatnonzero(row[:-2] == row[2:])
                bucket = dealt.bucket(words[at], words[at + 1])
                mine = bucket // dealt.groups == number
                at, of = at[mine], row[at[mine]] + part.first
                held.append((language[of], bucket[mine], keys[of], np.stack([words[at + j] for j in range(3)])))
                size += len(at)
                if size >= BLOCK_GRAMS:
                    yield from blocks(held)
                    held, size = [], 0
        if held:
            yield from blocks(held)

    return own.mapInArrow(run, "language_key long, bucket int, block binary")


def distinct(*columns: np.ndarray, size: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Order of the rows by the columns of numbers below ``size``, and for each leading column, with those
    before it, whether a row in this order differs from the one above."""
    bits = max(size - 1, 1).bit_length()
    if bits * len(columns) < 64:
        key = columns[0].astype(np.int64)
        for column in columns[1:]:
            key = key << bits | column
        order = np.argsort(key)
    else:
        order = np.lexsort(columns[::-1])
    new, out = np.zeros(len(order), bool), []
    new[:1] = True
    for column in columns:
        own = column[order]
        new = new.copy()
        new[1:] |= own[1:] != own[:-1]
        out.append(new)
    return order, out


class Counted:
    """The counts of a group's grams, of the different words before their last two, and of the different words
    before their last one, each in either half of the texts."""

    def __init__(self, blocks: pa.ChunkedArray, hot: np.ndarray) -> None:
        parts = [unpacked(block.as_buffer().to_pybytes()) for block in blocks]
        self.words = np.unique(np.concatenate([p[2] for p in parts]))
        size = len(self.words)
        u, v, w = np.concatenate([np.searchsorted(self.words, p[2]).astype(np.int32)[p[3]] for p in parts], axis=1)
        keys = np.concatenate([np.repeat(p[0], p[1]) for p in parts])
        del parts
        order, (_, context, gram) = distinct(v, u, w, size=size)
        #: Of each occurrence, its text and its gram; of each gram, its words, context u v and pair v w.
        self.keys = keys[order]
        self.gram = np.cumsum(gram) - 1
        first = order[gram]
        self.u, self.v, self.w = u[first], v[first], w[first]
        self.context = (np.cumsum(context) - 1)[gram]
        del u, v, w, keys, order, context, gram, first
        self.n = np.bincount(2 * self.gram + (self.keys & 1), minlength=2 * len(self.u)).reshape(-1, 2)
        order, (_, new) = distinct(self.v, self.w, size=size)
        self.pair = np.empty(len(order), np.int64)
        self.pair[order] = np.cumsum(new) - 1
        first = order[new]
        self.pair_v, self.pair_w = self.v[first], self.w[first]
        self.pair_n = np.stack([np.bincount(self.pair, self.n[:, h] > 0, len(first)) for h in (0, 1)], axis=1).astype(np.int64)
        self.hot = np.isin(self.words, hot)[self.pair_v]
        own = ~self.hot
        self.word_n = np.stack(
            [np.bincount(self.pair_w[own], self.pair_n[own, h] > 0, size) for h in (0, 1)], axis=1
        ).astype(np.int64)


#: Rows of what a group's counts add to the models. KINDS of grams and PAIRS: w is a count from 1 to 4, n0 and n1
#: how many have it in each half. WORDS: how many words come before w; HOT: how many come before v w, v a hot word.
HOT, WORDS, PAIRS, GRAMS = range(4)
GROUP = ["language_key", "bucket"]


def kinds(n: np.ndarray) -> list[int]:
    return [int((n == i).sum()) for i in range(1, 5)]


def group_counts(blocks: DataFrame, dealt: Deal) -> DataFrame:
    """language_key, bucket, kind, v, w, n0, n1 of each group's own grams."""

    def count(key, table):
        own = Counted(table.column("block"), dealt.hot)
        words, pairs = np.unique(own.pair_w), np.flatnonzero(own.hot)
        four, word = np.arange(1, 5), own.words.view(np.int64)
        rows = [
            (GRAMS, 0 * four, four, np.array([kinds(own.n[:, h]) for h in (0, 1)]).T),
            (PAIRS, 0 * four, four, np.array([kinds(own.pair_n[~own.hot, h]) for h in (0, 1)]).T),
            (WORDS, 0 * words.astype(np.int64), word[words], own.word_n[words]),
            (HOT, word[own.pair_v[pairs]], word[own.pair_w[pairs]], own.pair_n[pairs]),
        ]
        v, w, n = (np.concatenate([r[i] for r in rows]) for i in (1, 2, 3))
        kind = np.repeat(np.array([r[0] for r in rows], np.int32), [len(r[1]) for r in rows])
        at = [pa.array([k.as_py()] * len(v), k.type) for k in key]
        return pa.table(
            [*at, *(pa.array(np.ascontiguousarray(x)) for x in (kind, v, w, n[:, 0], n[:, 1]))],
            [*GROUP, "kind", "v", "w", "n0", "n1"],
        )

    schema = "language_key long, bucket int, kind int, v long, w long, n0 long, n1 long"
    return blocks.groupBy(GROUP).applyInArrow(count, schema)


def word_counts(docs: DataFrame) -> DataFrame:
    """language_key, u, v, w and their counts in each half of the texts."""
    dealt = deal(docs)

    def count(key, table):
        own = Counted(table.column("block"), dealt.hot)
        columns = [own.words[x].view(np.int64) for x in (own.u, own.v, own.w)]
        columns += [np.ascontiguousarray(own.n[:, h]) for h in (0, 1)]
        names = ["language_key", "u", "v", "w", "n0", "n1"]
        return pa.table([pa.array([key[0].as_py()] * len(own.u), pa.int64()), *map(pa.array, columns)], names)

    schema = "language_key long, u long, v long, w long, n0 long, n1 long"
    rounds = [word_blocks(docs, dealt, r).groupBy(GROUP).applyInArrow(count, schema) for r in range(ROUNDS)]
    return reduce(DataFrame.unionAll, rounds)


@dataclass
class Totals:
    """Of one language and half: discounts by order, and what of the 1-grams and the hot words v is known
    of all groups: sum of the counts and of their discounts."""

    discount: dict[int, np.ndarray]
    words: tuple[float, float, int]
    hot: dict[int, tuple[float, float]]


def totals(counts: DataFrame, words: DataFrame, hot: DataFrame) -> dict[int, list[Totals]]:
    """By language, for each half; one row per language, or language and hot word, comes to the driver."""
    facts = [f(c) for c in ("n0", "n1") for f in FACTS]
    one = {r[0]: r[1:] for r in words.groupBy("language_key").agg(*facts).collect()}
    of_hot = {r[0]: r[1:] for r in hot.groupBy("language_key").agg(*facts).collect()}
    each_hot = hot.groupBy("language_key", "v").agg(*facts).collect()
    four = counts.filter(F.col("kind").isin(PAIRS, GRAMS)).groupBy("language_key", "kind", "w")
    table = {(r[0], r[1], r[2]): r[3:] for r in four.agg(F.sum("n0"), F.sum("n1")).collect()}
    out: dict[int, list[Totals]] = {}
    for language, of_words in one.items():
        for half in (0, 1):
            own = slice(len(FACTS) * half, len(FACTS) * (half + 1))
            total, seen, *one_to_four = of_words[own]
            spent = lambda seen, n, cut: float(np.dot([n[0], n[1], seen - n[0] - n[1]], cut[1:]))
            discount = {1: discounts_of(one_to_four)}
            for order, kind, more in ((2, PAIRS, of_hot.get(language)), (3, GRAMS, None)):
                more = more[own][2:] if more else [0] * 4
                found = [table.get((language, kind, i), (0, 0))[half] for i in range(1, 5)]
                discount[order] = discounts_of([a + b for a, b in zip(found, more, strict=True)])
            by_word = {
                word: (t, spent(s, n, discount[2]))
                for of, word, *f in each_hot if of == language
                for t, s, *n in [f[own]]
            }
            known = (total, spent(seen, one_to_four, discount[1]), seen)
            out.setdefault(language, []).append(Totals(discount, known, by_word))
    return out


#: Of a column of counts: their sum, how many are above 0, and how many are 1, 2, 3 and 4.
FACTS = [
    lambda c: F.sum(c),
    lambda c: F.count_if(F.col(c) > 0),
    *(lambda c, i=i: F.count_if(F.col(c) == i) for i in range(1, 5)),
]


def log_probabilities(own: Counted, half: int, known: Totals, word_n: np.ndarray, pair_n: np.ndarray) -> np.ndarray:
    """Of each gram of a group by the model of one half, whose counts before words and pairs are given."""
    d = {order: x for order, x in known.discount.items()}

    def share(n, order, at, size, below, totals=()):
        cut = d[order][np.minimum(n, 3)]
        total, spent = np.bincount(at, n, size), np.bincount(at, cut, size)
        for i, (t, s) in totals:
            total[i], spent[i] = t, s
        seen = total > 0
        total[~seen] = 1
        return np.where(seen[at], (n - cut) / total[at] + (spent / total)[at] * below, below)

    total, spent, words = known.words
    one = np.full(len(own.words), 1 / (words + 1))
    if total:
        one = (word_n - d[1][np.minimum(word_n, 3)]) / total + spent / total * one
    word = own.words.view(np.int64)
    hot = [(i, known.hot[word[i]]) for i in np.unique(own.pair_v[own.hot]) if word[i] in known.hot]
    two = share(pair_n, 2, own.pair_v, len(own.words), one[own.pair_w], hot)
    return np.log(share(own.n[:, half], 3, own.context, int(own.context.max()) + 1, two[own.pair]))


def group_scores(blocks: DataFrame, answers: DataFrame, dealt: Deal, known: dict[int, list[Totals]]) -> DataFrame:
    """language_key, slice, sums: the keys of some texts, the sum over each text's grams in a group by the model of
    the half that does not hold the text, and their number. ``answers`` has each group's counts that other groups
    add to. Texts are dealt into slices by their keys."""
    slices = SLICES * dealt.groups
    schema = pa.schema([("language_key", pa.int64()), ("slice", pa.int32()), ("sums", pa.binary())])

    def score(key, table, answer):
        if not table.num_rows:
            return schema.empty_table()
        own = Counted(table.column("block"), dealt.hot)
        v, w, *n = (answer.column(c).to_numpy() for c in ("v", "w", "n0", "n1"))
        v, w, n, word = v.view(np.uint64), w.view(np.uint64), np.stack(n, axis=1), answer.column("kind").to_numpy() == WORDS
        own.word_n[np.searchsorted(own.words, w[word])] = n[word]
        # Pairs stand in the order of their words.
        size = np.int64(len(own.words))
        pair = np.searchsorted(own.words, v[~word]) * size + np.searchsorted(own.words, w[~word])
        own.pair_n[np.searchsorted(own.pair_v * size + own.pair_w, pair)] = n[~word]
        language = key[0].as_py()
        log_p = [log_probabilities(own, h, known[language][h], own.word_n[:, h], own.pair_n[:, h]) for h in (0, 1)]
        texts, at, count = np.unique(own.keys, return_inverse=True, return_counts=True)
        each = np.where(own.keys & 1, log_p[0][own.gram], log_p[1][own.gram])
        total = np.bincount(at, each, len(texts))
        part = (W.mix(texts.view(np.uint64)) % np.uint64(slices)).astype(np.int32)
        order = np.argsort(part, kind="stable")
        found, starts = np.unique(part[order], return_index=True)
        sums = [b"".join(x[rows].tobytes() for x in (texts, total, count)) for rows in np.split(order, starts[1:])]
        return pa.table([np.full(len(found), language), found, pa.array(sums, pa.binary())], schema=schema)

    grouped = blocks.groupBy(GROUP).cogroup(answers.groupBy(GROUP))
    return grouped.applyInArrow(score, "language_key long, slice int, sums binary")


def text_sums(scored: DataFrame) -> DataFrame:
    """text_key, language_key, log_p, n: the sums of all groups."""

    def add(key, table):
        parts = [np.frombuffer(x.as_buffer(), np.int64).reshape(3, -1) for x in table.column("sums")]
        texts, log_p, n = np.concatenate(parts, axis=1)
        texts, at = np.unique(texts, return_inverse=True)
        sums = [np.bincount(at, x, len(texts)) for x in (log_p.view(np.float64), n)]
        names = ["text_key", "language_key", "log_p", "n"]
        return pa.table([texts, np.full(len(texts), key[0].as_py()), sums[0], sums[1].astype(np.int64)], names)

    schema = "text_key long, language_key long, log_p double, n long"
    return scored.groupBy("language_key", "slice").applyInArrow(add, schema)


def word_scores(docs: DataFrame, dealt: Deal) -> DataFrame:
    """text_key, language_key, log_perplexity of every text. Grams are dealt in rounds, once to be counted and once
    to be judged by the counts of all, and leave the disk with their round. Copies of a text add to both sums alike."""
    rounds = range(ROUNDS)
    unite = lambda parts: reduce(DataFrame.unionAll, parts)
    counts = unite(
        [passing(group_counts(word_blocks(docs, dealt, r), dealt), f"group-counts-{r}") for r in rounds]
    )
    add = [F.sum("n0").alias("n0"), F.sum("n1").alias("n1"), F.collect_list("bucket").alias("buckets")]
    hot = passing(counts.filter(F.col("kind") == HOT).groupBy("language_key", "v", "w").agg(*add), "hot-pairs")
    before = [F.count_if(F.col(c) > 0).alias(c) for c in ("n0", "n1")]
    more = hot.groupBy("language_key", "w").agg(*before).withColumn("bucket", F.lit(None).cast("int"))
    names = ["language_key", "w", "n0", "n1", "bucket"]
    words = counts.filter(F.col("kind") == WORDS).select(names).unionAll(more.select(names))
    words = passing(words.groupBy("language_key", "w").agg(*add, F.count("*").alias("rows")), "words")
    known = totals(counts, words, hot)
    forget(counts)
    # A count that one group alone adds to is its own.
    told = words.filter("rows > 1").select("language_key", F.lit(WORDS).alias("kind"), F.lit(0).cast("long").alias("v"), "w", "n0", "n1", "buckets")
    told = told.unionAll(hot.select("language_key", F.lit(HOT).alias("kind"), "v", "w", "n0", "n1", "buckets"))
    sums = []
    for r in rounds:
        answers = told.withColumn("bucket", F.explode("buckets")).drop("buckets")
        answers = answers.filter(F.floor(F.col("bucket") / dealt.groups) == r)
        own = group_scores(word_blocks(docs, dealt, r), answers, dealt, known)
        sums.append(passing(text_sums(own), f"text-sums-{r}"))
    summed = unite(sums).groupBy("text_key", "language_key").agg(F.sum("log_p").alias("log_p"), F.sum("n").alias("n"))
    return summed.select("text_key", "language_key", (-F.col("log_p") / F.col("n")).alias("log_perplexity"))


@dataclass
class Fitted:
    """The letter model, and the texts' scores by the word models."""

    letters: Model
    words: DataFrame


def fit(docs: DataFrame) -> Fitted:
    """The models of all texts."""
    return Fitted(letter_model(docs), word_scores(docs, deal(docs)))


def scores(docs: DataFrame, model: Fitted) -> DataFrame:
    """``docs``, whose texts ``fit`` has seen, with the base counts, half, log_perplexity and spelling."""
    sent = docs.sparkSession.sparkContext.broadcast(model.letters)
    keys = {"text_key": text_key(), "language_key": language_key()}
    own = docs.withColumns(keys).withColumn("half", F.col("text_key").bitwiseAND(F.lit(1)))
    own = own.withColumn(
        "framed", F.struct(F.coalesce("text", F.lit("")).alias("text"), F.coalesce("lang", F.lit("")).alias("lang"))
    )
    at = own.columns.index("framed")
    new = T.StructType.fromDDL(
        "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, spelling double"
    )

    def score(batches):
        for batch in batches:
            both = batch.column(at)
            for rows in W.pieces(both.field(0), 4 * W.SLICE_BYTES):
                part = batch.slice(rows.start, rows.stop - rows.start)
                texts, languages = part.column(at).flatten()
                out, plain = np.zeros(len(texts)), texts.to_pylist()
                for name, numbers in by_language(languages.to_pylist(), plain):
                    gram, text = grams([plain[i] for i in numbers])
                    unique, which = np.unique(gram, return_inverse=True)
                    p = sent.value.log_probability(name, unique)[which]
                    out[numbers] = -np.bincount(text, p, len(numbers))
                counts = base_counts(texts)
                out /= np.maximum(counts[0].to_numpy(), 1)
                yield pa.RecordBatch.from_arrays([*part.columns, *counts, pa.array(out)], schema.names)

    schema = T.StructType([*own.schema.fields, *new.fields])
    scored = own.mapInArrow(score, schema).drop("framed")
    return scored.join(model.words, [*keys], "left").drop(*keys)


def judge(scored: DataFrame) -> DataFrame:
    """``scored`` with base_failed, perplexity and kept."""
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words")
    )
    scored = scored.withColumn("base_failed", failed).withColumn("language", F.coalesce("lang", F.lit("")))
    inside = F.lit(True)
    for score, by in (("log_perplexity", ["language", "half"]), ("spelling", ["language"])):
        low, high = f"{score}_low", f"{score}_high"
        scored = scored.join(band(scored, score, by).toDF(*by, low, high), by, "left")
        inside = inside & (F.col(score) <= F.col(high))
    # Passages that other texts hold too make the word model's score small: no fault of the language.
    inside = inside & (F.col("spelling") >= F.col("spelling_low"))
    return scored.withColumn("perplexity", F.exp("log_perplexity")).withColumn(
        "kept", ~F.col("base_failed") & F.coalesce(inside, F.lit(False))
    )


def band(scored: DataFrame, score: str, by: list[str]) -> DataFrame:
    """Lowest and highest ``score`` that is kept, per ``by``."""
    bins = (
        scored.filter("not base_failed")
        .groupBy(*by, F.round(F.col(score) / BIN).alias("bin"))
        .agg(F.count("*").alias("n"))
    )
    # One row per group and occupied bin; the bins of a score are bounded by its range.
    quartiles = bins.groupBy(by).agg(F.expr("percentile(bin, array(0.25, 0.75), n)").alias("q"))
    low, high = F.col("q")[0] * BIN, F.col("q")[1] * BIN
    reach = F.greatest(FENCE * (high - low), F.lit(LEAST_WIDTH))
    return quartiles.select(*by, low - reach, high + reach)


def op3_perplexity(spark, sf_dir: str) -> DataFrame:
    """Base counts and perplexity verdict of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang", "text")
    scored = staged(scores(docs, fit(docs)).drop("text"), "perplexity")
    return judge(scored).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "perplexity", "lang",
    )
