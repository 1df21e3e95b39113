"""Ranked lexical search by the Best Position Algorithm over impact lists.

A score is a sum of integer impacts, one for each term of an item: the term's weight times its saturated
frequency in the document. The documents are cut into segments of bounded size. A segment holds, for
every term of the items, the documents with it, and is written to the shared folder; corpus statistics
are summed from the segments. For the search a segment's list of a term is put in order of impact, and
the lists of an item are read from the top in parallel. Each document met is looked up at once in all
lists (direct access), so its score is final, and its place in every list is marked as seen. A list's
best position is the last one before its first unseen place; no unseen document can score more than
the sum of the impacts at the best positions (0 where a list is seen to its end). Reading stops when
that sum is strictly below the score of the k-th document found. A task carries the best documents of an
item from one segment to the next, so later segments stop sooner.

Only statistics of the items' terms and the ``k`` best documents of each task and item leave a task.
Items are taken in blocks of about ``BLOCK_BYTES`` of text, sent to the tasks.

Edge cases: a NULL or empty text has no terms: such documents are in no statistic, such items get no
rows. Every row is a document, every row an item of its own, ids repeated or not; NULL ids come last
among equal scores. Documents that score 0 are not listed. Empty tables give no rows. Extra columns are
ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from skyledger.llm.store import staged

K = 10
BLOCK_BYTES = 1 << 24
#: A segment is closed at so many documents or entries.
SEGMENT_DOCS, SEGMENT_ENTRIES = 1 << 15, 1 << 20
#: Places that are read from every list before the threshold is first looked at; doubled each time.
FIRST_DEPTH = 8

#: Letters and digits of ASCII, lower-cased, and all bytes of other characters; the rest are blanks.
TERM_BYTES = bytes(ord(c.lower()) if c.isalnum() else b if b > 127 else 32 for b, c in enumerate(map(chr, range(256))))

SEGMENT = "n_docs long, n_terms long, ids array<long>, sizes array<long>, terms binary, docs binary, times binary"


def words(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(TERM_BYTES).split()


def impacts(weight: np.ndarray, times: np.ndarray, size: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """Impact of each entry: weight * (10**9 tf div (1000 tf + 8 m)), m from the document's length."""
    if len(size) and 75 * int(size.max()) * n_docs >= 1 << 63:
        length = np.array([25 + 75 * n * n_docs // n_terms for n in size.tolist()], np.int64)
    else:
        length = 25 + 75 * size * n_docs // n_terms
    return weight * (1_000_000_000 * times // (1000 * times + 8 * length))


class Lists:
    """The impact lists of a segment: entries in order of term and document for direct access, and in
    order of term, falling impact and document for reading."""

    def __init__(self, term: np.ndarray, doc: np.ndarray, impact: np.ndarray, n_docs: int, n_terms: int) -> None:
        useful = impact > 0
        term, doc, impact = term[useful], doc[useful], impact[useful]
        order = np.lexsort((doc, term))
        self.n = n_docs
        self.key, self.impact = term[order] * n_docs + doc[order], impact[order]
        self.doc = doc[order]
        self.borders = np.searchsorted(self.key, np.arange(n_terms + 1) * n_docs)
        self.by_impact = np.lexsort((self.doc, -self.impact, term[order]))
        self.place = np.empty(len(order), np.int64)
        self.place[self.by_impact] = np.arange(len(order))

    def look_up(self, term: np.ndarray, doc: np.ndarray) -> np.ndarray:
        """Entry of each term (rows) and document (columns), or -1."""
        if not len(self.key):
            return np.full((len(term), len(doc)), -1)
        key = term[:, None] * self.n + doc
        at = np.searchsorted(self.key, key)
        at[at == len(self.key)] = 0
        return np.where(self.key[at] == key, at, -1)


def best_positions(lists: Lists, term: np.ndarray, times: np.ndarray, k: int, floor: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Documents of a segment and their scores: all that can be among the k best, given that k documents
    elsewhere score ``floor`` or more (0: none known), and how many places were read."""
    first, last = lists.borders[term], lists.borders[term + 1]
    there = last > first
    term, times, first, last = term[there], times[there], first[there], last[there]
    size = last - first
    seen = [np.zeros(n, bool) for n in size]
    best = np.zeros(len(term), np.int64)  # places seen without a gap
    met = np.zeros(lists.n, bool)
    docs, scores = [], []
    depth, until, read = 0, FIRST_DEPTH, 0
    kth = floor
    while len(term) and depth < size.max():
        ahead = [lists.by_impact[a + depth : min(a + until, b)] for a, b in zip(first, last, strict=True)]
        read += sum(map(len, ahead))
        new = np.unique(lists.doc[np.concatenate(ahead)])
        new = new[~met[new]]
        met[new] = True
        entry = lists.look_up(term, new)
        found = entry >= 0
        docs.append(new)
        scores.append((np.where(found, lists.impact[entry], 0) * times[:, None]).sum(0))
        threshold = 0
        for i, own in enumerate(seen):
            own[lists.place[entry[i][found[i]]] - first[i]] = True
            if best[i] < size[i]:
                gap = np.argmin(own[best[i] :])
                best[i] = size[i] if own[best[i] + gap] else best[i] + gap
            if best[i] < size[i]:
                threshold += int(times[i] * lists.impact[lists.by_impact[first[i] + best[i] - 1]])
        so_far = np.concatenate(scores)
        if len(so_far) >= k:
            kth = max(kth, int(np.partition(so_far, -k)[-k]))
        if threshold < kth:
            break
        depth, until = until, 2 * until
    if not docs:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), read
    docs, scores = np.concatenate(docs), np.concatenate(scores)
    high = (scores >= kth) & (scores > 0)
    return docs[high], scores[high], read


def index(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """Segments with the documents that hold terms of the vocabulary, and the sizes of all."""
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)
    most_docs, most_entries = SEGMENT_DOCS, SEGMENT_ENTRIES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = sent.value
        schema = pa.schema(
            [("n_docs", pa.int64()), ("n_terms", pa.int64())]
            + [(c, pa.list_(pa.int64())) for c in ("ids", "sizes")]
            + [(c, pa.binary()) for c in ("terms", "docs", "times")]
        )

        def closed():
            cells = [np.array(x, "<i4").tobytes() for x in (terms, at, times)]
            return pa.RecordBatch.from_arrays(
                [pa.array([x], f.type) for x, f in zip((n_docs, n_terms, ids, sizes, *cells), schema, strict=True)],
                schema=schema,
            )

        n_docs = n_terms = 0
        ids, sizes, terms, at, times = [], [], [], [], []
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                own = words(text.as_py())
                if not own:
                    continue
                n_docs += 1
                n_terms += len(own)
                counts = Counter(own)
                known = number.keys() & counts.keys()
                if not known:
                    continue
                at += [len(ids)] * len(known)
                terms += map(number.__getitem__, known)
                times += map(counts.__getitem__, known)
                ids.append(doc_id)
                sizes.append(len(own))
                if len(ids) >= most_docs or len(at) >= most_entries:
                    yield closed()
                    n_docs = n_terms = 0
                    ids, sizes, terms, at, times = [], [], [], [], []
        if n_docs:
            yield closed()

    found = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, SEGMENT)
    return staged(found, "impact-lists")


def integers(cell: bytes) -> np.ndarray:
    return np.frombuffer(cell, "<i4").astype(np.int64)


def statistics(segments: DataFrame, n_vocabulary: int) -> tuple[int, int, np.ndarray]:
    """Number of documents with terms, number of terms, and documents with each term of the vocabulary."""

    def count(batches):
        held = np.zeros(n_vocabulary, np.int64)
        for batch in batches:
            for cell in batch.column(0).to_pylist():
                held += np.bincount(integers(cell), minlength=n_vocabulary)
        term = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(term), pa.array(held[term])], ["term", "n"])

    n_docs, n_terms = segments.agg(F.sum("n_docs"), F.sum("n_terms")).first()
    held = np.zeros(n_vocabulary, np.int64)
    by_term = segments.select("terms").mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n"))
    for term, n in by_term.collect():  # bounded by the terms of a block of items
        held[term] = n
    return n_docs or 0, n_terms or 0, held


def search_block(docs: DataFrame, items: list[tuple], id_type: T.DataType, k: int) -> DataFrame:
    """The k best documents of each item of a block."""
    spark = docs.sparkSession
    asked = [Counter(words(text)) for _, text in items]
    vocabulary = {w: i for i, w in enumerate(sorted(set().union(*asked)))}
    segments = index(docs, vocabulary)
    n_docs, n_terms, held = statistics(segments, len(vocabulary))
    weight = [math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1))) for df in held.tolist()]
    needed = [
        (np.array([vocabulary[w] for w in own], np.int64), np.array(list(own.values()), np.int64)) for own in asked
    ]
    sent = spark.sparkContext.broadcast((np.array(weight, np.int64), needed, [i for i, _ in items]))
    arrow_id = to_arrow_type(id_type)

    def run(batches):
        weight, needed, item_ids = sent.value
        none = np.iinfo(np.int64).max
        top = [(np.zeros(0, np.int64),) * 3 for _ in needed]  # scores, ids, whether the id is NULL
        for batch in batches:
            for row in range(batch.num_rows):
                cell = lambda c: batch.column(c)[row]  # noqa: B023,E731
                ids, size = cell("ids").values, cell("sizes").values.to_numpy()
                is_null = ids.is_null().to_numpy(zero_copy_only=False)
                ids = ids.fill_null(none).to_numpy()
                term, doc, times = (integers(cell(c).as_py()) for c in ("terms", "docs", "times"))
                impact = impacts(weight[term], times, size[doc], n_docs, n_terms)
                lists = Lists(term, doc, impact, max(len(ids), 1), len(weight))
                for i, (own, often) in enumerate(needed):
                    scores, known, nulls = top[i]
                    floor = int(scores[-1]) if len(scores) >= k else 0
                    at, new, _ = best_positions(lists, own, often, k, floor)
                    if len(at):
                        scores = np.concatenate([scores, new])
                        known = np.concatenate([known, ids[at]])
                        nulls = np.concatenate([nulls, is_null[at]])
                        order = np.lexsort((known, nulls, -scores))[:k]
                        top[i] = scores[order], known[order], nulls[order]
        item = np.repeat(np.arange(len(needed)), [len(t[0]) for t in top])
        scores, known, nulls = (np.concatenate([t[c] for t in top]) for c in range(3)) if top else [item] * 3
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(item),
                pa.array([item_ids[i] for i in item.tolist()], arrow_id),
                pa.array(known, pa.int64(), mask=nulls.astype(bool)),
                pa.array(scores),
            ],
            ["item", "item_id", "doc_id", "score"],
        )

    fields = [("item", T.LongType()), ("item_id", id_type), ("doc_id", T.LongType()), ("score", T.LongType())]
    found = segments.mapInArrow(run, T.StructType([T.StructField(*f) for f in fields]))
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("item_id", "rank", "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, k: int = K, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """item_id, rank, doc_id and score of the k documents that score highest for each item."""
    items = items.select("item_id", "text").filter(F.col("text") != "")
    size = items.agg(F.sum(F.octet_length("text") + 32)).first()[0] or 0
    blocks = max(-(-size // block_bytes), 1)
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))
    id_type = items.schema["item_id"].dataType
    found = [
        search_block(docs, [tuple(r) for r in items.filter(block == b).collect()], id_type, k)  # one block of bounded size
        for b in range(blocks)
    ]
    return reduce(DataFrame.unionByName, found)


def op11_lexical_search(spark, sf_dir: str) -> DataFrame:
    """Rank all documents for each benchmark item; returns item_id, rank, doc_id, score."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return search(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
