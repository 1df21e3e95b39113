"""Quality classifier: hashed word n-grams, logistic regression, follow-the-regularised-leader.

Features of a text are hashed into ``DIM`` slots: words, word pairs, and runs of one to three word
forms. A form is what is left of a word when letters lose their identity (case, digits and signs at
both ends, a length class, "same as the word before"). A slot's value is its share of the text's
n-grams of that family, square-rooted, so long and short texts weigh alike.

Training is a sequential pass of the per-coordinate leader update over a bounded sample of labelled
rows (``SAMPLE`` rows, lowest hashes of the id first; the bound is the documented parameter). Rows whose
``crc32(doc_id) % 4 == 2`` never train. Scoring is one sparse dot product per text over all texts.

Edge cases: NULL and empty texts have no features and score as the bias alone. A NULL doc_id is
scored, belongs to no fold and has no label. Labels that are NULL are ignored; of several labels of one
id each trains. Without any label the score is 0.5 for all. Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm import words as W

DIM = 1 << 18
SAMPLE = 8192
EPOCHS = 3
FOLDS, HELD_OUT = 4, 2
THRESHOLD = 0.7
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.02, 0.1
FAMILIES = ("word", "pair", "form", "form pair", "form triple")

# Byte classes of a form: lower case, upper case, digit, other letters, and each sign by itself.
FORM = np.arange(256, dtype=np.uint64)
FORM[97:123], FORM[65:91], FORM[48:58], FORM[128:] = 1, 2, 3, 1


def fold(doc_id: str) -> F.Column:
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % FOLDS


def features(part: W.Slice) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, slot and value of every feature of a slice, sorted by row and slot."""
    found = W.words(part)
    data, size = part.data, found.ends - found.starts
    at = lambda i: FORM[data[np.clip(i, 0, max(len(data) - 1, 0))]]
    same = np.zeros(len(size), np.uint64)
    same[1:] = (found.hash[1:] == found.hash[:-1]) & (found.row[1:] == found.row[:-1])
    form = at(found.starts)
    for one in (
        at(np.minimum(found.starts + 1, found.ends - 1)),
        at(np.maximum(found.ends - 2, found.starts)),
        at(found.ends - 1),
        np.minimum(size // 3, 5).astype(np.uint64),
        same,
    ):
        form = W.mix(form * W.MULTIPLIERS[2] + one)
    forms = W.Words(found.starts, found.ends, found.row, form, found.per_row)
    rows, slots, values = [], [], []
    for family, (source, k) in enumerate(((found, 1), (found, 2), (forms, 1), (forms, 2), (forms, 3))):
        hashed, first = W.windows(source, k)
        slot = (W.mix(hashed + np.uint64(family + 1)) % np.uint64(DIM)).astype(np.int64)
        key, count = np.unique(found.row[first] * DIM + slot, return_counts=True)
        row = key // DIM
        rows.append(row)
        slots.append(key % DIM)
        values.append(np.sqrt(count / np.bincount(row, count, part.n)[row]))
    return np.concatenate(rows), np.concatenate(slots), np.concatenate(values)


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -35, 35)))


class Leader:
    """Follow-the-regularised-leader weights; the last slot is the bias, which has no L1 term."""

    def __init__(self) -> None:
        self.z, self.n = np.zeros(DIM + 1), np.zeros(DIM + 1)
        self.l1 = np.full(DIM + 1, L1)
        self.l1[DIM] = 0

    def weights(self, slots: np.ndarray | slice) -> np.ndarray:
        z, l1 = self.z[slots], self.l1[slots]
        lead = np.where(np.abs(z) <= l1, 0, z - np.sign(z) * l1)
        return -lead / ((BETA + np.sqrt(self.n[slots])) / ALPHA + L2)

    def learn(self, slots: np.ndarray, values: np.ndarray, label: float) -> None:
        w = self.weights(slots)
        g = (sigmoid(w @ values) - label) * values
        grown = np.sqrt(self.n[slots] + g * g) - np.sqrt(self.n[slots])
        self.z[slots] += g - grown / ALPHA * w
        self.n[slots] += g * g


def fit(rows: list[tuple[np.ndarray, np.ndarray, float]]) -> np.ndarray:
    """Weights from (slots, values, label) rows, in their order."""
    model = Leader()
    # Slots that collide within a row are merged, as an update touches each slot once.
    merged = []
    for slots, values, label in rows:
        own, at = np.unique(slots, return_inverse=True)
        sums = np.append(np.bincount(at, values, len(own)), 1.0).astype(np.float32)
        merged.append((np.append(own, DIM).astype(np.int32), sums, label))
    for _ in range(EPOCHS):
        for slots, values, label in merged:
            model.learn(slots, values, label)
    return model.weights(slice(None)).astype(np.float32)


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> np.ndarray:
    """Weights learnt from at most ``sample`` labelled rows outside the held-out fold."""
    own = labels.select(F.col("doc_id").alias("label_id"), F.col("quality").alias("label_is"))
    own = own.filter(F.col("label_is").isin(0, 1) & (fold("label_id") != HELD_OUT))
    own = own.orderBy(F.xxhash64("label_id"), "label_id", "label_is").limit(sample)
    texts = docs.select(F.col("doc_id").alias("text_id"), "text")
    rows = texts.join(own, F.col("text_id") == F.col("label_id")).select("text_id", "label_is", "text")

    def featurise(batches):
        for batch in batches:
            ids, labels_ = batch.column(0), batch.column(1)
            for part in W.slices(batch.column(2)):
                row, slot, value = features(part)
                order = np.argsort(row, kind="stable")
                cut = np.searchsorted(row[order], np.arange(part.n + 1))
                slot, value = slot[order].astype("<i4"), value[order].astype("<f4")
                span = slice(part.first, part.first + part.n)
                pieces = [slice(a, b) for a, b in zip(cut[:-1], cut[1:], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        ids[span],
                        labels_[span].cast(pa.float64()),
                        pa.array([slot[x].tobytes() for x in pieces], pa.binary()),
                        pa.array([value[x].tobytes() for x in pieces], pa.binary()),
                    ],
                    ["text_id", "label", "slots", "shares"],
                )

    def learn(table: pa.Table) -> pa.Table:
        # At most ``sample`` rows (more only if ids repeat); one task learns from them, as each update
        # builds on the one before, and only the weights leave it.
        keys = zip(*(table.column(c).to_pylist() for c in ("text_id", "label", "slots")), strict=True)
        order = sorted(enumerate(keys), key=lambda k: (k[1][0] * 2654435761 % (1 << 32), *k[1]))
        cell = lambda c, i: table.column(c)[i].as_buffer()
        learnt = fit(
            [
                (np.frombuffer(cell("slots", i), "<i4"), np.frombuffer(cell("shares", i), "<f4"), label)
                for i, (_, label, _) in order[:sample]
            ]
        )
        return pa.table({"weights": pa.array([learnt.tobytes()], pa.binary())})

    found = rows.mapInArrow(featurise, "text_id long, label double, slots binary, shares binary")
    together = found.withColumn("all", F.lit(True)).groupBy("all")
    learnt = together.applyInArrow(learn, "weights binary").collect()  # one row
    return np.frombuffer(bytes(learnt[0].weights), np.float32) if learnt else np.zeros(DIM + 1, np.float32)


def score(docs: DataFrame, weights: np.ndarray) -> DataFrame:
    """All columns of ``docs`` and ``quality_score``, 0 to 1; the weights are ``DIM + 1`` numbers."""
    sent = docs.sparkSession.sparkContext.broadcast(weights)

    def dot(texts):
        w = sent.value
        out = np.zeros(len(texts))
        for part in W.slices(texts):
            row, slot, value = features(part)
            out[part.first : part.first + part.n] = np.bincount(row, w[slot] * value, part.n)
        return [pa.array(sigmoid(out + w[DIM]))]

    return W.with_columns(docs, "text", dot, "quality_score double")


def op2_quality_classifier(spark, sf_dir: str) -> DataFrame:
    """Score every document; returns doc_id, held_out, score, predicted."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    weights = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = score(docs, weights)
    return scored.select(
        "doc_id",
        (fold("doc_id") == HELD_OUT).alias("held_out"),
        F.col("quality_score").alias("score"),
        (F.col("quality_score") >= THRESHOLD).cast("int").alias("predicted"),
    )
