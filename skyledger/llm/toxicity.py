"""Toxicity: a factorization machine over hashed terms.

Terms of a text are its words, word pairs, and the runs of ``RUNS`` bytes inside its words, A-Z
lower-cased and hashed into ``2 ** BITS`` slots; a term is there or not. A slot counts as informative if
its chi-squared against the label is at least ``LEAST_CHI`` in ``LEAST_TEXTS`` or more sampled texts;
the ``KEPT`` most informative ones make the model. A text with m of them gives each the value
``m ** -0.25``. The machine scores

    bias + sum(w[i] x[i]) + sum over pairs i < j of (v[i] . v[j]) x[i] x[j]

where the pair sum is half of (sum(v x))² - sum((v x)²) for each of ``FACTORS`` coordinates, so pairs
are never listed. The factors carry what no single weight can: terms that are harmless alone and toxic
together, such as an insult beside the mention of a group.

Training is mini-batch adaptive gradient descent over a bounded sample: the ``SAMPLE`` labelled rows
with the lowest hashes of the id, of texts up to ``LONGEST`` bytes. Rows whose
``crc32(doc_id) % 5 == 0`` never train. Scoring runs over all texts, whole, at any length.

Edge cases: NULL and empty texts have no terms and score as the bias alone. A NULL doc_id is scored,
belongs to no fold and has no label. Labels other than 0 and 1 are ignored; of several labels of one id
each trains; a repeated row trains as often as it is there, within the sample. Without both labels the
score is 0.5 for all. An empty table gives none. Extra columns stay, except those named like new ones.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm import words as W

BITS = 20
RUNS = (4, 6, 8)
FACTORS = 8
KEPT = 8192
LEAST_CHI, LEAST_TEXTS = 20.0, 5
SAMPLE, LONGEST = 8192, 1 << 17
EPOCHS, BATCH, RATE, L2 = 12, 32, 0.1, 1e-3
FOLDS, HELD_OUT = 5, 0
THRESHOLD = 0.5


def fold(doc_id: str) -> F.Column:
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % FOLDS


def families(part: W.Slice) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row and slot of every term of a slice, family by family; a term that repeats is there again."""

    def slot(hashed: np.ndarray, family: int) -> np.ndarray:
        return (W.mix(hashed + np.uint64(family)) >> np.uint64(64 - BITS)).astype(np.int32)

    found = W.words(part, lower=True)
    yield found.row, slot(found.hash, 1)
    hashed, first = W.windows(found, 2)
    yield found.row[first], slot(hashed, 2)
    size = found.ends - found.starts
    for k in RUNS:
        n = np.maximum(size - k + 1, 0)
        at = np.repeat(found.starts - np.cumsum(n) + n, n) + np.arange(n.sum())
        yield np.repeat(found.row, n), slot(part.hashes(at, at + k, lower=True), k + 10)


def terms(part: W.Slice, number: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Rows and distinct slots of a slice, sorted. With ``number``, a table over all slots, the numbers
    of the model's slots instead; the others have -1 there and are left out."""
    out = []
    for row, slot in families(part):
        if number is not None:
            slot = number[slot]
            known = slot >= 0
            row, slot = row[known], slot[known]
        out.append(row.astype(np.int64) << BITS | slot)
    key = np.unique(np.concatenate(out))
    return key >> BITS, key & (1 << BITS) - 1


@dataclass
class Machine:
    """Slots of the model in order, their weights and factors, and the bias."""

    slots: np.ndarray
    weights: np.ndarray
    factors: np.ndarray
    bias: float = 0.0

    @classmethod
    def blank(cls, slots: np.ndarray, seed: int = 1) -> Machine:
        start = np.random.default_rng(seed).normal(0, 0.05, (len(slots), FACTORS))
        return cls(slots, np.zeros(len(slots)), start)

    def numbers(self) -> np.ndarray:
        """Table from a slot to its number in the model, -1 for the rest."""
        table = np.full(1 << BITS, -1, np.int32)
        table[self.slots] = np.arange(len(self.slots), dtype=np.int32)
        return table

    def sums(self, row: np.ndarray, own: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Score before the sigmoid of n rows, the value of each entry, and the factor sums of the rows."""
        x = np.maximum(np.bincount(row, minlength=n), 1)[row] ** -0.25
        v = self.factors[own] * x[:, None]
        together = np.stack([np.bincount(row, v[:, f], n) for f in range(FACTORS)], 1)
        alone = np.bincount(row, (v * v).sum(1), n)
        z = self.bias + np.bincount(row, self.weights[own] * x, n) + ((together**2).sum(1) - alone) / 2
        return z, x, together

    def score(self, row: np.ndarray, own: np.ndarray, n: int) -> np.ndarray:
        return sigmoid(self.sums(row, own, n)[0])


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -35, 35)))


def informative(slots: list[np.ndarray], label: np.ndarray) -> np.ndarray:
    """The most informative slots, in order, by chi-squared of presence against the label."""
    seen, toxic = np.zeros(1 << BITS), np.zeros(1 << BITS)
    for own, is_toxic in zip(slots, label, strict=True):
        seen[own] += 1
        toxic[own] += is_toxic
    n, share = len(label), label.mean()
    apart = (toxic - seen * share) ** 2
    with np.errstate(divide="ignore", invalid="ignore"):
        chi = n * apart / (share * (1 - share) * seen * (n - seen))
    chi = np.where(seen < LEAST_TEXTS, 0, np.nan_to_num(chi, nan=0, posinf=n))
    best = np.argsort(-chi, kind="stable")[:KEPT]
    return np.sort(best[chi[best] >= LEAST_CHI])


def fit(slots: list[np.ndarray], label: np.ndarray, epochs: int = EPOCHS) -> Machine:
    """A machine for texts given by their distinct slots and labels 0 or 1."""
    label = np.asarray(label, float)
    if not 0 < label.sum() < len(label):
        return Machine.blank(np.zeros(0, np.int64))
    model = Machine.blank(informative(slots, label))
    number = model.numbers()
    own = [number[s] for s in slots]
    own = [s[s >= 0] for s in own]
    grown_w, grown_v, grown_b = (np.full(s, 1e-3) for s in (len(model.slots), model.factors.shape, 1))
    order, rng = np.arange(len(label)), np.random.default_rng(2)
    for _ in range(epochs):
        rng.shuffle(order)
        for first in range(0, len(order), BATCH):
            some = order[first : first + BATCH]
            row = np.repeat(np.arange(len(some)), [len(own[i]) for i in some])
            at = np.concatenate([own[i] for i in some])
            z, x, together = model.sums(row, at, len(some))
            off = sigmoid(z) - label[some]
            used, back = np.unique(at, return_inverse=True)
            pull = off[row] * x
            dw = np.bincount(back, pull, len(used)) + L2 * model.weights[used]
            dv = np.zeros((len(used), FACTORS))
            np.add.at(dv, back, pull[:, None] * (together[row] - model.factors[at] * x[:, None]))
            dv += L2 * model.factors[used]
            db = off.sum()
            grown_w[used] += dw * dw
            grown_v[used] += dv * dv
            grown_b += db * db
            model.weights[used] -= RATE * dw / np.sqrt(grown_w[used])
            model.factors[used] -= RATE / 2 * dv / np.sqrt(grown_v[used])
            model.bias -= float(RATE * db / np.sqrt(grown_b[0]))
    return model


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Machine:
    """A machine learnt from at most ``sample`` labelled rows outside the held-out fold."""
    own = labels.select(F.col("doc_id").alias("label_id"), F.col("toxic").alias("label_is"))
    own = own.filter(F.col("label_is").isin(0, 1) & (fold("label_id") != HELD_OUT))
    own = own.orderBy(F.xxhash64("label_id"), "label_id", "label_is").limit(sample)
    texts = docs.select(F.col("doc_id").alias("text_id"), "text").filter(F.octet_length("text") <= LONGEST)
    rows = texts.join(own, F.col("text_id") == F.col("label_id")).select("text_id", "label_is", "text")

    def featurise(batches):
        for batch in batches:
            for part in W.slices(batch.column(2)):
                row, slot = terms(part)
                cut = np.searchsorted(row, np.arange(part.n + 1))
                slot = slot.astype("<i4")
                cells = [slot[a:b].tobytes() for a, b in zip(cut[:-1], cut[1:], strict=True)]
                span = slice(part.first, part.first + part.n)
                ids, label = batch.column(0)[span], batch.column(1)[span].cast(pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [ids, label, pa.array(cells, pa.binary())], ["text_id", "label", "slots"]
                )

    def learn(table: pa.Table) -> pa.Table:
        # At most ``sample`` rows (more only if ids repeat) in one task, since each update builds on the
        # one before; only the model leaves it.
        keys = list(zip(*(table.column(c).to_pylist() for c in ("text_id", "label", "slots")), strict=True))
        keys = sorted(keys, key=lambda k: (k[0] * 2654435761 % (1 << 32), *k))[:sample]
        model = fit([np.frombuffer(k[2], "<i4") for k in keys], np.array([k[1] for k in keys]))
        parts = (model.slots.astype("<i8"), model.weights, model.factors)
        return pa.table(
            {k: pa.array([v.tobytes()], pa.binary()) for k, v in zip(("s", "w", "v"), parts, strict=True)}
            | {"bias": pa.array([model.bias])}
        )

    found = rows.mapInArrow(featurise, "text_id long, label int, slots binary")
    together = found.withColumn("all", F.lit(True)).groupBy("all")
    learnt = together.applyInArrow(learn, "s binary, w binary, v binary, bias double").collect()  # one row
    if not learnt:
        return Machine.blank(np.zeros(0, np.int64))
    s, w, v, bias = learnt[0]
    factors = np.frombuffer(bytes(v)).reshape(-1, FACTORS)
    return Machine(np.frombuffer(bytes(s), "<i8"), np.frombuffer(bytes(w)), factors, bias)


def score(docs: DataFrame, model: Machine) -> DataFrame:
    """All columns of ``docs`` and ``toxicity``, 0 to 1. The model has at most ``KEPT`` slots."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def judge(texts):
        machine = sent.value
        number, out = machine.numbers(), np.zeros(len(texts))
        for part in W.slices(texts):
            row, own = terms(part, number)
            out[part.first : part.first + part.n] = machine.score(row, own, part.n)
        return [pa.array(out)]

    return W.with_columns(docs, "text", judge, "toxicity double")


def op13_toxicity(spark, sf_dir: str) -> DataFrame:
    """Score every document; returns doc_id, held_out, score, predicted."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    model = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score(docs, model).select(
        "doc_id",
        (fold("doc_id") == HELD_OUT).alias("held_out"),
        F.col("toxicity").alias("score"),
        (F.col("toxicity") >= THRESHOLD).cast("int").alias("predicted"),
    )
