"""Personal data: four exact patterns, and a character model that adds spans.

Base spans come from fixed patterns (``base_spans``), each found in linear time. The model is a
bidirectional LSTM over character classes with a CRF on top, written and trained in numpy. It learns
from labelled spans: windows of at most ``SAMPLE`` documents in which the base patterns label what they
find, and the same windows with values of many written forms set in (``FORMS``), each with its label.

A text is cut into windows of ``WINDOW`` characters every ``STRIDE``. Each window is decoded by itself;
spans of all windows of a text are then reconciled: whole ones before ones cut by a window's edge, longer
before shorter, earlier before later, none overlapping another or a base span. A span counts only if it
passes its kind's exact check (``plausible``: a card number needs its check digit), holds a digit or an at sign and at least ``LEAST_LENGTH`` characters; so a window without a digit and
without an at sign can add nothing and is not decoded, which changes no result.

Positions are code points, ends exclusive. Edge cases: NULL and empty texts have no spans. Repeated rows
are searched each. Without any document to learn from, the windows that forms are set in are blank.
Columns named like the results are replaced; others are kept.
"""

from __future__ import annotations

import random
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm import words as W

KINDS = ("email", "ip", "card", "phone")
WINDOW, STRIDE = 96, 48
SAMPLE = 256
STEPS, BATCH = 160, 48
HIDDEN = 10
LEAST_LENGTH = 7
TAGS = 1 + 2 * len(KINDS)  # outside, then begin and inside of each kind
SPAN_TYPE = "array<struct<kind: string, start: int, end: int, base: boolean>>"

EMAIL_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
EMAIL_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A digit run is taken whole: a match that fails at its start fails at its later digits too.
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

# Character classes; class 0 is the padding.
CLASSES = np.full(0x250, 2, np.int64)
CLASSES[:128] = 3
CLASSES[97:123], CLASSES[65:91], CLASSES[48:58], CLASSES[[9, 10, 13, 32]] = 1, 4, 5, 6
SIGNS = "@.+-()_%:/=\"'"
CLASSES[[ord(c) for c in SIGNS]] = np.arange(7, 7 + len(SIGNS))
N_CLASSES = 7 + len(SIGNS)


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches of the email pattern; each local part is read once, backwards from its sign."""
    out, free, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and EMAIL_LOCAL.match(text[start - 1]):
            start -= 1
        if start < at and (m := EMAIL_DOMAIN.match(text, at + 1)):
            out.append((start, m.end()))
            free = m.end()
        else:
            free = at + 1
        at = text.find("@", max(at + 1, free))
    return out


def n_digits(value: str) -> int:
    return sum(c in "0123456789" for c in value)


def base_spans(text: str) -> list[tuple[str, int, int]]:
    out = [("email", a, b) for a, b in emails(text)]
    if not any(d in text for d in "0123456789"):
        return out
    for m in IP.finditer(text):
        if all(len(p) <= 3 and int(p or 0) <= 255 for p in (q.lstrip("0") for q in m.group().split("."))):
            out.append(("ip", *m.span()))
    for m in CARD.finditer(text):
        digits = re.sub("[^0-9]", "", m.group())
        if 12 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", *m.span()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= n_digits(m.group()) <= 15:
                out.append(("phone", *m.span()))
    return out


def plausible(kind: str, value: str) -> bool:
    """Exact check of a span the model proposes."""
    if kind == "email":
        return "." in value.rpartition("@")[2].strip(".") and not value.startswith("@") and "@" in value
    if kind == "ip":
        parts = value.split(".")
        return len(parts) == 4 and all(p.isascii() and p.isdigit() and len(p) < 4 and int(p) < 256 for p in parts)
    if kind == "card":
        return 12 <= n_digits(value) <= 19 and luhn(re.sub("[^0-9]", "", value))
    return 9 <= n_digits(value) <= 15 and not re.search("[^0-9+() .-]", value)


def classes(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    return CLASSES[np.minimum(points, len(CLASSES) - 1)]


# --- the model -------------------------------------------------------------------------------------


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 0.5 * (np.tanh(0.5 * z) + 1)


def blank_model(seed: int = 3) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    model = {}
    for way in ("forward", "backward"):
        model[f"{way}_in"] = rng.normal(0, 0.4, (N_CLASSES, 4 * HIDDEN)).astype(np.float32)
        model[f"{way}_state"] = rng.normal(0, 0.3, (HIDDEN, 4 * HIDDEN)).astype(np.float32)
        model[f"{way}_in"][:, HIDDEN : 2 * HIDDEN] += 1
    model["out"] = rng.normal(0, 0.3, (2 * HIDDEN, TAGS)).astype(np.float32)
    model["bias"] = np.zeros(TAGS, np.float32)
    model["step"] = np.zeros((TAGS, TAGS), np.float32)
    return model


def allowed() -> np.ndarray:
    """0 where a tag may follow another, else a large negative number: inside follows its own kind."""
    out = np.zeros((TAGS, TAGS), np.float32)
    for k in range(len(KINDS)):
        inside = 2 + 2 * k
        out[:, inside] = -1e4
        out[[inside - 1, inside], inside] = 0
    return out


def run_lstm(model: dict, way: str, x: np.ndarray, keep: list | None = None) -> np.ndarray:
    """States (T, B, HIDDEN) along the first axis of the class numbers ``x`` (T, B)."""
    enter, state = model[f"{way}_in"], model[f"{way}_state"]
    h = c = np.zeros((x.shape[1], HIDDEN), np.float32)
    out = np.empty((*x.shape, HIDDEN), np.float32)
    for t in range(len(x)):
        z = enter[x[t]] + h @ state
        gates, g = sigmoid(z[:, : 3 * HIDDEN]), np.tanh(z[:, 3 * HIDDEN :])
        i, f, o = gates[:, :HIDDEN], gates[:, HIDDEN : 2 * HIDDEN], gates[:, 2 * HIDDEN :]
        before = (h, c)
        c = f * c + i * g
        lit = np.tanh(c)
        h = o * lit
        if keep is not None:
            keep.append((*before, i, f, o, g, lit))
        out[t] = h
    return out


def emissions(model: dict, x: np.ndarray, keep: tuple[list, list] | None = None):
    forward = run_lstm(model, "forward", x, keep and keep[0])
    backward = run_lstm(model, "backward", x[::-1], keep and keep[1])[::-1]
    states = np.concatenate([forward, backward], 2)
    return states @ model["out"] + model["bias"], states


def decode(model: dict, x: np.ndarray) -> np.ndarray:
    """Best tags (T, B) by Viterbi."""
    score, _ = emissions(model, x)
    step = (model["step"] + allowed())[None]
    best, back = score[0] + allowed()[0], []
    for t in range(1, len(x)):
        ways = best[:, :, None] + step
        back.append(ways.argmax(1))
        best = ways.max(1) + score[t]
    tags = np.empty(x.shape, np.int64)
    tags[-1] = best.argmax(1)
    for t in range(len(x) - 2, -1, -1):
        tags[t] = np.take_along_axis(back[t], tags[t + 1][:, None], 1)[:, 0]
    return tags


def log_sum(a: np.ndarray, axis: int) -> np.ndarray:
    top = a.max(axis, keepdims=True)
    return np.log(np.exp(a - top).sum(axis)) + top.squeeze(axis)


def crf_gradient(model: dict, score: np.ndarray, gold: np.ndarray):
    """Loss, and its gradients by the scores and the transitions, averaged over the batch."""
    step, (t_end, b, _) = model["step"] + allowed(), score.shape
    alpha = [score[0] + allowed()[0]]
    for t in range(1, t_end):
        alpha.append(log_sum(alpha[-1][:, :, None] + step, 1) + score[t])
    beta = [np.zeros((b, TAGS), np.float32)]
    for t in range(t_end - 1, 0, -1):
        beta.append(log_sum(step[None] + (score[t] + beta[-1])[:, None, :], 2))
    beta.reverse()
    total = log_sum(alpha[-1], 1)
    by_score = np.exp(np.stack(alpha) + np.stack(beta) - total[:, None])
    by_step = np.zeros_like(model["step"])
    for t in range(1, t_end):
        pair = alpha[t - 1][:, :, None] + step + (score[t] + beta[t] - total[:, None])[:, None, :]
        by_step += np.exp(pair).sum(0)
    hit = np.eye(TAGS, dtype=np.float32)[gold]
    truth = (score * hit).sum((0, 2)) + step[gold[:-1], gold[1:]].sum(0)
    np.subtract.at(by_step, (gold[:-1].ravel(), gold[1:].ravel()), 1)
    return float((total - truth).mean()), (by_score - hit) / b, by_step / b


def lstm_gradient(model: dict, way: str, x: np.ndarray, kept: list, by_h: np.ndarray):
    enter, state = np.zeros_like(model[f"{way}_in"]), np.zeros_like(model[f"{way}_state"])
    dh = dc = np.zeros((x.shape[1], HIDDEN), np.float32)
    for t in range(len(x) - 1, -1, -1):
        h0, c0, i, f, o, g, lit = kept[t]
        dh = dh + by_h[t]
        dc = dc + dh * o * (1 - lit * lit)
        dz = np.concatenate(
            [dc * g * i * (1 - i), dc * c0 * f * (1 - f), dh * lit * o * (1 - o), dc * i * (1 - g * g)], 1
        )
        np.add.at(enter, x[t], dz)
        state += h0.T @ dz
        dh, dc = dz @ model[f"{way}_state"].T, dc * f
    return enter, state


def gradient(model: dict, x: np.ndarray, gold: np.ndarray) -> tuple[float, dict]:
    keep: tuple[list, list] = ([], [])
    score, states = emissions(model, x, keep)
    loss, by_score, by_step = crf_gradient(model, score, gold)
    out = {"step": by_step, "bias": by_score.sum((0, 1)), "out": np.tensordot(states, by_score, ((0, 1), (0, 1)))}
    by_state = by_score @ model["out"].T
    for way, kept, xs, by_h in (
        ("forward", keep[0], x, by_state[:, :, :HIDDEN]),
        ("backward", keep[1], x[::-1], by_state[::-1, :, HIDDEN:]),
    ):
        out[f"{way}_in"], out[f"{way}_state"] = lstm_gradient(model, way, xs, kept, by_h)
    return loss, out


# --- labelled windows ------------------------------------------------------------------------------


def digits(rng: random.Random, n: int) -> str:
    return "".join(rng.choice("0123456789") for _ in range(n))


def card_number(rng: random.Random) -> str:
    body = rng.choice("3456") + digits(rng, 14)
    return next(body + d for d in "0123456789" if luhn(body + d))


def word(rng: random.Random) -> str:
    return "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(2, 8)))


def form(rng: random.Random) -> tuple[str | None, str]:
    """A value in one of many written forms with its kind, or a look-alike without kind."""
    pick = rng.randrange(9)
    if pick in (0, 1):
        local = word(rng) + rng.choice([".", "_", "-", ""]) + rng.choice([word(rng), digits(rng, 2), ""])
        host = rng.choice(["", f"mail{digits(rng, 1)}."]) + word(rng)
        return "email", local.strip("._-") + "@" + host + rng.choice([".com", ".example.com", ".org", ".co.uk"])
    if pick in (2, 3):
        return "ip", ".".join(str(rng.randint(0, 255)) for _ in range(4))
    if pick == 4:
        n = card_number(rng)
        sign = rng.choice(["", "", " ", "-"])
        return "card", sign.join(n[i : i + 4] for i in range(0, 16, 4))
    if pick in (5, 6):
        a, b, c = digits(rng, 3), digits(rng, 3), digits(rng, 4)
        shape = rng.choice(["({}) {}-{}", "{}-{}-{}", "{} {} {}", "({}) {} {}"])
        return "phone", rng.choice(["+1 ", "+44 ", "+1-", ""]) + shape.format(a, b, c)
    return None, rng.choice(
        [
            digits(rng, rng.randint(1, 8)),
            f"{digits(rng, 2)}.{digits(rng, 2)}",
            f"{rng.randint(1, 9)}.{rng.randint(0, 20)}.{rng.randint(0, 9)}",
            f"{rng.randint(1990, 2030)}-{digits(rng, 2)}-{digits(rng, 2)}",
            "".join(rng.choice("0123456789abcdef") for _ in range(rng.choice([16, 20, 40]))),
            f"{word(rng)}={digits(rng, rng.randint(1, 20))}{word(rng)}",
            f"@{word(rng)}",
            f"{digits(rng, 2)}:{digits(rng, 2)}",
        ]
    )


def tagged(text: str, spans: list[tuple[str, int, int]]) -> tuple[np.ndarray, np.ndarray]:
    x = np.zeros(WINDOW, np.int64)
    own = classes(text[:WINDOW])
    x[: len(own)] = own
    tags = np.zeros(WINDOW, np.int64)
    for kind, a, b in spans:
        k = 1 + 2 * KINDS.index(kind)
        if a < WINDOW and not tags[a:b].any():
            tags[a:b] = k + 1
            if a >= 0:
                tags[a] = k
    return x, tags


def labelled(texts: list[str], n: int, seed: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """n windows (WINDOW, n) of classes and tags, cut from the texts, most with forms set in."""
    rng = random.Random(seed)
    texts = [t for t in texts if t] or [" " * WINDOW]
    xs, tags = [], []
    for _ in range(n):
        text = rng.choice(texts)
        a = rng.randrange(max(1, len(text) - WINDOW))
        piece, spans = text[a : a + WINDOW], []
        for _ in range(rng.choice([0, 1, 1, 2, 2, 3])):
            spaces = [i for i, c in enumerate(piece) if c == " "] or [0]
            at = rng.choice(spaces)
            kind, value = form(rng)
            piece = f"{piece[:at]} {value}{rng.choice([' ', ', ', '. '])}{piece[at + 1 :]}"
            shift = len(value) + 2
            spans = [(k, s + shift, e + shift) if s > at else (k, s, e) for k, s, e in spans]
            if kind:
                spans.append((kind, at + 1, at + 1 + len(value)))
        taken = [range(s, e) for _, s, e in spans]
        shaped = [("card", *m.span()) for m in CARD.finditer(piece) if 12 <= n_digits(m.group()) <= 19]
        for k, s, e in base_spans(piece) + shaped:
            if not any(s < r.stop and r.start < e for r in taken):
                spans.append((k, s, e))
                taken.append(range(s, e))
        cut = rng.choice([0, 0, rng.randrange(20)])
        x, t = tagged(piece[cut:], [(k, s - cut, e - cut) for k, s, e in spans if e > cut])
        # A span cut at the window's left edge starts there.
        if t[0] and t[0] % 2 == 0:
            t[0] -= 1
        xs.append(x)
        tags.append(t)
    return np.stack(xs, 1), np.stack(tags, 1)


def fit(texts: list[str], steps: int = STEPS) -> dict[str, np.ndarray]:
    """The model, by ``steps`` adaptive-moment steps over labelled windows of the texts."""
    model = blank_model()
    first = {k: np.zeros_like(v) for k, v in model.items()}
    second = {k: np.zeros_like(v) for k, v in model.items()}
    x, tags = labelled(texts, BATCH * 32)
    rng = np.random.default_rng(11)
    for step in range(1, steps + 1):
        rate = 0.03 * (1 - 0.9 * step / steps)
        own = rng.integers(0, x.shape[1], BATCH)
        _, slopes = gradient(model, x[:, own], tags[:, own])
        norm = np.sqrt(sum(float((g * g).sum()) for g in slopes.values()))
        for k, g in slopes.items():
            g = g * min(1.0, 5 / (norm + 1e-9))
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.99 * second[k] + 0.01 * g * g
            moved = first[k] / (1 - 0.9**step) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-6)
            model[k] = (model[k] - rate * moved).astype(np.float32)
    return model


def train(docs: DataFrame, sample: int = SAMPLE) -> dict[str, np.ndarray]:
    """The model, learnt from at most ``sample`` documents that hold a digit (lowest hashes of the id)."""
    own = docs.select(F.col("doc_id").alias("own_id"), F.col("text").alias("own_text"))
    own = own.filter(F.col("own_text").rlike("[0-9]"))
    # The ids first: a sorted limit sends every task's candidates to the driver.
    ids = own.select("own_id").orderBy(F.xxhash64("own_id"), "own_id").limit(sample)
    taken = own.join(ids.distinct(), "own_id", "left_semi").collect()
    taken.sort(key=lambda r: (r.own_id, r.own_text))
    return fit([r.own_text for r in taken[:sample]])


# --- whole texts -----------------------------------------------------------------------------------


def window_starts(text: str) -> list[int]:
    """Starts of the windows that hold a digit or an at sign."""
    last = -(-max(len(text) - WINDOW, 0) // STRIDE)
    hits: set[int] = set()
    for m in DIGIT_OR_AT.finditer(text):
        k = m.start() // STRIDE
        hits.update(i for i in (k - 1, k) if 0 <= i <= last)
    return [k * STRIDE for k in sorted(hits)]


DIGIT_OR_AT = re.compile("[0-9@]")
UNSPACED = re.compile(r"\S+")


def spans_of(tags: np.ndarray, start: int, length: int) -> list[tuple[bool, str, int, int]]:
    """Spans of one decoded window of a text: (cut by an inner edge, kind, start, end)."""
    out, size = [], min(WINDOW, length - start)
    for a in np.flatnonzero(tags[:size] % 2 == 1):
        b = a + 1
        while b < size and tags[b] == tags[a] + 1:
            b += 1
        cut = (a == 0 and start > 0) or (b == size and start + size < length)
        out.append((cut, KINDS[tags[a] // 2], start + int(a), start + int(b)))
    return out


def reconcile(text: str, base: list[tuple[str, int, int]], found: list[tuple[bool, str, int, int]]):
    """The found spans that stand: whole ones first, longer first, overlapping nothing that stands.

    A span that fails its exact check is tried once more by its stretches between spaces."""
    standing = sorted((a, b) for _, a, b in base)
    out = []
    for _, kind, start, end in sorted(set(found), key=lambda s: (s[0], s[2] - s[3], s[2], s[1])):
        tried = [(start, end)]
        if not plausible(kind, text[start:end]):
            tried = [m.span() for m in UNSPACED.finditer(text, start, end)]
        for a, b in tried:
            if b - a < LEAST_LENGTH or not DIGIT_OR_AT.search(text, a, b) or not plausible(kind, text[a:b]):
                continue
            cut_number = text[a : a + 1].isdigit() and text[a - 1 : a].isdigit() and a > 0
            cut_number |= text[b - 1 : b].isdigit() and text[b : b + 1].isdigit()
            if not cut_number and not any(a < y and x < b for x, y in standing):
                standing.append((a, b))
                out.append((kind, a, b))
    return out


def all_spans(model: dict, texts: list[str]) -> list[list[tuple[str, int, int, bool]]]:
    """(kind, start, end, whether base) of each text by start, then kind."""
    base = [base_spans(t) for t in texts]
    at = [(i, s) for i, t in enumerate(texts) for s in window_starts(t)]
    found: list[list] = [[] for _ in texts]
    for k in range(0, len(at), 1024):
        own = at[k : k + 1024]
        x = np.zeros((WINDOW, len(own)), np.int64)
        for j, (i, s) in enumerate(own):
            c = classes(texts[i][s : s + WINDOW])
            x[: len(c), j] = c
        tags = decode(model, x)
        for j, (i, s) in enumerate(own):
            if tags[:, j].any():
                found[i] += spans_of(tags[:, j], s, len(texts[i]))
    out = []
    for text, own, more in zip(texts, base, found, strict=True):
        spans = [(*s, True) for s in own] + [(*s, False) for s in reconcile(text, own, more)]
        out.append(sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2])))
    return out


def redacted(text: str, spans: list[tuple[str, int, int, bool]]) -> str:
    """The text with each span replaced by its kind in brackets; overlapping spans become one."""
    out, done = [], 0
    for kind, a, b, _ in spans:
        if a >= done:
            out += [text[done:a], f"[{kind.upper()}]"]
        done = max(done, b)
    return "".join([*out, text[done:]])


def with_spans(docs: DataFrame, model: dict) -> DataFrame:
    """``docs`` with ``pii_spans`` and ``pii_text``, the text with every span replaced."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(texts):
        plain = [t or "" for t in texts.to_pylist()]
        spans = all_spans(sent.value, plain)
        rows = [[dict(zip(("kind", "start", "end", "base"), s, strict=True)) for s in own] for own in spans]
        kind = pa.list_(
            pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_())])
        )
        return [pa.array(rows, kind), pa.array(map(redacted, plain, spans), pa.string(), size=len(plain))]

    return W.with_columns(docs, "text", run, f"pii_spans {SPAN_TYPE}, pii_text string")


def joined(spans: F.Column) -> F.Column:
    one = lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])
    return F.array_join(F.transform(spans, one), ",")


def op7_personal_data(spark, sf_dir: str) -> DataFrame:
    """Personal data of every document: base counts and digest, and all spans."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = with_spans(docs, train(docs)).select("doc_id", "pii_spans")
    base = F.filter("pii_spans", lambda s: s["base"])
    of_kind = lambda kind: F.filter(base, lambda s: s["kind"] == kind)
    counts = [F.size(of_kind(kind)).cast("long").alias(f"n_{kind}") for kind in KINDS]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"),
        joined(F.col("pii_spans")).alias("spans"),
        F.size(F.filter("pii_spans", lambda s: ~s["base"])).cast("long").alias("n_added"),
    )
