"""Plain versions of what several tests compare with."""

import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")

DOCS = "doc_id LONG, text STRING, lang STRING, source STRING, n_chars LONG"


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def shingles(text, k):
    w = WORD.findall(lower(text))
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} or ({tuple(w)} if w else set())


def linked(rows, k, percent):
    """{row number: (set size, smallest id reachable)} by counting every shared shingle."""
    sets = [shingles(text, k) for _, text in rows]
    up = list(range(len(rows)))

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    holders = defaultdict(list)
    for j, own in enumerate(sets):
        shared = Counter(i for s in own for i in holders[s])
        for i, n in shared.items():
            if 100 * n >= percent * (len(own) + len(sets[i]) - n):
                a, b = top(i), top(j)
                up[max(a, b)] = min(a, b)
        for s in own:
            holders[s].append(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        least[top(i)] = min(least.get(top(i), doc_id), doc_id)
    return {i: (len(sets[i]), least[top(i)]) for i in range(len(rows))}


def frame(spark, *texts):
    """Documents numbered from 0 with the given texts."""
    rows = [(i, t, "en", "s", len(t) if t is not None else None) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)
