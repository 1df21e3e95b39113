"""Words, lines and shingles of whole texts as numpy arrays.

A word is a longest run of bytes other than the six ASCII white-space bytes, as in the pattern
``[^\\x20\\x09-\\x0D]+``. Everything works on the UTF-8 bytes of an Arrow column: a slice of rows is one
byte array plus row offsets, and one cumulative sum hashes all its words at once. NULL counts as empty.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bytes of text handled at once; one longer text forms a slice of its own.
SLICE_BYTES = 1 << 20

BASE = 0x9E3779B97F4A7C15
MULTIPLIERS = np.array([0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93], np.uint64)

WHITE = np.zeros(256, bool)
WHITE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
BYTE_VALUE = np.random.default_rng(7).integers(1, 1 << 63, 256, dtype=np.uint64)

_powers = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def mix(h: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values one to one."""
    h = (h ^ (h >> np.uint64(30))) * MULTIPLIERS[0]
    h = (h ^ (h >> np.uint64(27))) * MULTIPLIERS[1]
    return h ^ (h >> np.uint64(31))


def _power(kind: str, n: int) -> np.ndarray:
    """Powers 0..n-1 of the base or of its inverse modulo 2**64."""
    if len(_powers[kind]) < n:
        base = BASE if kind == "up" else pow(BASE, -1, 1 << 64)
        steps = np.full(max(n, SLICE_BYTES + 1), base, np.uint64)
        steps[0] = 1
        _powers[kind] = np.cumprod(steps, dtype=np.uint64)
    return _powers[kind][:n]


@dataclass
class Slice:
    """Some neighbouring rows: their bytes end to end, ``offsets`` of n + 1 row borders, first row."""

    data: np.ndarray
    offsets: np.ndarray
    first: int

    @property
    def n(self) -> int:
        return len(self.offsets) - 1

    def rows_of(self, at: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.offsets, at, side="right") - 1

    def spans(self, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of the longest runs of ``inside`` bytes that cross no row border."""
        borders = self.offsets[self.offsets < len(inside)]
        before = np.empty(len(inside), bool)
        before[1:] = inside[:-1]
        before[borders] = False
        starts = np.flatnonzero(inside & ~before)
        after = np.empty(len(inside), bool)
        after[:-1] = inside[1:]
        if len(inside):
            after[-1] = False
            after[borders[borders > 0] - 1] = False
        return starts, np.flatnonzero(inside & ~after) + 1

    def hashes(self, starts: np.ndarray, ends: np.ndarray, lower: bool = False) -> np.ndarray:
        """64-bit hash of each byte span."""
        n = len(self.data)
        total = np.zeros(n + 1, np.uint64)
        values = BYTE_VALUE[LOWER][self.data] if lower else BYTE_VALUE[self.data]
        np.cumsum(values * _power("up", n), out=total[1:])
        return mix((total[ends] - total[starts]) * _power("down", n + 1)[starts])


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[Slice]:
    """The rows of a text column in slices of about ``limit`` bytes; a row is never cut."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    if not len(column):
        return
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset :][: len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        last = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        last = min(max(last, first + 1), len(column))
        part = offsets[first : last + 1]
        yield Slice(data[part[0] : part[-1]], part - part[0], first)
        first = last


@dataclass
class Words:
    """All words of a slice in order: byte borders, row and hash of each; ``per_row`` counts them."""

    starts: np.ndarray
    ends: np.ndarray
    row: np.ndarray
    hash: np.ndarray
    per_row: np.ndarray

    @property
    def borders(self) -> np.ndarray:
        """Index of each row's first word, and the number of words at the end."""
        return np.concatenate([[0], np.cumsum(self.per_row)])


def words(part: Slice, lower: bool = False) -> Words:
    starts, ends = part.spans(~WHITE[part.data])
    row = part.rows_of(starts)
    per_row = np.bincount(row, minlength=part.n)
    return Words(starts, ends, row, part.hashes(starts, ends, lower), per_row)


def chain(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of each window of k neighbouring values, in order."""
    n = max(len(hashes) - k + 1, 0)
    out = hashes[:n].copy()
    for j in range(1, k):
        out = mix(out * MULTIPLIERS[2] + hashes[j : j + n])
    return out


def windows(found: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the k-word windows inside one row, and the index of each one's first word."""
    n = max(len(found.row) - k + 1, 0)
    at = np.flatnonzero(found.row[:n] == found.row[k - 1 : k - 1 + n])
    return chain(found.hash, k)[at], at


def sums(values: np.ndarray, borders: np.ndarray) -> np.ndarray:
    """Sum of the values between neighbouring borders; 0 for an empty stretch."""
    total = np.concatenate([[0], np.cumsum(values)])
    return total[borders[1:]] - total[borders[:-1]]


def shingle_sets(part: Slice, k: int) -> list[np.ndarray]:
    """Sorted distinct k-word shingle hashes of every row, A-Z lower-cased; a row with fewer words has
    its whole sequence as one shingle, and a row without words the empty set."""
    found = words(part, lower=True)
    hashed, at = windows(found, k)
    borders = np.searchsorted(at, found.borders)
    out = []
    for i in range(part.n):
        own = hashed[borders[i] : borders[i + 1]]
        if not len(own) and found.per_row[i]:
            of = found.hash[found.borders[i] : found.borders[i] + found.per_row[i]]
            own = mix(chain(of, len(of)) + np.uint64(len(of)))
        out.append(np.unique(own))
    return out


def pieces(column: pa.Array, limit: int) -> Iterator[slice]:
    """Row ranges of about ``limit`` bytes of text each, at least one row."""
    for part in slices(column, limit):
        yield slice(part.first, part.first + part.n)


def with_columns(
    df: DataFrame,
    text: str,
    make: Callable[[pa.Array], list[pa.Array]],
    ddl: str,
    limit: int = 4 * SLICE_BYTES,
) -> DataFrame:
    """``df`` with the columns of ``ddl`` that ``make`` derives from about ``limit`` bytes of texts at a
    time; columns of the same names in ``df`` are replaced (not the text itself: name another column)."""
    new = T.StructType.fromDDL(ddl)
    taken = {name.lower() for name in new.names}
    kept = df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in taken or c == text])
    at = kept.columns.index(text)
    schema = T.StructType([*kept.schema.fields, *new.fields])

    def run(batches):
        for batch in batches:
            for rows in pieces(batch.column(at), limit):
                own = batch.slice(rows.start, rows.stop - rows.start)
                made = make(own.column(at))
                yield pa.RecordBatch.from_arrays([*own.columns, *made], schema.names)

    return kept.mapInArrow(run, schema)
