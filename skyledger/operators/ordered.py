"""Ordered windows over a whole table, without a key to partition by.

``Window.orderBy`` without ``partitionBy`` sends all rows to one task. Here the order is cut into chunks:
integers that rise with it, such as the day number. Rows are numbered inside their chunk, and the number
of rows in earlier chunks is added. Those sums are made without a running pass: a chunk adds its count to
one node of each level of a binary tree over the chunk numbers, and the rows before a chunk are the sum of
the nodes that make up its prefix, at most one of each level. With every row numbered, a window over the
last n rows is cut into blocks of numbers, and the last rows of a block are copied into the next.

Everything is hashed by chunk, tree node or block; no step has a single partition. The same functions
spread the windows of one hot key, when ``by`` names it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Chunk numbers are 0 to 2 ** LEVELS - 1.
LEVELS = 24
LAST_CHUNK = (1 << LEVELS) - 1


def day_chunk(date: str) -> Column:
    """Chunk of a date: its day number, from the year -20000 on; NULL comes last."""
    return F.coalesce(F.unix_date(F.col(date).cast("date")) + (1 << (LEVELS - 1)), F.lit(LAST_CHUNK))


def value_chunk(value: str, width: float, descending: bool = False) -> Column:
    """Chunk of a number: its stretch of ``width``; values beyond the numbers of chunks share the first
    or last one. NULL comes last, NaN counts as the largest."""
    half = 1 << (LEVELS - 1)
    edge = F.greatest(F.least(F.col(value) / width, F.lit(half - 2.0)), F.lit(1.0 - half))
    at = F.floor(F.when(F.isnan(value), F.lit(half - 2.0)).otherwise(edge)).cast("int")
    chunk = (F.lit(half) - at if descending else at + half).cast("int")
    return F.when(F.col(value).isNotNull(), chunk).otherwise(F.lit(LAST_CHUNK))


def rows_before(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``counts`` (by, chunk, n; one row for each) with ``before``: the rows of all earlier chunks."""
    chunk = F.col("chunk")
    levels = F.sequence(F.lit(0), F.lit(LEVELS - 1))
    node = lambda c: F.transform(levels, lambda k: F.struct(k.alias("level"), c(k).alias("node")))
    up = lambda k: F.call_function("shiftright", chunk, k)
    adds = counts.select(*by, "n", F.inline(node(up)))
    sums = adds.groupBy(*by, "level", "node").agg(F.sum("n").alias("below"))
    # Where a bit of the chunk's number is set, the node left of its ancestor lies wholly before it.
    left = F.filter(node(lambda k: up(k) - 1), lambda x: x["node"].bitwiseAND(F.lit(1)) == 0)
    asked = counts.select(*by, "chunk", F.inline(left))
    parts = _join_on(asked, sums, (*by, "level", "node"), "inner")
    before = parts.groupBy(*by, "chunk").agg(F.sum("below").alias("before"))
    found = _join_on(counts.select(*by, "chunk", "n"), before, (*by, "chunk"), "left")
    return found.withColumn("before", F.coalesce("before", F.lit(0)))


def _join_on(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Join on columns of the same names, where NULL equals NULL; the left keys stay."""
    renamed = right.select(*[F.col(c).alias(f"_r_{c}" if c in keys else c) for c in right.columns])
    same = [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys]
    return left.join(renamed, same, how).drop(*[f"_r_{k}" for k in keys])


def _with_before(df: DataFrame, chunk: Column, by: Sequence[str]) -> DataFrame:
    cut = df.withColumn("_chunk", chunk)
    counts = cut.groupBy(*by, F.col("_chunk").alias("chunk")).agg(F.count("*").alias("n"))
    sums = rows_before(counts, by).select(*by, F.col("chunk").alias("_chunk"), F.col("before").alias("_before"))
    return _join_on(cut, sums, (*by, "_chunk"), "inner")


def numbered(df: DataFrame, chunk: Column, order: Sequence[Column], by: Sequence[str] = ()) -> DataFrame:
    """``df`` with ``row_no``, from 1, in the given order; ``chunk`` must never fall along it. Rows that the
    order does not tell apart are numbered in any order."""
    inside = F.row_number().over(Window.partitionBy(*by, "_chunk").orderBy(*order))
    out = _with_before(df, chunk, by).withColumn("row_no", F.col("_before") + inside)
    return out.drop("_chunk", "_before")


def ranked(df: DataFrame, chunk: Column, order: Sequence[Column], name: str, by: Sequence[str] = ()) -> DataFrame:
    """``df`` with the rank, with gaps, in the given order; equal rows must share a chunk."""
    inside = F.rank().over(Window.partitionBy(*by, "_chunk").orderBy(*order))
    out = _with_before(df, chunk, by).withColumn(name, (F.col("_before") + inside).cast("int"))
    return out.drop("_chunk", "_before")


def last_rows_measures(
    df: DataFrame,
    rows: int,
    measures: Mapping[str, Column],
    chunk: Column,
    order: Sequence[Column],
    by: Sequence[str] = (),
    block_rows: int = 4096,
) -> DataFrame:
    """Add aggregates over each row and the ``rows`` - 1 before it in the order, one column for each."""
    size = max(block_rows, rows)
    numbers = numbered(df, chunk, order, by)
    at = F.col("row_no") - 1
    block = F.floor(at / size)
    # The last rows of a block are also the first neighbours of the next one.
    lent = F.when(at % size >= size - (rows - 1), F.array(block, block + 1)).otherwise(F.array(block))
    spread = numbers.select("*", block.alias("_own"), F.explode(lent).alias("_block"))
    window = Window.partitionBy(*by, "_block").orderBy("row_no").rowsBetween(1 - rows, Window.currentRow)
    out = spread.withColumns({name: agg.over(window) for name, agg in measures.items()})
    return out.filter("_own = _block").drop("_own", "_block", "row_no")
