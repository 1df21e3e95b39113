"""N-gram Jaccard join: exact links of documents whose shingle sets are similar, and their components.

A document is its set of distinct word shingles; the Jaccard distance of sets is a metric, and so is the
size of their symmetric difference, which a link bounds: similarity of at least s means a symmetric
difference of at most (1 - s) / (1 + s) of both sizes together. The join works on classes of equal sets
(one representative each) and loses no link between different sets:

1. A first pass counts shingles of all documents in a sketch of ``SKETCH`` counters (a fixed size),
   which only serves to order shingles: frequent ones last, others by hash.
2. Regions. Two linked sets share one of their first n - ceil(s n) + 1 shingles in any common order; so a
   set belongs to the regions of these shingles, with the smallest member as pivot. Regions with the same
   members are one. A shingle only one class has makes no region.
3. Windows. Each set keeps a pivot table of one bit per bucket of shingles, the parity of the number of
   its shingles there. A bit differs only if the symmetric difference meets the bucket, so the number of
   differing bits bounds it from below: pairs beyond the window can't link and go no further.
4. Every member within the window of its region's pivot is compared with it exactly. Members linked to
   one pivot are in one component and need no comparison among each other. In regions whose members are
   in several components, pairs of different components within the window follow, and are compared
   exactly, too.
5. Regions of over ``CELL`` members are for that cut into Voronoi cells around ``PIVOTS`` of their members
   by differing bits. A set goes to the cell of its nearest pivot, and as a guest to every other cell whose
   pivot is at most twice its window farther; a linked pair so meets in a cell where one of both is at
   home. Cells that are still too large are cut again, up to ``DEPTH`` times, and then compared in blocks.

Components spread as smallest labels over the links, with pointer jumping; nothing is collected.

Edge cases: NULL texts and texts without words have the empty set, link with nothing and are their own
component. Texts with fewer words than a shingle have their whole sequence as one. Rows that repeat an
id are one document with several sets, whose classes are linked; its rows without words stay apart. A NULL doc_id takes the component of its class's other rows, and
NULL if there are none. Extra columns are ignored. Shingles and sets are compared as 64- and 128-bit
hashes.
"""

from __future__ import annotations

import hashlib
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.llm import words as W
from skyledger.llm.store import staged

SKETCH = 1 << 22
CHUNK = 1 << 16
DEVIATIONS = 8
FREQUENT = 8
LEAST_BITS = 512
CELL = 512
PIVOTS = 8
DEPTH = 3
TASKS = 512
PAIR_BYTES = 1 << 22


@dataclass(frozen=True)
class Rule:
    """Shingle size and the least similarity in percent."""

    shingle: int = 4
    percent: int = 85

    def prefix(self, n: int) -> int:
        return n - -(-self.percent * n // 100) + 1

    def window(self, a, b):
        """Largest symmetric difference of linked sets of these sizes (numbers or columns)."""
        return (100 - self.percent) * (a + b) / (100 + self.percent)

    def sizes_fit(self, a: Column, b: Column) -> Column:
        return 100 * F.least(a, b) >= self.percent * F.greatest(a, b)

    def links(self, a: np.ndarray, b: np.ndarray) -> bool:
        shared = len(np.intersect1d(a, b, assume_unique=True))
        return shared > 0 and 100 * shared >= self.percent * (len(a) + len(b) - shared)


def place(shingles: np.ndarray) -> np.ndarray:
    return (shingles >> np.uint64(24)).astype(np.int64) % SKETCH


def packed(counts: np.ndarray) -> bytes:
    """Counts as their width in bytes and the compressed numbers; most are small."""
    width = next(w for w in (1, 2, 4, 8) if counts.max(initial=0) < 1 << 8 * w)
    return bytes([width]) + zlib.compress(counts.astype(f"<u{width}").tobytes(), 1)


def unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(data[1:]), f"<u{data[0]}").astype(np.int64)


def frequencies(docs: DataFrame, rule: Rule) -> np.ndarray:
    """The sketch: for each counter in how many documents its shingles occur. ``SKETCH`` numbers."""

    def count(batches):
        totals = np.zeros(SKETCH, np.uint32)
        for batch in batches:
            for part in W.slices(batch.column(0)):
                found = W.shingle_sets(part, rule.shingle)
                slot, n = np.unique(place(np.concatenate(found)), return_counts=True)
                totals[slot] += n.astype(np.uint32)
        chunks = range(0, SKETCH if totals.any() else 0, CHUNK)
        numbers = pa.array([k // CHUNK for k in chunks], pa.int32())
        tasks = pa.array([TaskContext.get().partitionId() // TASKS] * len(chunks), pa.int32())
        counts = pa.array([packed(totals[k : k + CHUNK]) for k in chunks], pa.binary())
        yield pa.RecordBatch.from_arrays([numbers, tasks, counts], ["chunk", "tasks", "counts"])

    def add(table: pa.Table) -> pa.Table:
        total = np.zeros(CHUNK, np.int64)
        for counts in table.column("counts"):
            total += unpacked(counts.as_py())
        return pa.table({"chunk": table.column("chunk")[:1], "counts": pa.array([packed(total)], pa.binary())})

    parts = docs.select("text").mapInArrow(count, "chunk int, tasks int, counts binary")
    # A task adds to each chunk once; sums over TASKS tasks come first, so no group holds a row of every task.
    summed = parts.groupBy("chunk", "tasks").applyInArrow(add, "chunk int, counts binary")
    summed = summed.groupBy("chunk").applyInArrow(add, "chunk int, counts binary")
    out = np.zeros(SKETCH, np.int64)
    for row in summed.collect():  # SKETCH / CHUNK rows, whatever the input
        out[row.chunk * CHUNK : (row.chunk + 1) * CHUNK] = unpacked(bytes(row.counts))
    return out


def bits(shingles: np.ndarray) -> bytes:
    """Parities of the numbers of shingles in a power of two of buckets, from a half to one a shingle.

    Short sets take ``LEAST_BITS``: their tables cost little and are too coarse with fewer. Fewer buckets only loosen the bound. Sets that share half of all their shingles still differ in over
    0.23 bits a shingle, and the window of 0.85 is 0.16."""
    n = max(1 << max(len(shingles).bit_length() - 1, 0), LEAST_BITS)
    parity = np.bincount((shingles % np.uint64(n)).astype(np.int64), minlength=n) & 1
    return np.packbits(parity.astype(np.uint8)).tobytes()


def folded(bits_: np.ndarray, size: int) -> np.ndarray:
    """Bits of more buckets (bytes along the last axis) as bits of ``size`` bytes' worth of buckets."""
    return np.bitwise_xor.reduce(bits_.reshape(*bits_.shape[:-1], -1, size), axis=-2)


def differing(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Numbers of differing bits along the last axis."""
    return np.bitwise_count(a ^ b).sum(-1, dtype=np.int64)


def fingerprints(docs: DataFrame, rule: Rule) -> DataFrame:
    """doc_id, n_shingles, same (digest of the set), prefix (first shingles in the order), bits."""
    sketch = frequencies(docs, rule)
    # Counters that stand out from the mean filling hold frequent shingles; all others are level.
    level = sketch.mean() + DEVIATIONS * np.sqrt(sketch.mean()) + FREQUENT
    sent = docs.sparkSession.sparkContext.broadcast(np.where(sketch > level, np.minimum(sketch, 65535), 0).astype(np.uint16))

    def run(texts):
        rank = sent.value
        out = [], [], [], []
        for part in W.slices(texts):
            for own in W.shingle_sets(part, rule.shingle):
                first = own[np.argsort(rank[place(own)], kind="stable")[: rule.prefix(len(own))]] if len(own) else own
                out[0].append(len(own))
                out[1].append(hashlib.blake2b(own.tobytes(), digest_size=16).digest())
                out[2].append(first.astype("<i8"))
                out[3].append(bits(own))
        return [
            pa.array(out[0], pa.int64()), pa.array(out[1], pa.binary()),
            pa.array(out[2], pa.list_(pa.int64())), pa.array(out[3], pa.binary()),
        ]

    own = docs.select("doc_id", "text")
    ddl = "n_shingles long, same binary, prefix array<long>, bits binary"
    return W.with_columns(own, "text", run, ddl).drop("text")


def regions(classes: DataFrame) -> DataFrame:
    """region, node: members of every different region of two or more classes."""
    entries = classes.select("node", F.explode("prefix").alias("region"))
    found = entries.groupBy("region").agg(
        F.count("*").alias("members"), F.bit_xor(F.xxhash64("node")).alias("a"), F.sum(F.hash("node").cast("long")).alias("b")
    )
    one = found.filter("members > 1").groupBy("members", "a", "b").agg(F.min("region").alias("region"))
    return entries.join(one.select("region", "members"), "region")


def windowed(pairs: DataFrame, rule: Rule) -> DataFrame:
    """The pairs (a, b with n_a, bits_a, n_b, bits_b) within the window, as a, b."""

    def run(batches):
        for batch in batches:
            a, n_a, bits_a, b, n_b, bits_b = (batch.column(i) for i in range(6))
            x, y = bits_a.to_pylist(), bits_b.to_pylist()
            window = rule.window(n_a.to_numpy(), n_b.to_numpy())
            keep = []
            for i in range(len(x)):
                p, q = (np.frombuffer(v, np.uint8) for v in sorted((x[i], y[i]), key=len))
                keep.append(differing(p, folded(q, len(p))) <= window[i])
            keep = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([a.filter(keep), b.filter(keep)], ["a", "b"])

    near = pairs.filter(rule.sizes_fit(F.col("n_a"), F.col("n_b")))
    return near.select("a", "n_a", "bits_a", "b", "n_b", "bits_b").mapInArrow(run, "a long, b long")


def verified(pairs: DataFrame, docs: DataFrame, rule: Rule) -> DataFrame:
    """The pairs (a, b) whose sets link, by the whole texts."""
    if not pairs.limit(1).count():
        return pairs
    nodes = staged(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct(), "pair-nodes")
    texts = docs.join(nodes, F.col("doc_id") == F.col("id"), "left_semi").select("doc_id", "text")
    texts = staged(texts, "pair-texts")
    first = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a"))
    second = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b"))
    both = pairs.join(first, "a").join(second, "b").select("a", "b", "text_a", "text_b")

    def run(batches):
        for batch in batches:
            for rows in W.pieces(batch.column(2), W.SLICE_BYTES):
                own = batch.slice(rows.start, rows.stop - rows.start)
                sets = [
                    [s for part in W.slices(own.column(i)) for s in W.shingle_sets(part, rule.shingle)] for i in (2, 3)
                ]
                keep = pa.array([rule.links(x, y) for x, y in zip(*sets, strict=True)], pa.bool_())
                yield pa.RecordBatch.from_arrays([own.column(0).filter(keep), own.column(1).filter(keep)], ["a", "b"])

    return both.mapInArrow(run, "a long, b long").distinct()


def components(links: DataFrame) -> DataFrame:
    """node, label: the smallest node that links (a, b) reach, for nodes with a link."""
    edges = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    edges = staged(edges.filter("a <> b").distinct(), "edges")
    labels = staged(edges.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("a")).alias("label")), "labels")
    while True:  # labels only fall, so this ends
        seen = edges.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy(F.col("a").alias("node"))
        least = labels.join(seen.agg(F.min("label").alias("near")), "node", "left")
        least = least.select("node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        up = labels.select(F.col("node").alias("label"), F.col("label").alias("above"))
        new = least.join(up, "label", "left").select("node", "old", F.least("label", "above").alias("label"))
        new = staged(new, "labels")
        labels = new.select("node", "label")
        if not new.filter("label < old").limit(1).count():
            return labels


def of_one_id(prints: DataFrame, classes: DataFrame) -> DataFrame:
    """a, b: links between the classes of rows that repeat an id."""
    rows = prints.filter("n_shingles > 0 and doc_id is not null").select("doc_id", "same")
    several = rows.groupBy("doc_id").agg(F.min("same").alias("first"), F.max("same").alias("last"))
    several = staged(several.filter("first <> last").select("doc_id", "first"), "repeated")
    pairs = rows.join(several, "doc_id").filter("same <> first").distinct()
    nodes = classes.select("same", "node")
    pairs = pairs.join(nodes.withColumnRenamed("node", "b"), "same")
    return pairs.join(nodes.toDF("first", "a"), "first").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))


def sized(members: DataFrame) -> DataFrame:
    """region, members, bytes: size of each region and its members' shortest bits."""
    return members.groupBy("region").agg(F.count("*").alias("members"), F.min(F.length("bits")).alias("bytes"))


def voronoi(members: DataFrame, sizes: DataFrame, rule: Rule) -> DataFrame:
    """The members of each region dealt to cells: ``region`` is the cell's, ``parent`` the region cut."""
    key = F.xxhash64("node", "region")
    few = members.groupBy("region", F.pmod(key, F.lit(PIVOTS)).alias("of")).agg(F.min_by("bits", key).alias("pivot"))
    pivots = few.groupBy("region").agg(F.sort_array(F.collect_list("pivot")).alias("pivots"))  # at most PIVOTS
    joined = members.join(pivots.join(sizes.select("region", "bytes"), "region"), "region")
    names = ["region", "node", "n", "bits", "label", "home", "side"]
    joined = joined.select(*names, "pivots", "bytes")

    def run(batches):
        for batch in batches:
            take, cell, home = [], [], []
            for i, (pivots, size, own) in enumerate(zip(*(batch.column(k).to_pylist() for k in (7, 8, 3)), strict=True)):
                # All distances of a region are taken in bits of one size, so they obey the triangle inequality.
                centre = np.stack([folded(np.frombuffer(v, np.uint8), size) for v in pivots])
                far = differing(folded(np.frombuffer(own, np.uint8), size)[None], centre)
                reach = 2 * (100 - rule.percent) / rule.percent * batch.column(2)[i].as_py()
                nearest = int(far.argmin())
                for j in np.flatnonzero(far <= far[nearest] + reach):
                    take.append(i)
                    cell.append(int(j))
                    home.append(bool(j == nearest))
            dealt = batch.take(pa.array(take, pa.int64()))
            columns = [dealt.column(i) for i in range(7)]
            columns[5] = pa.array(np.array(home, bool) & columns[5].to_numpy(zero_copy_only=False).astype(bool))
            yield pa.RecordBatch.from_arrays([*columns, pa.array(cell, pa.int32())], [*names, "cell"])

    ddl = "region long, node long, n long, bits binary, label long, home boolean, side int, cell int"
    dealt = joined.mapInArrow(run, ddl).withColumnRenamed("region", "parent")
    return dealt.withColumn("region", F.xxhash64("parent", "cell")).select("parent", *names)


def blocks(members: DataFrame, sizes: DataFrame) -> DataFrame:
    """The members of large regions dealt to pairs of blocks, which meet once each."""
    n = F.ceil(F.col("members") / (CELL // 2)).cast("int")
    own = members.join(sizes.select("region", "members"), "region").withColumn("blocks", n)
    own = own.withColumn("block", F.pmod(F.hash("node"), F.col("blocks")))
    own = own.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    low, high = F.least("block", "other"), F.greatest("block", "other")
    side = F.when(F.col("block") == F.col("other"), -1).otherwise((F.col("block") > F.col("other")).cast("int"))
    return own.select(
        F.xxhash64("region", low, high).alias("region"), "node", "n", "bits", "label", "home", side.alias("side")
    )


def cut(members: DataFrame, rule: Rule) -> DataFrame:
    """Members (region, node, n, bits, label) as cells of at most about ``CELL``, with home and side."""
    members = members.withColumns({"home": F.lit(True), "side": F.lit(-1)})
    done = []
    for depth in range(DEPTH + 1):
        sizes = sized(members)
        large = staged(sizes.filter(F.col("members") > CELL), "large")
        if not large.limit(1).count():
            break
        done.append(members.join(large, "region", "left_anti"))
        rest = members.join(large.select("region"), "region", "left_semi")
        if depth == DEPTH:
            members = blocks(rest, large)
            break
        dealt = staged(voronoi(rest, large, rule), "cells")
        grown = dealt.groupBy("parent").agg(F.count("*").alias("dealt"))
        # A cut that more than doubles a region parts nothing; such a region is compared in blocks.
        split = grown.join(large, F.col("parent") == F.col("region")).filter("dealt <= 2 * members").select("parent")
        split = staged(split, "split")
        whole = large.join(split, F.col("region") == F.col("parent"), "left_anti")
        done.append(blocks(rest.join(whole.select("region"), "region", "left_semi"), whole))
        members = dealt.join(split, "parent", "left_semi").drop("parent")
    names = ["region", "node", "n", "bits", "label", "home", "side"]
    out = members.select(names)
    for part in done:
        out = out.union(part.select(names))
    return out


def crossing(members: DataFrame, rule: Rule) -> DataFrame:
    """a, b: pairs of members of a cell with different labels, within the window; one of them at home."""

    def near(x: dict, y: dict, same: bool) -> tuple[np.ndarray, np.ndarray]:
        """Rows of x and y that may link; their bits are one matrix each, of one width."""
        ok = x["label"][:, None] != y["label"]
        ok &= x["home"][:, None] | y["home"]
        ok &= (x["side"][:, None] != y["side"]) | (y["side"] < 0)
        n, m = x["n"][:, None], y["n"]
        ok &= 100 * np.minimum(n, m) >= rule.percent * np.maximum(n, m)
        if same:
            ok = np.triu(ok, 1)
        i, j = np.nonzero(ok)
        keep = [np.zeros(0, bool)]
        step = max(1, PAIR_BYTES // x["bits"].shape[1])
        for k in range(0, len(i), step):
            a, b = i[k : k + step], j[k : k + step]
            keep.append(differing(x["bits"][a], y["bits"][b]) <= rule.window(x["n"][a], y["n"][b]))
        keep = np.concatenate(keep)
        return x["node"][i[keep]], y["node"][j[keep]]

    def compare(table: pa.Table) -> pa.Table:
        rows = {c: table.column(c).to_numpy() for c in ("node", "n", "label", "home", "side")}
        found = [(np.zeros(0, np.int64),) * 2]
        if (rows["label"] != rows["label"][0]).any():
            texts = table.column("bits").to_pylist()
            width = np.array([len(t) for t in texts])
            own = {}
            for size in np.unique(width).tolist():
                at = np.flatnonzero(width == size)
                own[size] = {c: v[at] for c, v in rows.items()}
                own[size]["bits"] = np.frombuffer(b"".join([texts[i] for i in at]), np.uint8).reshape(-1, size)
            for size, x in own.items():
                found.append(near(x, x, True))
                # Linked sets are so near in size that their bits are at most twofold.
                if 2 * size in own:
                    more = own[2 * size]
                    found.append(near(x, more | {"bits": folded(more["bits"], size)}, False))
        a, b = (np.concatenate([f[k] for f in found]) for k in (0, 1))
        return pa.table({"a": np.minimum(a, b), "b": np.maximum(a, b)})

    return members.groupBy("region").applyInArrow(compare, "a long, b long").filter("a <> b").distinct()


def joined(docs: DataFrame, rule: Rule = Rule()) -> DataFrame:  # noqa: B008
    """doc_id, n_shingles, component_id of every document."""
    docs = docs.select("doc_id", "text")
    prints = staged(fingerprints(docs, rule), "prints")
    classes = prints.filter("n_shingles > 0").groupBy("same").agg(
        F.min("doc_id").alias("node"), F.first("n_shingles").alias("n"), F.first("prefix").alias("prefix"),
        F.first("bits").alias("bits"),
    )
    classes = staged(classes.filter("node is not null"), "classes")
    members = staged(regions(classes), "members")
    own = classes.select("node", "n", "bits")

    # 4a. Every member with its region's pivot.
    pivots = members.groupBy("region").agg(F.min("node").alias("a"))
    pairs = members.join(pivots, "region").select("a", F.col("node").alias("b")).filter("a <> b").distinct()
    pairs = pairs.join(own.toDF("a", "n_a", "bits_a"), "a").join(own.toDF("b", "n_b", "bits_b"), "b")
    links = verified(staged(windowed(pairs, rule), "pairs"), docs, rule)
    links = staged(links.union(of_one_id(prints, classes)), "links")
    labels = staged(components(links), "labels")

    # 4b. Members of regions that are still in several components.
    open_ = members.filter("members > 2").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    mixed = open_.groupBy("region").agg(F.min("label").alias("low"), F.max("label").alias("high"))
    open_ = open_.join(mixed.filter("low < high").select("region"), "region", "left_semi")
    open_ = staged(open_.join(own, "node").select("region", "node", "n", "bits", "label"), "open")
    more = staged(crossing(cut(open_, rule), rule), "more-pairs")
    if more.limit(1).count():
        more = staged(verified(more, docs, rule), "more-links")
        labels = components(links.union(more))

    named = classes.select("same", "node").join(labels, "node", "left")
    named = named.select("same", F.coalesce("label", "node").alias("component"))
    return prints.join(named, "same", "left").select(
        "doc_id",
        "n_shingles",
        F.when(F.col("n_shingles") > 0, F.col("component")).otherwise(F.col("doc_id")).alias("component_id"),
    )


def op9_jaccard_join(spark, sf_dir: str) -> DataFrame:
    """Component of every document under links of similarity 0.85 or more over 4-word shingles."""
    return joined(spark.read.parquet(f"{sf_dir}/documents.parquet"))
