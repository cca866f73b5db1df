"""SimHash near-duplicates searched in BK-trees.

Fingerprints are cut into blocks of bits. Two fingerprints within the radius
agree on all but ``radius`` blocks, so each choice of agreeing blocks names a
shard, and equal shard keys are the only places where a link can be. In every
shard a BK-tree is grown: a child hangs below its parent on an edge labelled
with their Hamming distance, and a search follows only edges within the radius
of its own distance to the node.

Trees are built and searched by the tasks that own their shard. They travel by
shuffle and not by broadcast from the driver: a driver-side broadcast would
need all fingerprints on the driver. A shard above ``tree_rows`` fingerprints
is cut into chunks; every pair of chunks is a task group of its own (a tree of
one chunk, searched by the other), so no shard is held whole by a task.

A task returns a star per linked set instead of all links, which keeps the
components whole. Components are the fixed point of smallest labels, with
pointer jumping; every round is a written table.

Cases: null and empty texts have fingerprint zero and link like any other; a
null document id takes part and is never the smallest unless all are null (then
the component is null); repeated rows stay repeated; an empty table gives no
rows; further columns are not read.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloom.llm.files import mapped
from tabloom.plans.sizing import pinned_if_small
from tabloom.plans.written import written

TREE_ROWS = 2048
PIECE = 1 << 16

# --------------------------------------------------------------- fingerprints


def fingerprint(text: str | None, width: int = 3, seed: int = 42) -> int:
    """Majority bits of the XXH64 values of a text's word shingles, as an unsigned number."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    if len(words) < width:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*(words[k:] for k in range(width))))
    digest, ones, n = xxhash.xxh64_intdigest, np.zeros(64, np.int64), 0
    values = np.fromiter((digest(s, seed) for s in shingles), np.uint64)
    for k in range(0, len(values), PIECE):
        piece = values[k : k + PIECE].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(piece, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        n += len(piece)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3, seed: int = 42) -> DataFrame:
    """``doc_id`` and the fingerprint as a signed 64-bit number."""

    def run(batches):
        for batch in batches:
            texts = batch.column(1)
            values = np.array([fingerprint(texts[k].as_py(), width, seed) for k in range(len(texts))], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values.view(np.int64))], names=["doc_id", "fp"])

    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return mapped(picked, run, "doc_id long, fp long")


# ---------------------------------------------------------------------- trees


class BKTree:
    """Values under Hamming distance; children are keyed by their distance to the parent."""

    def __init__(self):
        self.values: list[int] = []
        self.children: list[dict[int, int]] = []

    def add(self, value: int) -> None:
        if self.values:
            at = 0
            while True:
                d = (value ^ self.values[at]).bit_count()
                below = self.children[at].get(d)
                if below is None:
                    self.children[at][d] = len(self.values)
                    break
                at = below
        self.values.append(value)
        self.children.append({})

    def within(self, value: int, radius: int) -> list[int]:
        """Places of all values at ``radius`` or nearer."""
        found, todo = [], [0] if self.values else []
        while todo:
            at = todo.pop()
            d = (value ^ self.values[at]).bit_count()
            if d <= radius:
                found.append(at)
            low, high = d - radius, d + radius
            todo += [c for edge, c in self.children[at].items() if low <= edge <= high]
        return found


def linked(own: list[int], other: list[int] | None, radius: int) -> list[tuple[int, int]]:
    """Stars over the linked sets of one shard: within ``own``, or between ``own`` and ``other``."""
    values = own + (other or [])
    root = list(range(len(values)))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    tree = BKTree()
    if other is None:
        for k, value in enumerate(own):
            for hit in tree.within(value, radius):
                root[find(k)] = find(hit)
            tree.add(value)
    else:
        for value in own:
            tree.add(value)
        for k, value in enumerate(other, len(own)):
            for hit in tree.within(value, radius):
                root[find(k)] = find(hit)
    return [(values[k], values[find(k)]) for k in range(len(values)) if find(k) != k]


def _masks(distinct: int, radius: int) -> list[int]:
    """Bit masks of the shard keys; more and finer shards for more fingerprints."""
    spare = 1 if distinct < 1 << 24 else 2 if distinct < 1 << 32 else 3
    blocks = radius + spare
    edges = [64 * k // blocks for k in range(blocks + 1)]
    parts = [((1 << edges[k + 1]) - 1) ^ ((1 << edges[k]) - 1) for k in range(blocks)]
    return [sum(chosen) for chosen in combinations(parts, spare)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def links(distinct: DataFrame, n: int, radius: int = 3, tree_rows: int = TREE_ROWS) -> DataFrame:
    """Star links (u, v) between different fingerprints of ``distinct(fp)``; no linked set is cut."""
    masks = _masks(n, radius)
    shards = F.explode(F.array(*(F.struct(F.lit(k).alias("t"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("key")) for k, m in enumerate(masks))))
    keyed = distinct.select("fp", shards.alias("s")).select("fp", "s.t", "s.key")
    sizes = keyed.groupBy("t", "key").agg(F.count(F.lit(1)).alias("n"))
    hot, _ = pinned_if_small(sizes.filter(F.col("n") > tree_rows).select("t", "key", F.ceil(F.col("n") / tree_rows).cast("int").alias("chunks")))
    cut = keyed.join(hot, ["t", "key"], "left").withColumn("chunks", F.coalesce("chunks", F.lit(1)))
    cut = cut.withColumn("own", F.pmod(F.xxhash64("fp"), F.col("chunks")).cast("int"))
    cut = cut.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    cut = cut.select("t", "key", F.least("own", "with").alias("i"), F.greatest("own", "with").alias("j"), "own", "fp")

    def run(batches):
        held, left, right = None, [], []

        def stars():
            if held is None:
                return []
            return linked(left, None if held[2] == held[3] else right, radius)

        for batch in batches:
            out = []
            cols = [batch.column(k).to_pylist() for k in range(6)]
            for t, key, i, j, own, fp in zip(*cols):
                if (t, key, i, j) != held:
                    if len(left) + len(right) > 1:
                        out += stars()
                    held, left, right = (t, key, i, j), [], []
                (left if own == i else right).append(fp & 0xFFFFFFFFFFFFFFFF)
            if out:
                yield _pairs(out)
        if len(left) + len(right) > 1 and (out := stars()):
            yield _pairs(out)

    grouped = cut.repartition("t", "key", "i", "j").sortWithinPartitions("t", "key", "i", "j")
    return mapped(grouped, run, "u long, v long")


def _pairs(out: list[tuple[int, int]]) -> pa.RecordBatch:
    both = np.array(out, np.uint64).view(np.int64).reshape(-1, 2)
    return pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], names=["u", "v"])


def components(edges: DataFrame) -> DataFrame:
    """``u`` and the smallest node ``label`` it can reach, for every node of ``edges(u, v)``."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct()
    both = written(both, "simhash-edges")
    now = written(both.groupBy("u").agg(F.least("u", F.min("v")).alias("label")), "simhash-labels")
    while True:
        seen = both.join(now.select(F.col("u").alias("v"), F.col("label").alias("l")), "v")
        told = now.select("u", F.col("label").alias("l"), F.lit(True).alias("own")).union(seen.select("u", "l", F.lit(False)))
        told = told.groupBy("u").agg(F.min("l").alias("l"), F.min(F.when(F.col("own"), F.col("l"))).alias("before"))
        jump = now.select(F.col("u").alias("l"), F.col("label").alias("far"))
        after = told.join(jump, "l", "left").select("u", F.least("l", F.coalesce("far", "l")).alias("label"), "before")
        after = written(after, "simhash-labels")
        if after.filter(F.col("label") != F.col("before")).isEmpty():
            return after.select("u", "label")
        now = after.select("u", "label")


def near_duplicates(docs: DataFrame, radius: int = 3, width: int = 3, seed: int = 42, tree_rows: int = TREE_ROWS, **cols) -> DataFrame:
    """Every row's fingerprint and the smallest document id it can reach over links."""
    marked = written(fingerprints(docs, width=width, seed=seed, **cols), "simhash-fingerprints")
    distinct = marked.groupBy("fp").agg(F.min("doc_id").alias("first"))
    reached = components(links(distinct.select("fp"), distinct.count(), radius, tree_rows))
    least = distinct.join(reached.withColumnRenamed("u", "fp"), "fp").groupBy("label").agg(F.min("first").alias("component"))
    reached = reached.join(least, "label").select(F.col("u").alias("fp"), "component")
    known = distinct.join(reached, "fp", "left").select("fp", F.coalesce("component", "first").alias("component_id"))
    return marked.join(known, "fp").select("doc_id", hexed(F.col("fp")).alias("fingerprint"), "component_id")


def hexed(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def one_of_each(docs: DataFrame, groups: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose id is its group's smallest; of rows that repeat such an id, one."""
    kept = groups.filter(F.col("doc_id").eqNullSafe(F.col("component_id"))).groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))
    kept = written(kept, "simhash-kept")
    # the ids that stay are about as many as the texts: a merge join at every size, never a broadcast
    once, twice = (kept.filter(c).select("doc_id").hint("merge") for c in ("n = 1", "n > 1"))
    null_safe = lambda ids: docs["doc_id"].eqNullSafe(ids["doc_id"])
    out = docs.join(once, null_safe(once), "left_semi")
    if twice.isEmpty():
        return out
    return out.unionByName(docs.join(twice, null_safe(twice), "left_semi").dropDuplicates(["doc_id"]))
