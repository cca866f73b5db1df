"""Nearest neighbours by inner product through a permutation index.

Pivots are drawn once. Every vector is represented by its ``prefix`` nearest
pivots in order, and posted under each of them, with the place it holds there, in
the inverted file of its block. A query walks the lists of its own pivots and
adds up how far places differ (footrule, a missing pivot counting as one place
behind the last); the ``share`` of the block with the smallest sums is reranked
by the exact inner product on the original vectors in double precision.

Inner products are turned into distances by one further coordinate that lifts
all vectors to the largest norm (and is zero for queries), so that the order of
distances to a query is the order of its inner products.

Vectors are packed into blocks of at most ``block_rows`` (the index, a written
table); queries into blocks of at most ``query_rows``; each pair of blocks is a
row of an equality join on both blocks' numbers, searched in fixed memory. A query
keeps k rows per block, and k of those at the end.

Pivots come from the ``pivots`` usable rows with the smallest hash of their id;
all rows are indexed. Recall is measured in the tests.

Cases: null and empty vectors, vectors with null or non-finite components, zero
vectors, and vectors whose length is not the most frequent one take no part;
equal vectors are ordered by id; a repeated id is a candidate once per row, and
none of its rows answers a query of the same id; a null id is no query and no
candidate; with no usable rows the result is empty; further columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabloom.llm.files import mapped
from tabloom.plans.written import written

BLOCK_ROWS, QUERY_ROWS = 4096, 1024


def usable(table: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    v = F.col(vec_col).cast("array<double>")
    finite = ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = table.select(F.col(id_col).cast("long").alias("id"), v.alias("v")).filter(F.col("id").isNotNull() & F.col("v").isNotNull() & finite)
    return rows.filter(F.exists("v", lambda x: x != 0))


def dimension(rows: DataFrame) -> tuple[int, float]:
    """The most frequent length (the smaller of equals) and the largest squared norm of that length."""
    square = F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)
    seen = rows.groupBy(F.size("v").alias("d")).agg(F.count(F.lit(1)).alias("n"), F.max(square).alias("top"))
    best = seen.orderBy(F.desc("n"), "d").limit(1).collect()
    return (best[0]["d"], best[0]["top"]) if best else (0, 0.0)


def lifted(x: np.ndarray, top: float) -> np.ndarray:
    """With one more coordinate that makes all norms equal; queries get zero there."""
    rest = np.sqrt(np.maximum(top - (x * x).sum(axis=1), 0))
    return np.column_stack([x, rest])


def places(x: np.ndarray, pivots: np.ndarray, prefix: int) -> np.ndarray:
    """The ``prefix`` nearest pivots of each row, nearest first."""
    d = (pivots * pivots).sum(axis=1) - 2 * (x @ pivots.T)
    near = np.argpartition(d, prefix - 1, axis=1)[:, :prefix] if prefix < len(pivots) else np.tile(np.arange(len(pivots)), (len(x), 1))
    own = np.take_along_axis(d, near, axis=1)
    return np.take_along_axis(near, np.lexsort((near, own), axis=1), axis=1).astype(np.int16)


class Postings:
    """Inverted files of one block: for each pivot the rows that have it, with its place there."""

    def __init__(self, perm: np.ndarray, n_pivots: int):
        self.n, self.prefix = perm.shape
        flat = perm.ravel().astype(np.int64)
        order = np.argsort(flat, kind="stable")
        self.rows, self.place = (order // self.prefix).astype(np.int32), (order % self.prefix).astype(np.int32)
        self.start = np.searchsorted(flat[order], np.arange(n_pivots + 1))

    def footrule(self, own: np.ndarray) -> np.ndarray:
        """Distances of a query's permutation to every row of the block.

        Without a shared pivot both sides' (last - place) add up to last * (last + 1);
        a shared one takes 2 * (last - the later of its two places) off.
        """
        last, a, b = self.prefix, self.start[own], self.start[own + 1]
        spans = list(zip(a.tolist(), b.tolist()))
        rows, place = (np.concatenate([x[p:q] for p, q in spans]) for x in (self.rows, self.place))
        later = np.maximum(place, np.repeat(np.arange(len(own), dtype=np.int32), b - a))
        shared = np.bincount(rows, weights=last - later, minlength=self.n)
        return (last * (last + 1) - 2 * shared).astype(np.int32)


def first_k(score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k largest scores, ties to smaller ids."""
    if len(score) <= k:
        return np.lexsort((ids, -score))
    some = np.flatnonzero(score >= np.partition(score, len(score) - k)[len(score) - k])
    return some[np.lexsort((ids[some], -score[some]))[:k]]


def search(block: dict, queries: dict, k: int, share: float, n_pivots: int):
    """Per query of the block of queries, up to k (query, vec, score) of one block of vectors."""
    ids, x, n = block["ids"], block["x"], len(block["ids"])
    posts = Postings(block["perm"], n_pivots)
    take = min(n, max(int(np.ceil(share * n)), 4 * k))
    tie = np.arange(n)  # rows are in id order, so equal footrules go to smaller ids
    out_q, out_v, out_s = [], [], []
    for q_id, q, own in zip(queries["ids"].tolist(), queries["x"], queries["perm"]):
        key = posts.footrule(own).astype(np.int64) * n + tie
        rows = np.argpartition(key, take - 1)[:take] if take < n else tie
        rows = rows[ids[rows] != q_id]
        score = np.einsum("ij,j->i", x[rows], q)
        best = first_k(score, ids[rows], k)
        out_q += [q_id] * len(best)
        out_v += ids[rows[best]].tolist()
        out_s += score[best].tolist()
    return out_q, out_v, out_s


PACKED = "block long, ids binary, x binary, perm binary"


def _packed(rows: DataFrame, size: int, d: int, top: float | None, pivots: np.ndarray, prefix: int) -> DataFrame:
    """Rows packed into blocks, each in id order; queries have no ``top``."""

    def pack(ids, vectors, number):
        ids, x = np.concatenate(ids), np.concatenate(vectors)
        order = np.argsort(ids, kind="stable")
        ids, x = ids[order], x[order]
        perm = places(np.column_stack([x, np.zeros(len(x))]) if top is None else lifted(x, top), pivots, prefix)
        return pa.RecordBatch.from_pylist([{"block": (TaskContext.get().partitionId() << 32) | number, "ids": ids.tobytes(), "x": x.tobytes(), "perm": perm.tobytes()}], pa.schema([("block", pa.int64()), ("ids", pa.binary()), ("x", pa.binary()), ("perm", pa.binary())]))

    def run(batches):
        ids, vectors, held, made = [], [], 0, 0
        for batch in batches:
            n = batch.column("id").to_numpy()
            x = batch.column("v").flatten().to_numpy(zero_copy_only=False).reshape(len(n), d)
            while len(n):
                fits = size - held
                ids.append(n[:fits])
                vectors.append(x[:fits])
                held += len(n[:fits])
                n, x = n[fits:], x[fits:]
                if held == size:
                    yield pack(ids, vectors, made)
                    ids, vectors, held, made = [], [], 0, made + 1
        if held:
            yield pack(ids, vectors, made)

    return mapped(rows, run, PACKED)


def _unpacked(ids: bytes, x: bytes, perm: bytes, d: int, prefix: int) -> dict:
    n = np.frombuffer(ids, np.int64)
    return {"ids": n, "x": np.frombuffer(x, np.float64).reshape(len(n), d), "perm": np.frombuffer(perm, np.int16).reshape(len(n), prefix)}


def _numbered(packed: DataFrame, name: str) -> tuple[DataFrame, int]:
    """Packed blocks numbered from zero; the driver sees one number per block."""
    seen = sorted(r["block"] for r in packed.select("block").collect())
    numbers = packed.sparkSession.createDataFrame(pa.table({"block": pa.array(seen, pa.int64()), name: pa.array(range(len(seen)), pa.int32())}), f"block long, {name} int")
    return packed.join(F.broadcast(numbers), "block").drop("block"), len(seen)


def nearest(
    table: DataFrame, is_query: Column, k: int = 20, *, id_col: str = "vec_id", vec_col: str = "embedding", pivots: int = 256,
    prefix: int = 48, share: float = 0.35, block_rows: int = BLOCK_ROWS, query_rows: int = QUERY_ROWS,
) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score`` for the rows that ``is_query`` (a condition on the id column) marks."""
    spark, answer = table.sparkSession, "query_id long, vec_id long, score double"
    rows = usable(table, id_col, vec_col)
    d, top = dimension(rows)
    if not d:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    rows = rows.filter(F.size("v") == d)
    chosen = rows.orderBy(F.xxhash64("id"), "id").limit(pivots).toArrow()
    points = np.unique(lifted(np.array(chosen["v"].to_pylist()), top), axis=0)
    prefix = min(prefix, len(points))
    marked = rows.filter(is_query) if id_col == "id" else rows.withColumnRenamed("id", id_col).filter(is_query).withColumnRenamed(id_col, "id")
    index, n_index = _numbered(written(_packed(rows, block_rows, d, top, points, prefix), "permutation-index"), "i")
    asked, n_asked = _numbered(written(_packed(marked, query_rows, d, None, points, prefix), "permutation-queries"), "j")
    if not n_asked:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    # the stated query set against all rows, block by block
    left = index.withColumn("j", F.explode(F.sequence(F.lit(0), F.lit(n_asked - 1))))
    right = asked.select("j", *(F.col(c).alias(f"q_{c}") for c in ("ids", "x", "perm"))).withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(n_index - 1))))
    both = left.join(right, ["i", "j"])
    n_pivots = len(points)

    def run(batches):
        for batch in batches:
            for row in range(len(batch)):
                ids, x, perm, q_ids, q_x, q_perm = (batch.column(c)[row].as_py() for c in ("ids", "x", "perm", "q_ids", "q_x", "q_perm"))
                found = search(_unpacked(ids, x, perm, d, prefix), _unpacked(q_ids, q_x, q_perm, d, prefix), k, share, n_pivots)
                yield pa.RecordBatch.from_arrays([pa.array(found[0], pa.int64()), pa.array(found[1], pa.int64()), pa.array(found[2], pa.float64())], names=["query_id", "vec_id", "score"])

    found = mapped(both, run, answer)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
