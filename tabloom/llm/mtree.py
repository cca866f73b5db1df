"""Exact largest inner products through M-trees of paged metric nodes.

Vectors are made whole numbers, ``floor(scale c)``. With one more coordinate that lifts all vectors
to the largest norm (zero for a query), inner product falls as distance grows, so the vectors are
points of a metric space and the best inner products are the nearest points.

Index. Rows are routed to the nearest of at most ``roots`` root objects (distinct vectors with the
smallest hash of their id: a bounded sample of routing objects; every row is indexed). A root's rows
are one M-tree, or several (dealt by hash of the id) when they are more than ``tree_rows``, so a
group of equal vectors is spread as well. A tree is a set of pages, a row of a written table each.
An entry of an inner page holds a routing object, the covering radius of all below it, its
distance to the page's own routing object, and the number of the page below; an entry of a leaf
holds a vector, its distance to the page's routing object, and its id.

Search. Queries travel in blocks of neighbours (same root) and are best-first searched: the page
with the least possible distance for any query of the block is read next, until no page can beat
what its queries hold. |d(query, parent) - d(entry, parent)| > bound + radius, from stored distances
alone, rules an entry out before its distance is computed; after it, d(query, entry) - radius rules
out the page below. Bounds are of squared lengths of whole numbers, with a slack for the square root.

Two rounds: a query is first searched in its own tree, whose k-th score bounds its answer; then only
in the trees of roots whose ball may hold that score. (Block of queries, tree) pairs are dealt out so
that a tree meets ``blocks`` blocks per copy; a task holds one tree and one block.

Cases: null and empty vectors, vectors with null or non-finite components, and vectors whose length
is not the most frequent one (the smaller of equals) take no part; zero vectors do; equal scores are
ordered by id; a repeated id is a candidate once per row, and none of its rows answers a query of the
same id; rows that ask under one id share one answer, equal ones asking once; a null id is no query and
no candidate; with no usable rows the result is empty; components beyond 2^20 after scaling raise an
error, since scores would no longer be exact; further columns are not read, whatever their names.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabloom.llm.files import mapped
from tabloom.plans.written import written

LARGEST = 1 << 20
#: Entries of a leaf and of an inner page.
LEAF, FAN = 64, 32
ANSWER = "query_id long, vec_id long, score long"

# ---------------------------------------------------------------------- trees


class Space:
    """Distances between lifted rows of whole numbers (kept as doubles, which hold them exactly)."""

    def __init__(self, top: float):
        self.top = top

    def lift(self, x: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum(self.top - (x * x).sum(axis=-1), 0.0))

    def between(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Distances of data rows to one data row, both lifted."""
        square = (x * x).sum(axis=1) + (y * y).sum() - 2 * (x @ y)
        return np.sqrt(np.maximum(square, 0.0) + (self.lift(x) - self.lift(y)) ** 2)

    def asked(self, q_square: np.ndarray, dots: np.ndarray) -> np.ndarray:
        """Distances of queries to data rows, from squared lengths of queries and inner products."""
        return np.sqrt(np.maximum(q_square[:, None] + self.top - 2 * dots, 0.0))

    def bound(self, q_square: np.ndarray, score: np.ndarray) -> np.ndarray:
        """The distance at which a row has this score; a little more, so that rounding rules nothing out."""
        return np.sqrt(np.maximum(q_square + self.top - 2 * score, 0.0)) * (1 + 1e-9) + 1e-6


def grow(ids: np.ndarray, x: np.ndarray, space: Space, leaf: int = LEAF, fan: int = FAN) -> list[dict]:
    """The pages of a tree, root first. Rows must be in a fixed order; the tree depends on nothing else."""
    pages: list[dict] = []
    same = np.unique(x, axis=0, return_inverse=True)[1].reshape(-1) if len(x) else np.zeros(0, int)
    lift = space.lift(x)

    def page(rows: np.ndarray, parent: np.ndarray | None) -> int:
        number = len(pages)
        pages.append({})
        far = lambda y: np.zeros(len(y)) if parent is None else space.between(y, parent)
        if len(rows) <= leaf:
            pages[number] = {"leaf": True, "objects": x[rows], "refs": ids[rows], "radius": np.zeros(len(rows)), "to_parent": far(x[rows])}
            return number
        n = max(2, min(fan, -(-len(rows) // leaf)))
        different = np.unique(same[rows], return_index=True)[1]
        seeds = rows[different[np.linspace(0, len(different) - 1, min(n, len(different))).astype(int)]]
        own = np.zeros(len(rows), int)
        if len(seeds) > 1:
            to = np.column_stack([x[seeds], lift[seeds]])
            own = np.argmin((to * to).sum(axis=1) - 2 * (np.column_stack([x[rows], lift[rows]]) @ to.T), axis=1)
        groups = [(seeds[g], rows[own == g]) for g in range(len(seeds)) if (own == g).any()]
        if len(groups) == 1:  # equal vectors, cut evenly
            groups = [(groups[0][0], part) for part in np.array_split(rows, n)]
        objects = x[[seed for seed, _ in groups]]
        radius = np.array([space.between(x[part], x[seed]).max() for seed, part in groups])
        refs = [page(part, x[seed]) for seed, part in groups]
        pages[number] = {"leaf": False, "objects": objects, "refs": np.array(refs, np.int64), "radius": radius, "to_parent": far(objects)}
        return number

    if len(ids):
        page(np.arange(len(ids)), None)
    return pages


class Found:
    """The k best (score, smaller id first) of each query of a block."""

    def __init__(self, n: int, k: int, floor: np.ndarray):
        self.k, self.floor = k, floor  # a score below the floor cannot be in the answer
        self.score = np.full((n, k), -np.inf)
        self.id = np.full((n, k), np.iinfo(np.int64).max)

    def least(self) -> np.ndarray:
        return np.maximum(self.score[:, -1], self.floor)

    def offer(self, rows: np.ndarray, scores: np.ndarray, ids: np.ndarray, own: np.ndarray) -> None:
        scores = np.where(ids[None, :] == own[:, None], -np.inf, scores)
        least = self.least()[rows]
        some = (scores >= least[:, None]).any(axis=1)
        if not some.any():
            return
        rows, scores = rows[some], scores[some]
        score = np.concatenate([self.score[rows], scores], axis=1)
        ident = np.concatenate([self.id[rows], np.broadcast_to(ids, scores.shape)], axis=1)
        order = np.lexsort((ident, -score), axis=1)[:, : self.k]
        self.score[rows], self.id[rows] = np.take_along_axis(score, order, axis=1), np.take_along_axis(ident, order, axis=1)

    def rows(self, own: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        keep = (self.score > -np.inf) & (self.score >= self.floor[:, None])
        return np.repeat(own, keep.sum(axis=1)), self.id[keep], self.score[keep].astype(np.int64)


def search(pages: list[dict], space: Space, ids: np.ndarray, q: np.ndarray, floor: np.ndarray, k: int, counts: dict | None = None) -> Found:
    """Best-first over the pages of one tree for a block of queries. ``counts`` collects distances computed and ruled out."""
    found, square = Found(len(ids), k, floor), (q * q).sum(axis=1)
    # (what decides the turn, number of the entry, page, queries, their least and parent distances)
    todo, made = [(0.0, 0, 0, np.arange(len(ids)), np.zeros(len(ids)), None)] if pages else [], 1
    while todo:
        _, _, number, rows, nearest, parent = heapq.heappop(todo)
        page = pages[number]
        bound = space.bound(square[rows], found.least()[rows])
        alive = nearest <= bound
        if not alive.any():
            continue
        rows, bound = rows[alive], bound[alive]
        objects, refs, radius, to_parent = page["objects"], page["refs"], page["radius"], page["to_parent"]
        if parent is not None:
            parent = parent[alive]
            # stored distances alone: |d(query, parent) - d(entry, parent)| is at most the distance to the entry
            possible = np.abs(parent[:, None] - to_parent[None, :]) <= bound[:, None] + radius[None, :]
            entries, some = possible.any(axis=0), possible.any(axis=1)
            if counts is not None:
                counts["ruled_out"] = counts.get("ruled_out", 0) + int((~possible).sum())
            if not entries.any():
                continue
            if not entries.all():
                objects, refs, radius = objects[entries], refs[entries], radius[entries]
            if not some.all():
                rows, bound = rows[some], bound[some]
        dots = q[rows] @ objects.T
        if counts is not None:
            counts["computed"] = counts.get("computed", 0) + dots.size
        if page["leaf"]:
            found.offer(rows, dots, refs, ids[rows])
            continue
        far = space.asked(square[rows], dots)
        least = np.maximum(far - radius[None, :], 0.0)
        for e in range(len(refs)):
            go = least[:, e] <= bound
            if go.any():
                near = least[go, e]
                heapq.heappush(todo, (float((near - bound[go]).min()), made, int(refs[e]), rows[go], near, far[go, e]))
                made += 1
    return found


# ---------------------------------------------------------------------- Spark


def usable(table: DataFrame, id_col: str, vec_col: str, scale: int) -> DataFrame:
    """``id`` and ``v``, whole numbers, of the rows that take part."""
    finite = ~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = table.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("v"))
    rows = rows.filter(F.col("id").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0) & finite)
    small = lambda x: F.when(F.abs(x * scale) < LARGEST, F.floor(x * scale).cast("int")).otherwise(F.raise_error(F.lit("a component is too large for exact scores")))
    return rows.select("id", F.transform("v", small).alias("v"))


def _matrix(column, d: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, d)


def _binary(x: np.ndarray, kind=np.float64) -> bytes:
    return np.ascontiguousarray(x, kind).tobytes()


def _routed(rows: DataFrame, d: int, space: Space, roots: np.ndarray) -> DataFrame:
    """Rows with the number of their nearest root and their distance to it."""
    lifted = np.column_stack([roots, space.lift(roots)])
    square = (lifted * lifted).sum(axis=1)

    def run(batches):
        for batch in batches:
            if not len(batch):
                continue
            x = _matrix(batch.column("v"), d)
            near = np.argmin(square - 2 * (np.column_stack([x, space.lift(x)]) @ lifted.T), axis=1)
            far = np.zeros(len(x))
            for r in np.unique(near):
                far[near == r] = space.between(x[near == r], roots[r])
            packed = [_binary(v, np.int32) for v in x]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("asks"), pa.array(near.astype(np.int32)), pa.array(far), pa.array(packed, pa.binary())], names=["id", "asks", "root", "far", "v"])

    return mapped(rows, run, "id long, asks boolean, root int, far double, v binary")


PAGE = "tree long, page int, leaf boolean, objects binary, refs binary, radius binary, to_parent binary"


def _pages(routed: DataFrame, d: int, space: Space) -> DataFrame:
    """Rows (tree, id, v), whole trees together and in order of id and vector, made into pages."""

    def run(batches):
        held, ids, vectors = None, [], []

        def told():
            x = np.frombuffer(b"".join(vectors), np.int32).reshape(-1, d).astype(np.float64)
            out = grow(np.array(ids, np.int64), x, space)
            columns = [
                pa.array([held] * len(out), pa.int64()), pa.array(range(len(out)), pa.int32()), pa.array([p["leaf"] for p in out]),
                *(pa.array([_binary(p[c], kind) for p in out], pa.binary()) for c, kind in (("objects", np.int32), ("refs", np.int64), ("radius", float), ("to_parent", float))),
            ]
            return pa.RecordBatch.from_arrays(columns, names=["tree", "page", "leaf", "objects", "refs", "radius", "to_parent"])

        for batch in batches:
            for tree, ident, v in zip(*(batch.column(c).to_pylist() for c in ("tree", "id", "v"))):
                if tree != held:
                    if ids:
                        yield told()
                    held, ids, vectors = tree, [], []
                ids.append(ident)
                vectors.append(v)
        if ids:
            yield told()

    sorted_rows = routed.select("tree", "id", "v").repartition("tree").sortWithinPartitions("tree", "id", "v")
    return mapped(sorted_rows, run, PAGE)


BLOCK = "block long, root int, ids binary, q binary, floor binary"


def _blocks(queries: DataFrame, size: int) -> DataFrame:
    """Queries (tree, id, v, floor) in blocks of at most ``size`` of one tree, so of neighbours."""

    def run(batches):
        held, ids, vectors, floors, made = None, [], [], [], TaskContext.get().partitionId() << 32

        def told():
            columns = [[made], [held >> 32], [_binary(ids, np.int64)], [b"".join(vectors)], [_binary(floors)]]
            kinds = (pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=["block", "root", "ids", "q", "floor"])

        for batch in batches:
            for tree, ident, v, floor in zip(*(batch.column(c).to_pylist() for c in ("tree", "id", "v", "floor"))):
                if ids and (tree != held or len(ids) == size):
                    yield told()
                    made += 1
                    ids, vectors, floors = [], [], []
                held = tree
                ids.append(ident)
                vectors.append(v)
                floors.append(floor)
        if ids:
            yield told()

    dealt = queries.select("tree", "id", "v", "floor").repartition("tree").sortWithinPartitions("tree", "id", "v")
    return mapped(dealt, run, BLOCK)


def _answers(pages: DataFrame, meetings: DataFrame, d: int, space: Space, k: int, blocks: int) -> DataFrame:
    """Up to k rows per query and tree, for ``meetings(tree, block, ids, q, floor)``.

    Blocks of a tree are dealt into groups of about ``blocks``; a group reads the
    tree once, then its blocks one after the other.
    """
    meetings = meetings.withColumn("salt", F.xxhash64("block"))
    groups = meetings.groupBy("tree").agg(F.ceil(F.count(F.lit(1)) / blocks).cast("int").alias("groups"))
    none = F.lit(None).cast("binary")
    left = pages.join(groups, "tree").withColumn("g", F.explode(F.sequence(F.lit(0), F.col("groups") - 1)))
    left = left.select("tree", "g", F.lit(0).alias("kind"), "page", "leaf", "objects", "refs", "radius", "to_parent", *(none.alias(c) for c in ("ids", "q", "floor")))
    right = meetings.join(groups, "tree").withColumn("g", F.pmod(F.col("salt"), F.col("groups")).cast("int"))
    right = right.select("tree", "g", F.lit(1).alias("kind"), F.lit(0).alias("page"), F.lit(False).alias("leaf"), *(none.alias(c) for c in ("objects", "refs", "radius", "to_parent")), "ids", "q", "floor")
    both = left.unionByName(right).repartition("tree", "g").sortWithinPartitions("tree", "g", "kind", "page")

    def run(batches):
        at, pages = None, []
        for batch in batches:
            out = [[], [], []]
            for row in range(len(batch)):
                value = lambda c: batch.column(c)[row].as_py()  # noqa: E731, B023
                if at != (value("tree"), value("g")):
                    at, pages = (value("tree"), value("g")), []
                if value("kind") == 0:
                    objects = np.frombuffer(value("objects"), np.int32).reshape(-1, d).astype(np.float64)
                    numbers = {c: np.frombuffer(value(c), kind) for c, kind in (("refs", np.int64), ("radius", float), ("to_parent", float))}
                    pages.append({"leaf": value("leaf"), "objects": objects, **numbers})
                    continue
                ids = np.frombuffer(value("ids"), np.int64)
                q = np.frombuffer(value("q"), np.int32).reshape(-1, d).astype(np.float64)
                found = search(pages, space, ids, q, np.frombuffer(value("floor"), float), k)
                for column, values in zip(out, found.rows(ids)):
                    column.append(values)
            if out[0]:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c), pa.int64()) for c in out], names=["query_id", "vec_id", "score"])

    return mapped(both, run, ANSWER)


def top_products(
    table: DataFrame, is_query: Column, k: int = 20, scale: int = 64, *, id_col: str = "vec_id", vec_col: str = "embedding",
    roots: int = 1024, tree_rows: int = 8192, query_rows: int = 256, blocks: int = 32,
) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score`` for the rows that ``is_query`` (a condition on the id column) marks."""
    spark = table.sparkSession
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    rows = usable(table, id_col, vec_col, scale)
    square = F.aggregate("v", F.lit(0).cast("long"), lambda a, x: a + x.cast("long") * x)
    seen = rows.groupBy(F.size("v").alias("d")).agg(F.count(F.lit(1)).alias("n"), F.max(square).alias("top")).orderBy(F.desc("n"), "d").first()
    if seen is None:
        return empty
    d, n, space = seen["d"], seen["n"], Space(float(seen["top"]))
    rows = rows.filter(F.size("v") == d)
    wanted = max(1, min(roots, -(-2 * n // tree_rows)))
    sample = rows.orderBy(F.xxhash64("id"), "id", "v").limit(4 * wanted).toArrow()  # at most 4 x ``roots`` rows
    objects = np.unique(_matrix(sample["v"].combine_chunks(), d), axis=0)
    objects = objects[np.linspace(0, len(objects) - 1, min(wanted, len(objects))).astype(int)]
    named = rows.withColumnRenamed("id", id_col) if id_col != "id" else rows
    marked = named.withColumn("asks", F.coalesce(is_query, F.lit(False))).withColumnRenamed(id_col, "id")
    routed = written(_routed(marked, d, space, objects), "mtree-rows")
    per_root = routed.groupBy("root").agg(F.count(F.lit(1)).alias("n"), F.max("far").alias("radius"))
    per_root = {r["root"]: (-(-r["n"] // tree_rows), r["radius"]) for r in per_root.collect()}  # at most ``roots`` rows
    chunks = F.get(F.array(*(F.lit(per_root.get(r, (1, 0.0))[0]) for r in range(len(objects)))), F.col("root"))
    tree = (F.col("root").cast("long") * (1 << 32) + F.pmod(F.xxhash64("id"), chunks)).alias("tree")
    routed = routed.select("id", "asks", "root", "v", tree)
    pages = written(_pages(routed, d, space), "mtree-pages")

    asked = routed.filter("asks").dropDuplicates(["id", "v"])
    own = written(_blocks(asked.withColumn("floor", F.lit(float("-inf"))), query_rows), "mtree-queries")
    # first round: the trees of the query's own root bound its answer
    of_root = F.transform(F.sequence(F.lit(0), chunks - 1), lambda c: F.col("root").cast("long") * (1 << 32) + c)
    first = own.withColumn("tree", F.explode(of_root))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    near = _answers(pages, first, d, space, k, blocks).withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    near = written(near, "mtree-near")
    floors = near.filter(F.col("rank") == k).select(F.col("query_id").alias("id"), F.col("score").cast("double").alias("floor"))
    asked = asked.join(floors, "id", "left").withColumn("floor", F.coalesce("floor", F.lit(float("-inf"))))
    again = written(_blocks(asked, query_rows), "mtree-queries")
    numbers, radii = sorted(per_root), np.array([per_root[r][1] for r in sorted(per_root)])
    points, trees = objects[numbers], [per_root[r][0] for r in numbers]

    def needed(batches):
        """Each block with the trees that may hold a better row for one of its queries."""
        for batch in batches:
            for row in range(len(batch)):
                ids, q, floor = (np.frombuffer(batch.column(c)[row].as_py(), t) for c, t in (("ids", np.int64), ("q", np.int32), ("floor", float)))
                q = q.reshape(-1, d).astype(np.float64)
                length = (q * q).sum(axis=1)
                least = space.asked(length, q @ points.T) - radii
                go = least <= np.where(np.isneginf(floor), np.inf, space.bound(length, np.where(np.isneginf(floor), 0.0, floor)))[:, None]
                home = batch.column("root")[row].as_py()
                for k_root in np.flatnonzero(go.any(axis=0)):
                    root = numbers[k_root]
                    if root == home:
                        continue
                    mine = go[:, k_root]
                    n_trees = trees[k_root]
                    columns = [
                        pa.array([(root << 32) + c for c in range(n_trees)], pa.int64()), pa.array([batch.column("block")[row].as_py()] * n_trees, pa.int64()),
                        *(pa.array([value] * n_trees, pa.binary()) for value in (_binary(ids[mine], np.int64), _binary(q[mine], np.int32), _binary(floor[mine]))),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, names=["tree", "block", "ids", "q", "floor"])

    second = mapped(again, needed, "tree long, block long, ids binary, q binary, floor binary")
    rest = _answers(pages, second, d, space, k, blocks)
    found = near.select("query_id", "vec_id", "score").unionByName(rest)
    ranked = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


ORACLE = r"""
WITH good AS (SELECT vec_id, embedding FROM embeddings WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
x AS (SELECT vec_id, list_transform(embedding, lambda c: floor(64 * CAST(c AS DOUBLE))) AS v FROM good
    WHERE len(embedding) = (SELECT len(embedding) FROM good GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score FROM x q JOIN x c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 20
"""
