"""Exact k nearest neighbours.

Pairs are never rows. Training rows and queries are dealt over a grid of cells, so a row is
copied once per column (or line) of its grid, not once per block of the other side; a task holds
the training part of a cell as a matrix and reads the cell's queries block by block, in fixed
memory, keeping k rows per query and cell.

Larger tables are first routed to the nearest of a bounded number of pivots (a hash sample of
training rows). Each pivot's training rows lie in a ball of known radius. A query is compared with its own pivot's
rows first; its k-th distance then rules out, by the triangle inequality, every pivot whose ball
is further away. Rows of a hot pivot are spread over as many cells as they need.

Searches with many spaces are of few number columns. There a cell's training rows form a tree of
halves, each leaf with the box its rows lie in, and a query meets only leaves whose box is not further away
than its k-th distance so far. A space of more rows than a cell holds is first cut into boxes in the same way (by a
bounded sample); a query meets its own box's rows, then those of the boxes its k-th distance reaches.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabloom.models.classify import grouped_auc
from tabloom.models.features import hash_number
from tabloom.plans.written import written

BLOCK_ROWS = 2_048
#: Rows of one side that a cell holds, rows that a pivot should have, and how many pivots there may be.
CELL_ROWS, PIVOT_ROWS, PIVOTS = 32_768, 16_384, 256
FOUND = "space int, query_id long, near_id long, dist double, tag int"
SLIM = "space int, id long, v array<double>, tag int"
#: Rows of a leaf, rows and number of boxes of a space, sampled rows of all spaces, and dimensions up to which boxes rule out anything.
LEAF_ROWS, BOX_ROWS, BOXES, BOX_SAMPLE, BOX_DIMS = 512, 16_384, 256, 100_000, 64
LISTS = "space int, query_id long, near array<struct<dist: double, near_id: long, tag: int>>, v array<double>, kth double, further array<int>"


def _near(q: np.ndarray, t: np.ndarray, ids: np.ndarray, tags: np.ndarray, k: int):
    """The k nearest training rows of each query, equal distances by id.

    Products of whole matrices choose the rows that may be among them; their
    distances are then taken from differences, so that equal vectors are at 0.
    """
    tt, qq = (t * t).sum(1), (q * q).sum(1)
    squared = qq[:, None] + tt[None, :] - 2.0 * q @ t.T
    rows, near = np.arange(len(q))[:, None], np.broadcast_to(np.arange(len(t)), squared.shape)
    if len(t) > 2 * k:
        slack = 1e-13 * (float(qq.max(initial=0)) + float(tt.max(initial=0)))
        kth = np.partition(squared, k - 1, axis=1)[:, k - 1 : k] + slack
        width = int((squared <= kth).sum(1).max())
        if width < len(t):
            near = np.argpartition(squared, width - 1, axis=1)[:, :width]
    dist = np.empty(near.shape)
    step = max(1, (1 << 22) // max(1, near.shape[1] * q.shape[1]))
    for a in range(0, len(q), step):
        gap = q[a : a + step, None, :] - t[near[a : a + step]]
        dist[a : a + step] = np.round(np.sqrt((gap * gap).sum(2)), 9)
    order = np.lexsort((ids[near], dist), axis=1)[:, :k]
    near = near[rows, order]
    return dist[rows, order], ids[near], tags[near]


def _merged(a, b, k: int):
    if a is None:
        return b
    dist, ids, tags = (np.concatenate(x, axis=1) for x in zip(a, b))
    order = np.lexsort((ids, dist), axis=1)[:, :k]
    rows = np.arange(len(dist))[:, None]
    return dist[rows, order], ids[rows, order], tags[rows, order]


def _halved(points: np.ndarray, size: int):
    """Points cut at the median of their widest dimension until ``size`` or fewer (or equal ones) are left.

    Per node the dimension (-1: a leaf), the cut, the two nodes below (a leaf: its number twice); the number of leaves.
    """
    dims, cuts, below, leaves, waiting = [-1], [0.0], [[0, 0]], 0, [(0, np.arange(len(points)))]
    while waiting:
        at, own = waiting.pop()
        if len(own) > size:
            p = points[own]
            with np.errstate(invalid="ignore"):
                d = int(np.argmax(np.where(p.max(0) > p.min(0), np.nan_to_num(p.std(0)), -1.0)))
                x = p[:, d]
                cut = np.median(x)
                if not cut < x.max():
                    cut = x[x < x.max()].max(initial=x.min())
            up = x > cut
            if up.any() and not up.all():
                dims[at], cuts[at], below[at] = d, float(cut), [len(dims), len(dims) + 1]
                waiting += [(len(dims) + 1, own[up]), (len(dims), own[~up])]
                dims, cuts, below = dims + [-1, -1], cuts + [0.0, 0.0], below + [[0, 0], [0, 0]]
                continue
        below[at], leaves = [leaves, leaves], leaves + 1
    return np.array(dims), np.array(cuts), np.array(below), leaves


def _leaf_of(tree, v: np.ndarray) -> np.ndarray:
    """The number of each vector's leaf."""
    dims, cuts, below, _ = tree
    at, rows = np.zeros(len(v), int), np.arange(len(v))
    while len(rows):
        rows = rows[dims[at[rows]] >= 0]
        now = at[rows]
        at[rows] = below[now, (v[rows, dims[now]] > cuts[now]).astype(int)]
    return below[at, 0]


def _gaps(q: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """A lower bound of each query's distance to any row of each box; rounding may only make it too small."""
    squared = np.zeros((len(q), len(low)))
    for d in range(q.shape[1]):
        x = q[:, d, None]
        gap = np.maximum(np.maximum(low[:, d] - x, x - high[:, d]), 0.0)
        squared += gap * gap
    reach = 1 + np.abs(q).max(initial=0) + max(np.abs(low).max(initial=0), np.abs(high).max(initial=0))
    return np.sqrt(squared) - 1e-9 - 1e-12 * reach


class _Leaves:
    """A cell's training rows by leaf, each leaf with its box."""

    def __init__(self, ids: np.ndarray, t: np.ndarray, tags: np.ndarray):
        self.tree = _halved(t, LEAF_ROWS)
        leaf = _leaf_of(self.tree, t)
        order = np.argsort(leaf, kind="stable")
        self.ids, self.t, self.tags = ids[order], t[order], tags[order]
        self.starts = np.searchsorted(leaf[order], np.arange(self.tree[3] + 1))
        self.low, self.high = np.minimum.reduceat(self.t, self.starts[:-1]), np.maximum.reduceat(self.t, self.starts[:-1])

    def nearest(self, q: np.ndarray, kth: np.ndarray, k: int):
        """The k nearest rows of each query no further away than its ``kth``, and how many there are."""
        n, none = len(q), np.iinfo(np.int64).max
        best = np.full((n, k), np.nan), np.full((n, k), none), np.zeros((n, k), np.int32)
        seen, home, gaps = np.zeros(n, int), _leaf_of(self.tree, q), _gaps(q, self.low, self.high)

        def meet(leaf: int, rows: np.ndarray):
            # comparisons are of the form "not further", so that what is no number is met
            rows = rows[~(gaps[rows, leaf] > np.fmin(kth[rows], best[0][rows, -1]))]
            if not len(rows):
                return
            part = slice(self.starts[leaf], self.starts[leaf + 1])
            found = _near(q[rows], self.t[part], self.ids[part], self.tags[part], k)
            for own, new in zip(best, _merged(tuple(x[rows] for x in best), found, k)):
                own[rows] = new
            seen[rows] += part.stop - part.start

        by_home = np.argsort(home, kind="stable")
        ends = np.searchsorted(home[by_home], np.arange(self.tree[3] + 1))
        for leaf in np.flatnonzero(np.diff(ends)):
            meet(leaf, by_home[ends[leaf] : ends[leaf + 1]])
        for leaf in np.argsort(gaps.mean(0)):
            meet(leaf, np.flatnonzero(home != leaf))
        far = (best[0] > kth[:, None]) | (np.isnan(best[0]) & np.isfinite(kth)[:, None]) | (np.arange(k) >= seen[:, None])
        return *best, k - far.sum(1)


def _cells(
    train: DataFrame, query: DataFrame, k: int, grid: dict[int, tuple[int, int]], block_rows: int,
    lists: bool = False, boxes: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] | None = None,
) -> DataFrame:
    """Up to k rows per query and cell. ``grid`` gives the lines (parts of the training rows) and columns of each space.

    With ``lists`` a row per query and cell, found through leaves: only what is no further away than the query's ``kth``.
    ``boxes`` (of further spaces: numbers, lower and upper corners) then names those within the k-th distance found.
    """
    spaces = sorted(grid)
    place = F.col("space") if spaces == [*range(len(spaces))] else F.array_position(F.lit(spaces), F.col("space")).cast("int") - 1
    lines, columns = (F.get(F.lit([grid[s][i] for s in spaces]), place) for i in (0, 1))
    hashed = F.xxhash64("id")
    every = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    left = (train.withColumn("kth", F.lit(0.0)) if lists else train).select("*", F.lit(0).alias("side"), F.pmod(hashed, lines).cast("int").alias("a"), every(columns).alias("b"))
    right = query.select("*", F.lit(1).alias("side"), F.pmod(hashed, columns).cast("int").alias("b"), every(lines).alias("a"))
    cells = sum(a * b for a, b in grid.values())
    # a number of its own: these rows are few bytes and much work, which adaptive coalescing cannot see
    dealt = left.unionByName(right).repartition(cells, "space", "a", "b").sortWithinPartitions("space", "a", "b", "side")

    # a search through leaves takes little memory per query and visits a leaf once per block
    most = 4 * block_rows if lists else block_rows

    def listed(leaves, space, q_ids, q, kth):
        """Rows of ``LISTS``: sorted neighbours, and the boxes that may hold nearer ones."""
        dist, ids, own, n = leaves.nearest(q, kth, k)
        keep = np.arange(k) < n[:, None]
        near = pa.StructArray.from_arrays([pa.array(c[keep]) for c in (dist, ids, own)], names=["dist", "near_id", "tag"])
        offsets = lambda m: pa.array(np.concatenate([[0], np.cumsum(m)]).astype(np.int32))
        kth = np.where(n >= k, dist[:, -1], kth)
        to = np.zeros((len(q), 0), bool)
        if boxes is not None:
            numbers, low, high = boxes[space]
            to = ~(_gaps(q, low, high) > kth[:, None]) & (numbers != space)
        on = to.any(1) if to.size else np.zeros(len(q), bool)
        targets = numbers[np.nonzero(to)[1]] if on.any() else np.zeros(0)
        cols = [
            pa.array(np.full(len(q), space, np.int32)), pa.array(q_ids), pa.ListArray.from_arrays(offsets(n), near),
            pa.ListArray.from_arrays(offsets(on * q.shape[1]), pa.array(q[on].ravel())), pa.array(kth),
            pa.ListArray.from_arrays(offsets(to.sum(1)), pa.array(targets.astype(np.int32))),
        ]
        return pa.RecordBatch.from_arrays(cols, names=["space", "query_id", "near", "v", "kth", "further"])

    def run(batches):
        at, held, waiting, n_waiting = None, [], [], 0

        def answer():
            if not held or not waiting:
                return None
            if len(held) > 1 and not lists:
                held[:] = [tuple(np.concatenate(c) for c in zip(*held))]
            if lists and not isinstance(held[0], _Leaves):
                held[:] = [_Leaves(*(np.concatenate(c) for c in list(zip(*held))[:3]))]
            q_ids, q, _, kth = (np.concatenate(c) for c in zip(*waiting))
            if lists:
                return listed(held[0], at[0], q_ids, q, kth)
            t_ids, t, tags, _ = held[0]
            best = None
            for x in range(0, len(t), 2 * block_rows):
                part = slice(x, x + 2 * block_rows)
                best = _merged(best, _near(q, t[part], t_ids[part], tags[part], k), k)
            dist, ids, own = best
            cols = [np.full(dist.size, at[0], np.int32), np.repeat(q_ids, dist.shape[1]), ids.ravel(), dist.ravel(), own.ravel()]
            return pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=["space", "query_id", "near_id", "dist", "tag"])

        for batch in batches:
            if not len(batch):
                continue
            keys = np.column_stack([batch.column(c).to_numpy() for c in ("space", "a", "b", "side")])
            ids, tags = batch.column("id").to_numpy(), batch.column("tag").to_numpy(zero_copy_only=False).astype("int32")
            kth = batch.column("kth").to_numpy() if lists else np.zeros(len(batch))
            flat, ends = batch.column("v").flatten().to_numpy(zero_copy_only=False), batch.column("v").offsets.to_numpy()
            ends = ends - ends[0]
            cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist(), len(ids)]
            for x, y in zip(cuts, cuts[1:]):
                v = flat[ends[x] : ends[y]].reshape(y - x, -1)  # vectors of different spaces may differ in length
                cell = tuple(keys[x, :3].tolist())
                if cell != at:
                    if (found := answer()) is not None:
                        yield found
                    at, held, waiting, n_waiting = cell, [], [], 0
                if keys[x, 3] == 0:
                    held.append((ids[x:y], v, tags[x:y], kth[x:y]))
                    continue
                for z in range(x, y, block_rows):
                    part = slice(z, min(y, z + block_rows))
                    waiting.append((ids[part], v[part.start - x : part.stop - x], tags[part], kth[part]))
                    n_waiting += part.stop - z
                    if n_waiting >= most:
                        if (found := answer()) is not None:
                            yield found
                        waiting, n_waiting = [], 0
        if (found := answer()) is not None:
            yield found

    return dealt.mapInArrow(run, LISTS if lists else FOUND)


def _shape(n: int, m: int, spare: int = 1) -> tuple[int, int]:
    """Lines and columns for n training rows and m queries: parts of bounded size, at least ``spare`` cells where rows suffice."""
    a, b = max(1, -(-n // CELL_ROWS)), max(1, -(-m // CELL_ROWS))
    while a * b < spare and (n / a > 256 or m / b > 256):
        a, b = (a + 1, b) if n / a > m / b else (a, b + 1)
    return a, b


def _best(found: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("space", "query_id").orderBy("dist", "near_id")
    return found.withColumn("place", F.row_number().over(w)).filter(F.col("place") <= k)


def _routed(rows: DataFrame, pivots: np.ndarray) -> DataFrame:
    """Rows with their nearest pivot as ``space`` and their distance to it as ``far``."""

    def run(batches):
        for batch in batches:
            if not len(batch):
                continue
            v = batch.column("v").flatten().to_numpy(zero_copy_only=False).reshape(len(batch), -1)
            own = np.argmin((pivots * pivots).sum(1) - 2 * (v @ pivots.T), axis=1)
            far = np.sqrt(((v - pivots[own]) ** 2).sum(1))
            yield pa.RecordBatch.from_arrays([pa.array(own.astype(np.int32)), *(batch.column(c) for c in ("id", "v", "tag")), pa.array(far)], names=["space", "id", "v", "tag", "far"])

    return rows.mapInArrow(run, SLIM + ", far double")


def _by_pivots(train: DataFrame, query: DataFrame, k: int, n: int, m: int, block_rows: int, rows_per_pivot: int) -> DataFrame:
    wanted = min(PIVOTS, max(2, n // rows_per_pivot))
    sample = train.orderBy(F.xxhash64("id"), "id").limit(wanted).toArrow()  # at most ``PIVOTS`` rows
    pivots = np.unique(np.array(sample["v"].to_pylist()), axis=0)
    train, query = written(_routed(train, pivots), "nearest-rows"), written(_routed(query, pivots), "nearest-queries")
    sides = {}
    for name, side in (("train", train), ("query", query)):
        for r in side.groupBy("space").agg(F.count(F.lit(1)).alias("n"), F.max("far").alias("far")).collect():  # a row per pivot
            sides.setdefault(r["space"], {})[name] = (r["n"], r["far"])
    size = lambda s, name: sides[s].get(name, (0, 0.0))[0]
    own = {s: _shape(size(s, "train"), size(s, "query")) for s in sides}
    slim = ["space", "id", "v", "tag"]
    near = written(_best(_cells(train.select(slim), query.select(slim), k, own, block_rows), k), "nearest-own")
    kth = near.filter(F.col("place") == k).select(F.col("query_id").alias("id"), F.col("dist").alias("kth"))
    asked = query.join(kth, "id", "left").select("space", "id", "v", "tag", F.coalesce("kth", F.lit(float("inf"))).alias("kth"))
    there = sorted(s for s in sides if size(s, "train"))
    points, radii = pivots[there], np.array([sides[s]["train"][1] for s in there])

    def needed(batches):
        """Each query once per further pivot whose ball may hold a nearer row."""
        for batch in batches:
            if not len(batch):
                continue
            v = batch.column("v").flatten().to_numpy(zero_copy_only=False).reshape(len(batch), -1)
            squared = (v * v).sum(1)[:, None] + (points * points).sum(1) - 2 * (v @ points.T)
            # rounding may only let in a pivot too many
            slack = 1e-6 * (1 + np.sqrt((v * v).sum(1)[:, None] + (points * points).sum(1)))
            go = np.sqrt(np.clip(squared, 0, None)) - radii - slack <= batch.column("kth").to_numpy()[:, None]
            go &= np.array(there)[None, :] != batch.column("space").to_numpy()[:, None]
            row, to = np.nonzero(go)
            # a query's vector goes to up to ``PIVOTS`` pivots: the copies of a whole batch are never held together
            for a in range(0, len(row), block_rows):
                take = pa.array(row[a : a + block_rows])
                yield pa.RecordBatch.from_arrays([pa.array(np.array(there, np.int32)[to[a : a + block_rows]]), *(batch.column(c).take(take) for c in ("id", "v", "tag"))], names=slim)

    further = asked.mapInArrow(needed, SLIM)
    rest = _cells(train.select(slim), further, k, {s: _shape(size(s, "train"), m) for s in there}, block_rows)
    both = near.drop("place").unionByName(rest).withColumn("space", F.lit(0))
    return _best(both, k)


def _joined(found: DataFrame, k: int) -> DataFrame:
    """One sorted list of up to k neighbours per space and query."""
    every = F.array_sort(F.flatten(F.collect_list("near")))
    return found.groupBy("space", "query_id").agg(F.slice(every, 1, k).alias("near"))


def _in_boxes(rows: DataFrame, trees: dict[int, tuple], base: dict[int, int]) -> DataFrame:
    """Rows with the number of their box as ``space``; the leaves of a space's tree are numbered from its base."""

    def run(batches):
        for batch in batches:
            if not len(batch):
                continue
            spaces = batch.column("space").to_numpy()
            flat, starts = batch.column("v").flatten().to_numpy(zero_copy_only=False), batch.column("v").offsets.to_numpy()
            starts, boxes = starts - starts[0], np.zeros(len(batch), np.int32)
            for s in np.unique(spaces).tolist():
                own = np.flatnonzero(spaces == s)
                width = starts[own[0] + 1] - starts[own[0]]
                boxes[own] = base[s] + _leaf_of(trees[s], flat[starts[own, None] + np.arange(width)])
            yield pa.RecordBatch.from_arrays([pa.array(boxes), *(batch.column(c) for c in ("id", "v", "tag"))], names=["space", "id", "v", "tag"])

    return rows.select("space", "id", "v", "tag").mapInArrow(run, SLIM)


def _by_boxes(train: DataFrame, query: DataFrame, k: int, sizes: dict[int, tuple[int, int]], dims: int, block_rows: int) -> DataFrame:
    """Lists of neighbours where a space has more training rows than a cell should hold: space, query_id, near."""
    total, spaces = sum(n for n, _ in sizes.values()), sorted(sizes)
    train, query = train.filter(F.col("space").isin(spaces)), query.filter(F.col("space").isin(spaces))
    repeated = not query.groupBy("space", "id").count().filter("count > 1").isEmpty()
    few = F.pmod(F.xxhash64("id", "v"), F.lit(1 << 30)) < int(min(1.0, BOX_SAMPLE / total) * (1 << 30))
    sample = train.filter(few).select("space", "v").limit(2 * BOX_SAMPLE).toArrow()
    of, flat = sample["space"].to_numpy(), sample["v"].combine_chunks()
    flat, starts = flat.flatten().to_numpy(zero_copy_only=False), flat.offsets.to_numpy() - flat.offsets[0].as_py()
    trees, base, box_space = {}, {}, []
    for s in spaces:
        own = np.flatnonzero(of == s)
        points = np.array([flat[starts[i] : starts[i + 1]] for i in own]) if len(own) else np.zeros((0, 1))
        boxes = min(BOXES, -(-sizes[s][0] // BOX_ROWS))
        trees[s], base[s] = _halved(points, max(1, -(-len(own) // boxes))), len(box_space)
        box_space += [s] * trees[s][3]
    # equal vectors are equally far from any query: of those only the k smallest ids can be among its k nearest
    same = Window.partitionBy("space", "v").orderBy("id")
    train = _in_boxes(train, trees, base).withColumn("_rank", F.row_number().over(same)).filter(F.col("_rank") <= k).drop("_rank")
    train, query = written(train, "nearest-distinct"), _in_boxes(query, trees, base)
    corners = [f(F.get("v", F.lit(d))).alias(f"{name}{d}") for name, f in (("low", F.min), ("high", F.max)) for d in range(dims)]
    held = {r["space"]: r for r in train.groupBy("space").agg(F.count(F.lit(1)).alias("n"), F.first("v").alias("v"), *corners).collect()}  # a row per box
    asked = {r["space"]: r["count"] for r in query.groupBy("space").count().collect()}
    boxes = {}
    for s in spaces:
        own = [b for b in range(base[s], base[s] + trees[s][3]) if b in held]
        low, high = (np.array([[held[b][f"{name}{d}"] for d in range(len(held[own[0]]["v"]))] for b in own]) for name in ("low", "high"))
        boxes |= dict.fromkeys(range(base[s], base[s] + trees[s][3]), (np.array(own, np.int32), low, high))
    # a box is not cut into lines: a search through its leaves grows little with its rows
    grid = lambda m: {b: (1, max(1, -(-m.get(b, 0) // BOX_ROWS))) for b in range(len(box_space))}
    own = written(_cells(train, query.withColumn("kth", F.lit(float("inf"))), k, grid(asked), block_rows, True, boxes), "nearest-own")
    further = own.select(F.explode("further").alias("space"), F.col("query_id").alias("id"), "v", F.lit(0).alias("tag"), "kth")
    on = {r["space"]: r["count"] for r in further.groupBy("space").count().collect()}
    rest = _cells(train, further, k, grid(on), block_rows, True).filter(F.size("near") > 0)
    # a query that stands once in its space and whose k-th distance reaches no other box is answered
    space = F.get(F.lit(box_space), F.col("space")).alias("space")
    own, rest = own.select(space, "query_id", "near", "further"), rest.select(space, "query_id", "near")
    if repeated:
        return _joined(own.drop("further").unionByName(rest), k)
    done, open_ = own.filter(F.size("further") == 0), own.filter(F.size("further") > 0)
    return done.drop("further").unionByName(_joined(open_.drop("further").unionByName(rest), k))


def _lists(rows: DataFrame, asked: DataFrame, k: int, block_rows: int) -> DataFrame:
    """The sorted neighbours of every query in its space: space, query_id, near."""
    spark = rows.sparkSession
    sides = rows.select("space", F.lit(0).alias("side")).union(asked.select("space", F.lit(1).alias("side")))
    sizes = {}
    for r in sides.groupBy("space", "side").count().collect():  # two rows per space
        sizes.setdefault(r["space"], [0, 0])[r["side"]] = r["count"]
    both = {s: tuple(x) for s, x in sizes.items() if all(x)}
    if not both:
        return spark.createDataFrame([], LISTS).select("space", "query_id", "near")
    if max(n for n, _ in both.values()) > CELL_ROWS and (dims := rows.agg(F.max(F.size("v"))).first()[0]) <= BOX_DIMS:
        return _by_boxes(rows, asked, k, both, dims, block_rows)
    # equal vectors are equally far from any query: of those only the k smallest ids can be among its k nearest
    same = Window.partitionBy("space", "v").orderBy("id")
    rows = written(rows.withColumn("_rank", F.row_number().over(same)).filter(F.col("_rank") <= k).drop("_rank"), "nearest-distinct")
    spare = -(-spark.sparkContext.defaultParallelism // len(both))
    grid = {s: _shape(n, m, spare) for s, (n, m) in both.items()}
    return _joined(_cells(rows, asked.withColumn("kth", F.lit(float("inf"))), k, grid, block_rows, True), k)


def _slim(df: DataFrame, id_col: str, vec_col: str, tag: Column, space_col: str | None) -> DataFrame:
    v = F.col(vec_col) if df.schema[vec_col].dataType.typeName() == "array" else vector_to_array(vec_col)
    space = F.col(space_col).cast("int") if space_col else F.lit(0)
    return df.select(space.alias("space"), F.col(id_col).cast("long").alias("id"), v.cast("array<double>").alias("v"), tag.cast("int").alias("tag"))


def k_nearest(
    train: DataFrame, query: DataFrame, k: int, id_col: str, vec_col: str, tag_col: str, block_rows: int = BLOCK_ROWS,
    space_col: str | None = None, rows_per_pivot: int = PIVOT_ROWS,
) -> DataFrame:
    """The k nearest training rows of every query row: query_id, near_id, dist, tag, place.

    With ``space_col`` (a whole number) both tables hold several searches; a
    query meets rows of its own space only, whose vectors have one length, and the
    result has the column ``space`` as well. The spaces are few.
    """
    rows, asked = _slim(train, id_col, vec_col, F.col(tag_col), space_col), _slim(query, id_col, vec_col, F.lit(0), space_col)
    names = ["query_id", "near_id", "dist", "tag", "place"]
    if space_col:
        near = _lists(rows, asked, k, block_rows).select("space", "query_id", F.posexplode("near").alias("at", "x"))
        return near.select("space", "query_id", "x.near_id", "x.dist", "x.tag", (F.col("at") + 1).alias("place"))
    n, m = rows.count(), asked.count()
    if not n or not m:
        return train.sparkSession.createDataFrame([], FOUND + ", place int").select(names)
    if n >= 2 * rows_per_pivot:
        return _by_pivots(rows, asked, k, n, m, block_rows, rows_per_pivot).select(names)
    found = _cells(rows, asked, k, {0: _shape(n, m, train.sparkSession.sparkContext.defaultParallelism)}, block_rows)
    return _best(found, k).select(names)


def knn_classify(
    train: DataFrame, query: DataFrame, k: int, id_col: str, vec_col: str, label: str, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """Majority label among the k nearest, ties to the smallest: id, prediction, votes."""
    near = k_nearest(train, query, k, id_col, vec_col, label, block_rows)
    votes = near.groupBy("query_id", "tag").agg(F.count(F.lit(1)).alias("n"))
    best = votes.groupBy("query_id").agg(F.min(F.struct((-F.col("n")).alias("n"), "tag")).alias("b"))
    return best.select(F.col("query_id").alias(id_col), F.col("b.tag").alias("prediction"), (-F.col("b.n")).alias("votes"))


def knn_shares(rows: DataFrame, ks: Sequence[int], space_col: str, fold_of_space: Column, fold_col: str, key: str, vec_col: str, label: str) -> DataFrame:
    """Share of label 1 among the k nearest rows of other folds, for every k: space, key, label, ``shares`` (in the order of ``ks``).

    ``rows`` holds each row once per space it lives in; in a space it is a query
    if its fold is the space's, else a training row. One pass, for the largest k,
    serves all spaces and all smaller k.
    """
    asks = F.col(fold_col) == fold_of_space
    near = _lists(_slim(rows.filter(~asks), key, vec_col, F.col(label), space_col), _slim(rows.filter(asks), key, vec_col, F.lit(0), space_col), max(ks), BLOCK_ROWS)
    at = np.array(ks)

    def run(batches):
        for batch in batches:
            if not len(batch):
                continue
            ends, tags = batch.column("tags").offsets.to_numpy(), batch.column("tags").flatten().to_numpy()
            upto, first = np.concatenate([[0], np.cumsum(tags.astype(np.int64))]), ends[:-1] - ends[0]
            n = np.minimum(at, np.diff(ends)[:, None])
            shares = (upto[first[:, None] + n] - upto[first][:, None]) / n
            lists = pa.ListArray.from_arrays(np.arange(0, shares.size + 1, len(at), dtype=np.int32), shares.ravel())
            yield pa.RecordBatch.from_arrays([batch.column("space"), batch.column("query_id"), lists], names=["space", "query_id", "shares"])

    scored = near.select("space", "query_id", F.col("near.tag").alias("tags")).mapInArrow(run, "space int, query_id long, shares array<double>")
    truth = rows.filter(asks).select(F.col(space_col).cast("int").alias("space"), F.col(key).cast("long").alias("query_id"), F.col(label).alias(label))
    return scored.join(truth, ["space", "query_id"]).withColumnRenamed("query_id", key)


def knn_search(
    df: DataFrame, ks: Sequence[int], key: str, vec_col: str, label: str, folds: int = 5, seed: int = 42
) -> DataFrame:
    """Cross-validated ROC-AUC of a 0/1 label for every k: k, auc (mean over the folds). A row's fold comes from its key."""
    marked = df.withColumn("_fold", (hash_number(F.col(key), seed) % folds).cast("int"))
    rows = marked.withColumn("_space", F.explode(F.sequence(F.lit(0), F.lit(folds - 1))))
    shares = knn_shares(rows, ks, "_space", F.col("_space"), "_fold", key, vec_col, label)
    each = shares.select(label, F.col("space"), F.posexplode("shares").alias("at", "score"))
    aucs = grouped_auc(each.withColumn("_group", F.col("space") * len(ks) + F.col("at")), "_group", label, "score")
    k_of = F.get(F.array(*map(F.lit, ks)), (F.col("_group") % len(ks)).cast("int"))
    return aucs.groupBy(k_of.alias("k")).agg(F.avg("auc").alias("auc"))
