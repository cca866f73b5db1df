"""Whitening of embeddings: pivoted Cholesky of the centred scatter, then one-sided Jacobi on the factor.

Components are made whole numbers, ``floor(scale c) + offset``, so sums are exact. The scatter is
summed over vectors centred before multiplying (by the whole number nearest the mean; what is left
of the mean is taken off the sums exactly), block by block in exact arithmetic. Sums of tasks are
rows of (row of the matrix, its numbers as text) that are added up by matrix row; what reaches the
driver is one d x d matrix, whatever the number of vectors.

The factor. With the largest diagonal entry left as the next pivot, C = L L^T (rows in pivot order)
with columns of falling size, cut where nothing but rounding is left. One-sided Jacobi then turns
pairs of columns of L until all are orthogonal: L J = U S. Column norms squared are the eigenvalues
of C, normalised columns its eigenvectors; C itself is never turned, so small eigenvalues keep their
relative accuracy. Disjoint pairs are turned together, dealt out as in a round-robin tournament.

Cases: null vectors, empty vectors, vectors with null or non-finite entries and vectors whose length
is not the most frequent one (the smaller of equals) take no part and give no rows; a null id is
kept; repeated rows count and answer each; an empty table gives no rows; a component without
variance (all vectors equal, or fewer independent directions than components) has ``explained`` 0 and
null ``whitened``, and is left out of ``identity_error``, which is null if no component is left; of
components with equal eigenvalues any basis may come; entries beyond 2^62 are held there; a deviation
beyond a long is null; further columns are not read, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloom.llm.files import mapped
from tabloom.plans.written import written

#: Whole numbers up to here are exact in a double, and the largest that an entry may become.
EXACT, LARGEST = 1 << 53, 1 << 62

# ------------------------------------------------------------------ algebra


def pivoted_cholesky(c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``l`` (d x rank, rows in their own order) with c = l l^T, and the pivots in order."""
    d = len(c)
    left, order, columns = np.array(c.diagonal(), float), np.arange(d), []
    limit = d * np.finfo(float).eps * max(left.max(initial=0.0), 0.0)
    done = np.zeros(d, bool)
    for k in range(d):
        p = int(np.argmax(np.where(done, -np.inf, left)))
        if left[p] <= limit:
            break
        column = np.array(c[:, p], float)
        if columns:
            before = np.array(columns)
            column -= before.T @ before[:, p]
        column /= np.sqrt(left[p])
        column[done] = 0.0
        column[p] = np.sqrt(left[p])
        done[p] = True
        order[k] = p
        columns.append(column)
        left = np.where(done, 0.0, left - column * column)
    return np.array(columns).reshape(len(columns), d).T, order[: len(columns)]


def rounds(n: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """All pairs of n columns as rounds of disjoint pairs."""
    ring = list(range(n)) + ([-1] if n % 2 else [])
    out = []
    for _ in range(len(ring) - 1):
        half = len(ring) // 2
        pairs = [(a, b) for a, b in zip(ring[:half], ring[:half - 1 : -1]) if a >= 0 and b >= 0]
        out.append((np.array([p[0] for p in pairs]), np.array([p[1] for p in pairs])))
        ring = [ring[0], ring[-1], *ring[1:-1]]
    return out if n > 1 else []


def jacobi(l: np.ndarray, sweeps: int = 60) -> np.ndarray:
    """``l`` with its columns turned until they are orthogonal, largest first."""
    u, turn = np.array(l, float), rounds(l.shape[1])
    small = 4 * np.finfo(float).eps
    for _ in range(sweeps):
        worst = 0.0
        for a, b in turn:
            x, y = u[:, a], u[:, b]
            xx, yy, xy = (x * x).sum(axis=0), (y * y).sum(axis=0), (x * y).sum(axis=0)
            off = np.abs(xy) / np.sqrt(np.maximum(xx * yy, np.finfo(float).tiny))
            worst = max(worst, float(off.max(initial=0.0)))
            go = off > small
            if not go.any():
                continue
            zeta = (yy - xx) / np.where(go, 2 * xy, 1.0)
            t = np.where(zeta >= 0, 1.0, -1.0) / (np.abs(zeta) + np.hypot(1.0, zeta))
            t = np.where(go, t, 0.0)
            c = 1 / np.hypot(1.0, t)
            s = c * t
            u[:, a], u[:, b] = c * x - s * y, s * x + c * y
        if worst <= small * l.shape[0]:
            break
    norms = np.sqrt((u * u).sum(axis=0))
    return u[:, np.argsort(-norms, kind="stable")]


def eigen(c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (falling) of a positive semidefinite matrix up to its rank, and unit eigenvectors as columns."""
    scale = float(np.abs(c.diagonal()).max(initial=0.0)) or 1.0
    u = jacobi(pivoted_cholesky(c / scale)[0])
    norms = np.sqrt((u * u).sum(axis=0))
    return norms**2 * scale, u / np.where(norms > 0, norms, 1.0)


# ---------------------------------------------------------------- exact sums


def whole(flat: np.ndarray, scale: int, offset: int) -> np.ndarray:
    """floor(scale c) + offset as 64-bit numbers."""
    x = np.floor(flat * float(scale))
    inside = np.abs(x) < LARGEST
    x = np.where(inside, x, 0.0).astype(np.int64) + np.where(inside, 0, np.sign(x)).astype(np.int64) * LARGEST
    return x + offset


def exact_products(y: np.ndarray) -> np.ndarray:
    """y^T y in Python's whole numbers; a block at a time as doubles where these are exact."""
    d = y.shape[1]
    total = np.zeros((d, d), object)
    top = max(abs(int(y.max(initial=0))), abs(int(y.min(initial=0))))
    rows = EXACT // max(1, top * top)
    if not rows:
        big = y.astype(object)
        return total + big.T.dot(big)
    rows = min(rows, 1 << 16)
    for k in range(0, len(y), rows):
        part = y[k : k + rows].astype(float)
        total = total + (part.T @ part).astype(np.int64).astype(object)
    return total


def _vectors(batch: pa.RecordBatch, name: str, d: int, scale: int, offset: int) -> np.ndarray:
    flat = batch.column(name).flatten().to_numpy(zero_copy_only=False)
    return whole(flat, scale, offset).reshape(len(batch), d)


def _added(rows: DataFrame, task, d: int, scale: int, offset: int, name: str) -> list[list[int]]:
    """Sums over all rows of what ``task`` makes of a block of vectors: a matrix of whole numbers, by its rows.

    Each task adds up its own blocks and returns a row per matrix row; a second
    round of tasks adds up each matrix row, so the driver gets one matrix.
    """

    def told(total):
        return pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int32()), pa.array([[str(v) for v in r] for r in total], pa.list_(pa.string()))], names=["i", "sums"])

    def run(batches):
        total = None
        for batch in batches:
            if len(batch):
                own = task(_vectors(batch, name, d, scale, offset))
                total = own if total is None else total + own
        if total is not None:
            yield told(total)

    def add(batches):
        held = {}
        for batch in batches:
            for i, sums in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                own = np.array([int(v) for v in sums], object)
                held[i] = held[i] + own if i in held else own
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.int32()), pa.array([[str(v) for v in r] for r in held.values()], pa.list_(pa.string()))], names=["i", "sums"])

    kind = "i int, sums array<string>"
    parts = mapped(rows, run, kind)
    summed = mapped(parts.repartition("i"), add, kind).collect()  # d rows of d numbers
    return [[int(v) for v in r["sums"]] for r in sorted(summed, key=lambda r: r["i"])]


# --------------------------------------------------------------------- Spark


def usable(table: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """``vec_id`` and ``v`` of the rows without null or non-finite entries."""
    finite = ~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = table.select(F.col(id_col).alias("vec_id"), F.col(vec_col).cast("array<double>").alias("v"))
    return rows.filter(F.col("v").isNotNull() & (F.size("v") > 0) & finite)


class Fit:
    """What the vectors decide: number, sums, components and their share of the variance."""

    def __init__(self, n: int, sums: list[int], scatter: list[list[int]], centre: list[int], components: int):
        d = len(sums)
        self.n, self.sums, self.d = n, sums, d
        rest = [s - n * c for s, c in zip(sums, centre)]  # what is left of the mean, times n
        # n^2 V is whole: each entry is rounded once
        v = np.array([[(n * scatter[i][j] - rest[i] * rest[j]) / (n * n) for j in range(d)] for i in range(d)], float)
        values, vectors = eigen(v)
        self.wanted, self.trace = min(components, d), float(np.trace(v))
        self.values, self.vectors = values[: self.wanted], vectors[:, : self.wanted]
        self.explained = [float(e) / self.trace for e in self.values] + [0.0] * (self.wanted - len(self.values))


def fitted(rows: DataFrame, d: int, n: int, scale: int, offset: int, components: int) -> Fit:
    """Two passes: sums, then products of centred vectors."""
    column_sums = lambda x: np.array([x.astype(object).sum(axis=0)], object)
    sums = _added(rows, column_sums, d, scale, offset, "v")[0]
    centre = [(2 * s + n) // (2 * n) for s in sums]

    def products(x):
        near = np.array(centre, object) if max(map(abs, centre)) >= LARGEST else np.array(centre, np.int64)
        wide = int(np.abs(x).max(initial=0)) >= LARGEST // 2 or near.dtype == object
        y = x.astype(object) - near.astype(object) if wide else x - near
        return exact_products(y)

    scatter = _added(rows, products, d, scale, offset, "v")
    return Fit(n, sums, scatter, centre, components)


def projected(rows: DataFrame, fit: Fit, scale: int, offset: int) -> DataFrame:
    """``vec_id``, exact ``deviation`` and the array ``w`` of whitened components."""
    n, sums, d = fit.n, fit.sums, fit.d
    weights = fit.vectors / np.sqrt(fit.values)
    missing = fit.wanted - len(fit.values)
    vec_id = rows.schema["vec_id"].dataType.simpleString()

    def run(batches):
        s = np.array(sums, object)
        safe = max(map(abs, sums)) < LARGEST
        for batch in batches:
            if not len(batch):
                continue
            x = _vectors(batch, "v", d, scale, offset)
            top = max(abs(int(x.max())), abs(int(x.min())))
            z = n * x - s.astype(np.int64) if safe and n * top < LARGEST else n * x.astype(object) - s
            peak = max(abs(int(z.max())), abs(int(z.min())))
            if peak * peak * d < LARGEST:
                far = pa.array((z * z).sum(axis=1).astype(np.int64))
            else:
                exact = (z.astype(object) ** 2).sum(axis=1)
                far = pa.array([int(v) if v < 1 << 63 else None for v in exact], pa.int64())
            w = (z.astype(float) / n) @ weights
            out = [r + [None] * missing for r in w.tolist()]
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), far, pa.array(out, pa.list_(pa.float64()))], names=["vec_id", "deviation", "w"])

    return mapped(rows, run, f"vec_id {vec_id}, deviation long, w array<double>")


def identity_error(found: DataFrame, k: int) -> float | None:
    """Largest absolute entry of the covariance of the first k whitened components minus the identity."""
    if not k:
        return None
    means = found.agg(*(F.avg(F.col("w")[i]).alias(f"m{i}") for i in range(k))).first()
    near = [F.col("w")[i] - F.lit(means[i]) for i in range(k)]
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    cov = found.agg(*(F.avg(near[i] * near[j]).alias(f"c{i}_{j}") for i, j in pairs)).first()
    return max(abs(c - (i == j)) for c, (i, j) in zip(cov, pairs))


def whitened(
    table: DataFrame, components: int = 8, scale: int = 1024, offset: int = 100_000, id_col: str = "vec_id", vec_col: str = "embedding"
) -> DataFrame:
    """A row per usable vector and component, numbered by falling variance."""
    rows = usable(table, id_col, vec_col)
    kind = rows.schema["vec_id"].dataType.simpleString()
    seen = rows.groupBy(F.size("v").alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "d").first()
    if seen is None:
        return table.sparkSession.createDataFrame(
            [], f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double")
    d, n = seen["d"], seen["n"]
    rows = rows.filter(F.size("v") == d)
    fit = fitted(rows, d, n, scale, offset, components)
    found = written(projected(rows, fit, scale, offset), "whitened")
    error = identity_error(found, len(fit.values))
    shares: Column = F.array(*(F.lit(e) for e in fit.explained))
    each = found.select("vec_id", "deviation", F.posexplode("w").alias("at", "whitened"))
    return each.select(
        "vec_id", (F.col("at") + 1).cast("int").alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened",
        F.get(shares, F.col("at")).alias("explained"), F.lit(error).cast("double").alias("identity_error"),
    )
