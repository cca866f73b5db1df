"""The factor and the turns against numpy's solver, and the whole query against exact fractions."""

from fractions import Fraction

import numpy as np
import pytest
from tabloom.llm import whitening as W
from tabloom.llm.queries import QUERIES

NAMES = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def frame(spark, rows, parts=3):
    return spark.createDataFrame([(i, v, 1, 2.0, 3) for i, v in rows], "vec_id long, embedding array<double>, component int, w double, v int").repartition(parts)


def plain(rows, k=8):
    """Whole numbers in exact fractions, then numpy's symmetric solver."""
    good = [(i, v) for i, v in rows if v and all(c is not None and np.isfinite(c) for c in v)]
    x = [[int(np.floor(1024 * np.float64(c))) + 100_000 for c in v] for _, v in good]
    n, d = len(x), len(x[0])
    s = [sum(r[j] for r in x) for j in range(d)]
    mean = [Fraction(t, n) for t in s]
    c = [[r[j] - mean[j] for j in range(d)] for r in x]
    v = np.array([[float(sum(r[i] * r[j] for r in c) / n) for j in range(d)] for i in range(d)])
    e, u = np.linalg.eigh(v)
    e, u = e[::-1][:k], u[:, ::-1][:, :k]
    w = np.array([[float(t) for t in r] for r in c]) @ u / np.sqrt(e)
    return [i for i, _ in good], n, [sum((n * a - t) ** 2 for a, t in zip(r, s)) for r in x], w, e / np.trace(v)


def vectors(n, d, seed=0, scale=1.0):
    rng = np.random.default_rng(seed)
    return (rng.standard_normal((n, d)) * 1.6 ** -np.arange(d) * scale).astype(np.float32).astype(float)


def test_cholesky_and_jacobi():
    rng = np.random.default_rng(3)
    for d, rank in ((1, 1), (2, 2), (7, 7), (12, 5), (33, 33)):
        b = rng.standard_normal((d, rank)) * 10.0 ** rng.integers(-5, 5, rank)
        c = b @ b.T
        l, order = W.pivoted_cholesky(c)
        assert np.allclose(l @ l.T, c, rtol=1e-12, atol=1e-12 * c.max()) and len(order) == l.shape[1] <= rank + 1
        assert np.allclose(np.triu(l[order], 1), 0)  # triangular in pivot order
        e, u = W.eigen(c)
        assert np.allclose(u.T @ u, np.eye(len(e)), atol=1e-12) and np.allclose((u * e) @ u.T, c, atol=1e-12 * c.max())
        assert list(e) == sorted(e, reverse=True)
    assert W.eigen(np.zeros((3, 3)))[0].size == 0
    pairs = [frozenset(p) for a, b in W.rounds(7) for p in zip(a.tolist(), b.tolist())]
    assert len(pairs) == len(set(pairs)) == 21


def test_small_eigenvalues_keep_their_digits():
    """A graded matrix, whose eigenvalues differ by twelve digits."""
    g = np.diag([1.0, 1e-3, 1e-6]) @ (np.eye(3) + 0.1) @ np.diag([1.0, 1e-3, 1e-6])
    det = 1e-18 * 1.3  # det(I + 0.1) = 1 + 3 * 0.1
    assert abs(np.prod(W.eigen(g)[0]) / det - 1) < 1e-13


def test_exact_sums():
    rng = np.random.default_rng(1)
    for top in (10, 10**6, 10**9, 1 << 62):
        y = rng.integers(-top, top, (40, 5))
        assert (W.exact_products(y) == y.astype(object).T.dot(y.astype(object))).all()
    assert W.whole(np.array([0.5, -1e-9, 1e300, -1e300]), 1024, 100_000).tolist() == [100_512, 99_999, W.LARGEST + 100_000, 100_000 - W.LARGEST]


@pytest.mark.parametrize("parts", [1, 9])
def test_query_equals_exact_fractions(spark, tmp_path, parts):
    rows = [(k, v.tolist()) for k, v in enumerate(vectors(400, 12))]
    rows += [(1000, None), (1001, []), (1002, [float("nan")] * 12), (1003, [1.0] * 11 + [None]), (1004, [float("inf")] + [0.0] * 11), (None, rows[3][1]), (5, rows[5][1])]
    frame(spark, rows, parts).write.parquet(str(tmp_path / "embeddings.parquet"))
    got = QUERIES["op12_whitening"](spark, str(tmp_path))
    assert got.columns == NAMES
    ids, n, far, w, share = plain(rows)
    by = {}
    for r in got.collect():
        assert r.n == n and abs(r.explained / share[r.component - 1] - 1) < 1e-9 and 0 <= r.identity_error < 1e-9
        by.setdefault((r.vec_id, r.component), []).append((r.deviation, r.whitened))
    assert sum(map(len, by.values())) == 8 * n and len(by[5, 1]) == 2 and by[None, 1] == by[3, 1]
    for c in range(8):
        sign = np.sign(by[0, c + 1][0][1] * w[0, c])
        for row, i in enumerate(ids):
            assert by[i, c + 1][0][0] == far[row] and abs(by[i, c + 1][0][1] - sign * w[row, c]) < 1e-8


def test_offset_does_not_cost_digits(spark):
    """Far from zero with a tiny spread: products of uncentred vectors would be noise."""
    rows = [(k, (1e6 + v).tolist()) for k, v in enumerate(vectors(300, 5, 7, 0.05))]
    got = W.whitened(frame(spark, rows)).collect()
    _, n, far, w, share = plain(rows)
    for r in got:
        assert abs(abs(r.whitened) - abs(w[r.vec_id, r.component - 1])) < 1e-7 and r.deviation == far[r.vec_id]
        assert abs(r.explained / share[r.component - 1] - 1) < 1e-9 and r.identity_error < 1e-9


def test_without_variance_few_rows_other_lengths_and_huge_entries(spark):
    same = W.whitened(frame(spark, [(k, [1.0, 2.0, 3.0]) for k in range(50)] + [(99, [1.0, 2.0])])).collect()
    assert len(same) == 150 and {(r.whitened, r.explained, r.identity_error, r.deviation, r.n) for r in same} == {(None, 0.0, None, 0, 50)}
    line = W.whitened(frame(spark, [(k, [float(k), 2.0 * k]) for k in range(9)])).collect()
    assert {r.component: r.whitened is None for r in line} == {1: False, 2: True} and abs(line[0].identity_error) < 1e-9
    assert W.whitened(frame(spark, [])).columns == NAMES and W.whitened(frame(spark, [(1, None)])).count() == 0
    assert W.whitened(frame(spark, [(1, [1.0] * 4)])).count() == 4
    huge = W.whitened(frame(spark, [(1, [1e300, 0.0]), (2, [-1e300, 1.0]), (3, [0.0, 2.0])])).collect()
    assert len(huge) == 6 and {r.deviation for r in huge if r.vec_id == 1} == {None}
