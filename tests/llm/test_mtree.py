"""Trees, bounds and whole answers against all inner products."""

import numpy as np
import pytest
from pyspark.sql import functions as F
from tabloom.llm import mtree as M
from tabloom.llm.queries import ORACLES, QUERIES

IS_QUERY = "vec_id % 20 = 0"


def frame(spark, rows, parts=3):
    return spark.createDataFrame([(i, v, 1, 2, 3) for i, v in rows], "vec_id long, embedding array<float>, rank int, tree int, root int").repartition(parts)


def plain(rows, k=20, scale=64):
    good = [(i, v) for i, v in rows if i is not None and v and all(c is not None and np.isfinite(c) for c in v)]
    x = [np.floor(scale * np.array(v, np.float32).astype(float)).astype(int) for _, v in good]
    out = []
    for n, (i, _) in enumerate(good):
        if i % 20 == 0:
            best = sorted((-int(x[n] @ x[m]), j) for m, (j, _) in enumerate(good) if j != i)[:k]
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(best)]
    return sorted(out)


def clustered(n, d, seed, spread=0.1):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((12, d))
    return (centres[rng.integers(0, 12, n)] + spread * rng.standard_normal((n, d))) * rng.choice([0.4, 1, 1.7], (n, 1))


def whole(n=1500, d=6, seed=5, spread=0.1):
    return np.floor(64 * clustered(n, d, seed, spread))


def test_pages_hold_every_row_and_true_bounds():
    x = np.concatenate([whole(), np.tile(whole(1, 6, 9), (700, 1))])
    ids, space = np.arange(len(x)) * 3 + 1, M.Space(float((x * x).sum(axis=1).max()))
    pages = M.grow(ids, x, space)
    row = {i: v for i, v in zip(ids.tolist(), x)}

    def below(n):
        p = pages[n]
        if p["leaf"]:
            assert len(p["refs"]) <= M.LEAF
            return p["refs"].tolist()
        assert len(p["refs"]) <= M.FAN
        out = []
        for e, child in enumerate(p["refs"].tolist()):
            mine, routing = below(child), p["objects"][e]
            far = space.between(np.array([row[i] for i in mine]), routing)
            assert far.max() <= p["radius"][e] + 1e-9
            assert np.allclose(pages[child]["to_parent"], space.between(pages[child]["objects"], routing))
            out += mine
        return out

    assert sorted(below(0)) == ids.tolist() and len(pages) > len(x) // M.LEAF
    assert M.grow(ids[:0], x[:0], space) == []


def test_search_is_exact_and_rules_entries_out():
    x = whole(4000, 6, 2)
    ids, space = np.arange(len(x)), M.Space(float((x * x).sum(axis=1).max()))
    pages, counts = M.grow(ids, x, space), {}
    q = x[::400]
    found = M.search(pages, space, ids[::400], q, np.full(len(q), -np.inf), 7, counts)
    for n, i in enumerate(ids[::400]):
        s = x @ q[n]
        s[i] = -np.inf
        want = sorted(range(len(x)), key=lambda j: (-s[j], j))[:7]
        assert found.id[n].tolist() == want and found.score[n].tolist() == [s[j] for j in want]
    assert counts["ruled_out"] > 0 and counts["computed"] < 0.7 * len(q) * len(x)


@pytest.mark.parametrize("options", [{}, {"tree_rows": 100, "query_rows": 7, "blocks": 2}, {"roots": 1}, {"roots": 40, "tree_rows": 60, "blocks": 1}])
def test_answers_equal_all_products(spark, options):
    rows = [(k, v.tolist()) for k, v in enumerate(clustered(1200, 8, 1))]
    rows += [(2000 + k, rows[40][1]) for k in range(300)]  # a hot vector, tied with itself
    bad = [(3000, None), (3020, []), (3040, [float("nan")] * 8), (3060, [None] + [1.0] * 7), (3080, [float("inf")] * 8), (3100, [1.0] * 5), (None, [1.0] * 8)]
    zero = [(3120, [0.0] * 8)]
    got = M.top_products(frame(spark, rows + bad + zero), F.expr(IS_QUERY), **options)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted(map(tuple, got.collect())) == plain(rows + zero)


def test_random_directions_negative_scores_and_repeated_ids(spark):
    rng = np.random.default_rng(8)
    rows = [(k, (-np.abs(v)).tolist() if k % 3 else v.tolist()) for k, v in enumerate(rng.standard_normal((500, 24)))]
    rows += [rows[7], (40, rows[40][1])]
    got = sorted(map(tuple, M.top_products(frame(spark, rows), F.expr(IS_QUERY), tree_rows=90).collect()))
    assert got == sorted(set(plain(rows)))
    assert not any(q == v for q, _, v, _ in got)


def test_few_rows_none_and_too_large(spark):
    rows = [(0, [1.0, 0.0]), (1, [0.5, 0.5]), (20, [0.0, 1.0])]
    assert sorted(map(tuple, M.top_products(frame(spark, rows), F.expr(IS_QUERY)).collect())) == plain(rows)
    assert M.top_products(frame(spark, []), F.expr(IS_QUERY)).count() == 0 and M.top_products(frame(spark, rows[1:2]), F.expr(IS_QUERY)).count() == 0
    named = frame(spark, rows).withColumnRenamed("vec_id", "name").withColumnRenamed("embedding", "id")
    assert M.top_products(named, F.col("name") == 20, id_col="name", vec_col="id").count() == 2
    with pytest.raises(Exception, match="too large"):
        M.top_products(frame(spark, [(0, [1e9, 0.0])]), F.expr(IS_QUERY)).collect()


def test_query_has_sql():
    assert "op13_mtree" in QUERIES and "op13_mtree" in ORACLES  # compared in test_oracles.py
