"""Recall and exact scores against brute force."""

import numpy as np
from pyspark.sql import functions as F

from tabloom.llm.permutation_index import Postings, nearest


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<float>, rank int, block int").repartition(3)


def brute(rows, k):
    x = np.array([v for _, v in rows], np.float32).astype(float)
    ids = np.array([i for i, _ in rows])
    out = {}
    for n, i in enumerate(ids):
        if i % 20 == 0:
            s = x @ x[n]
            keep = np.flatnonzero(ids != i)
            out[int(i)] = [int(ids[j]) for j in sorted(keep, key=lambda j: (-s[j], ids[j]))[:k]]
    return out


def answers(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


def test_footrule_of_prefixes():
    perm = np.array([[0, 1, 2], [2, 1, 0], [3, 4, 5], [1, 0, 3]], np.int16)
    assert Postings(perm, 6).footrule(np.array([0, 1, 2])).tolist() == [0, 4, 12, 4]


def test_recall_with_norms_and_small_blocks(spark):
    rng = np.random.default_rng(0)
    rows = [(k, (rng.standard_normal(16) * rng.choice([0.5, 1, 2])).astype(float).tolist()) for k in range(3000)]
    got, want = answers(nearest(frame(spark, rows), F.col("vec_id") % 20 == 0, k=20, block_rows=700, query_rows=64)), brute(rows, 20)
    assert set(got) == set(want) and all(len(v) == 20 for v in got.values())
    assert np.mean([len({i for i, _ in got[q]} & set(want[q])) / 20 for q in want]) >= 0.9
    x = {i: np.array(v, np.float32).astype(float) for i, v in rows}
    for q, found in got.items():
        assert all(abs(s - x[q] @ x[i]) < 1e-9 for i, s in found) and [s for _, s in found] == sorted((s for _, s in found), reverse=True)


def test_hot_vector_ties_and_rows_that_take_no_part(spark):
    rng = np.random.default_rng(1)
    hot = [1.0, 2.0, 3.0, 4.0]
    rows = [(k, hot) for k in range(600)] + [(600 + k, rng.standard_normal(4).tolist()) for k in range(200)]
    bad = [(1000, None), (1020, []), (1040, [0.0] * 4), (1060, [float("nan"), 1.0, 1.0, 1.0]), (1080, [None, 1.0, 1.0, 1.0]), (1100, [float("inf")] * 4), (1120, [1.0] * 7), (None, hot)]
    got = answers(nearest(frame(spark, rows + bad), F.col("vec_id") % 20 == 0, k=20, block_rows=256))
    want = brute(rows, 20)
    assert set(got) == set(want)
    for q in range(0, 600, 20):
        assert [i for i, _ in got[q]] == want[q]


def test_few_and_no_rows(spark):
    rows = [(0, [1.0, 0.0]), (1, [0.5, 0.5]), (20, [0.0, 1.0]), (0, [2.0, 0.0])]
    got = nearest(frame(spark, rows), F.col("vec_id") % 20 == 0, k=20)
    assert {r.vec_id for r in got.filter("query_id = 20").collect()} == {0, 1}
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert nearest(frame(spark, []), F.col("vec_id") % 20 == 0).count() == 0
    assert nearest(frame(spark, [(1, [1.0, 2.0])]), F.col("vec_id") % 20 == 0).count() == 0
