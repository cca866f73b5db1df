"""Plan shapes against brute force in pandas, with hot keys and hot values."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tabloom.plans import exact_quantiles, kth_smallest, running_total, with_neighbours


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(7)
    n = 6000
    pdf = pd.DataFrame(
        {
            "id": np.arange(n),
            "k": np.where(rng.random(n) < 0.4, 0, rng.integers(1, 40, n)),
            "ts": rng.integers(0, 900, n),
            "v": np.where(rng.random(n) < 0.35, 5.0, rng.normal(0, 100, n).round(2)),
        }
    )
    pdf.loc[rng.random(n) < 0.3, "v"] = np.nan
    return pdf


@pytest.fixture(scope="module")
def df(spark, rows):
    frame = spark.createDataFrame(rows).repartition(7)
    return frame.withColumn("v", F.when(~F.isnan("v"), F.col("v")))


@pytest.mark.parametrize("accuracy,hot_rows", [(20, 0), (500, 1000), (10_000, 0), (10_000, 10**9)])
def test_exact_quantiles(df, rows, accuracy, hot_rows):
    qs = [0.0, 0.05, 0.25, 0.5, 0.751, 0.995, 1.0]
    got = exact_quantiles(df, "v", qs, accuracy=accuracy, hot_rows=hot_rows).first()
    assert got.n == rows.v.count()
    assert got.quantiles == pytest.approx(rows.v.quantile(qs).tolist())
    got = {r.k: r.quantiles for r in exact_quantiles(df, "v", qs, ["k"], accuracy, hot_rows).collect()}
    for k, g in rows.groupby("k"):
        assert got[k] == pytest.approx(g.v.quantile(qs).tolist())


@pytest.mark.parametrize("hot_rows", [0, 10**9])
def test_quantiles_by_keys_named_like_scratch_columns(spark, hot_rows):
    for key in ("_c", "_v", "_n", "_cell", "_fine", "_lo", "_end", "_key1"):
        df = spark.createDataFrame([("a", i % 2, float(i)) for i in range(20)], f"place string, `{key}` int, x double")
        got = {(r.place, r[key]): (r.n, r.quantiles) for r in exact_quantiles(df, "x", [0.5], ["place", key], hot_rows=hot_rows).collect()}
        assert got == {("a", 0): (10, [9.0]), ("a", 1): (10, [10.0])}, key


@pytest.mark.parametrize("hot_rows", [0, 10**9])
def test_quantiles_without_values(spark, hot_rows):
    empty = spark.createDataFrame([(1, None), (2, 3.0), (None, 4.0)], "k int, v double")
    got = {r.k: (r.n, r.quantiles) for r in exact_quantiles(empty, "v", [0.5], ["k"], hot_rows=hot_rows).collect()}
    assert got == {1: (0, [None]), 2: (1, [3.0])}
    none = exact_quantiles(empty.filter("k > 5"), "v", [0.5], hot_rows=hot_rows).collect()
    assert [(r.n, r.quantiles) for r in none] == [(0, [None])]


@pytest.mark.parametrize("hot_rows", [0, 1000, 10**9])
def test_kth_smallest(df, rows, hot_rows):
    got = {r.k: (r["rank"], r.kth) for r in kth_smallest(df, "id", 0.25, ["k"], hot_rows=hot_rows).collect()}
    # ids of rows whose value is null still count: the ranked column is the id
    for k, g in rows.groupby("k"):
        want = int(np.floor(0.25 * len(g) + 0.5))
        assert got[k][0] == want
        assert got[k][1] == (sorted(g.id)[want - 1] if want else None)


@pytest.mark.parametrize("n_blocks", [1, 4, 16])
def test_running_total(df, rows, n_blocks):
    filled = df.withColumn("v", F.coalesce("v", F.lit(0.0)))
    out = running_total(filled, -F.col("v"), F.col("id"), {"run": F.col("v"), "cnt": F.lit(1)}, n_blocks)
    got = out.select("id", "run", "cnt").toPandas().sort_values("id")
    want = rows.fillna({"v": 0.0}).sort_values(["v", "id"], ascending=[False, True])
    want = want.assign(run=want.v.cumsum(), cnt=np.arange(1, len(want) + 1)).sort_values("id")
    assert got.cnt.tolist() == want.cnt.tolist()
    assert np.allclose(got.run, want.run)


def _brute(g):
    g = g.sort_values(["ts", "id"]).copy()
    g["_pos"] = np.arange(1, len(g) + 1)
    g["_lag"], g["_lead"] = g.v.shift(1), g.v.shift(-1)
    g["_prev"], g["_next"] = g.v.ffill().shift(1), g.v.bfill().shift(-1)
    pos = g._pos.where(g.v.notna())
    g["_prev_pos"], g["_next_pos"] = pos.ffill().shift(1), pos.bfill().shift(-1)
    return g


@pytest.mark.parametrize("keys,hot_rows", [([], 0), (["k"], 10**9), (["k"], 500), (["k"], 0)])
def test_neighbours(df, rows, keys, hot_rows):
    out = with_neighbours(df, keys, "ts", "id", "v", hot_rows, n_blocks=9).toPandas().sort_values("id")
    want = pd.concat([_brute(g) for _, g in rows.groupby("k")]) if keys else _brute(rows)
    want = want.sort_values("id")
    for c in ["_pos", "_lag", "_lead", "_prev", "_next", "_prev_pos", "_next_pos"]:
        a, b = out[c].astype(float).to_numpy(), want[c].astype(float).to_numpy()
        assert np.array_equal(a, b, equal_nan=True), c
