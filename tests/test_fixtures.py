"""What SQL cannot check, against brute force or known answers on small frames."""

import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tabloom.models import attribution, classify, features, nearest
from tabloom.operators import joins, markup, stats


def lev(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        prev, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            prev, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, prev + (x != y))
    return row[-1]


@pytest.mark.parametrize("threshold", [0.9, 0.75, 0.6])
def test_fuzzy_join_finds_every_best_match(spark, threshold):
    rng = random.Random(3)
    known = sorted({"north " + "".join(rng.choice("abc") for _ in range(rng.randint(1, 22))) for _ in range(60)} | {"a", "ab"})

    def edit(s):
        for _ in range(rng.randint(0, 4)):
            i = rng.randint(0, len(s))
            s = rng.choice([s[:i] + "x" + s[i:], s[:i] + s[i + 1:], s[:i] + "y" + s[i + 1:]])
        return s

    asked = [edit(s) for s in known] + [None, "zzz"]
    want = {}
    for a in asked:
        scored = [(-(1 - lev(a, k) / max(len(a), len(k), 1)), k) for k in known] if a else []
        best = min(scored, default=(0, None))
        want[a] = best[1] if -best[0] >= threshold - 1e-12 else None
    left = spark.createDataFrame([(i, a) for i, a in enumerate(asked)], "i int, name string")
    right = spark.createDataFrame([(k, k.upper()) for k in known], "known string, code string")
    rows = joins.fuzzy_join(left, right, "name", "known", threshold).collect()
    assert len(rows) == len(asked)
    assert {r.name: r.known for r in rows} == want
    assert all((r.code is None) == (r.known is None) for r in rows)


def test_phi_k_properties(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=4000)
    pdf = pd.DataFrame({"x": x, "same": x * 2, "near": x + rng.normal(size=4000), "noise": rng.normal(size=4000),
                        "cat": np.where(x > 0, "up", "down")})
    rows = stats.association_matrix(spark.createDataFrame(pdf), list(pdf.columns), ["x", "same", "near", "noise"]).collect()
    got = {(r.a, r.b): r.phi_k for r in rows}
    assert got["x", "same"] == pytest.approx(1.0)
    assert 0.5 < got["x", "near"] < 0.95
    assert got["x", "noise"] < 0.2
    assert got["x", "cat"] > 0.8
    assert all(0 <= v <= 1 for v in got.values())
    # a sample of a bivariate normal, cut as the definition cuts it, gives its correlation back
    chi = stats._binned_normal_chi2(0.6, 10, 10)
    assert stats.phi_k(chi * 1e9, 1e9, 10, 10) < 0.6


def test_ols_against_lstsq(spark):
    rng = np.random.default_rng(5)
    n = 300
    pdf = pd.DataFrame({"a": rng.normal(size=n), "b": rng.normal(3, 2, size=n), "year": rng.integers(2000, 2004, n)})
    pdf["y"] = 1.5 + 2 * pdf.a - pdf.b + (pdf.year == 2002) * 3 + rng.normal(size=n)
    fit = stats.ols(spark.createDataFrame(pdf), "y", ["a", "b"], "year")
    x = np.column_stack([pdf.a, pdf.b] + [(pdf.year == v).astype(float) for v in (2001, 2002, 2003)] + [np.ones(n)])
    beta, *_ = np.linalg.lstsq(x, pdf.y, rcond=None)
    got = fit.coefficients.toPandas()
    assert got.term.tolist() == ["a", "b", "year_2001", "year_2002", "year_2003", "const"]
    assert np.allclose(got.coef, beta)
    resid = pdf.y - x @ beta
    s2 = (resid**2).sum() / (n - 6)
    assert np.allclose(got.se, np.sqrt(np.diag(np.linalg.inv(x.T @ x)) * s2))
    r2 = 1 - (resid**2).sum() / ((pdf.y - pdf.y.mean()) ** 2).sum()
    s = fit.summary.first()
    assert s.r2 == pytest.approx(r2)
    assert s.f == pytest.approx((r2 / 5) / ((1 - r2) / (n - 6)))
    eig = np.linalg.eigvalsh(x.T @ x)
    assert s.condition == pytest.approx(np.sqrt(eig[-1] / eig[0]), rel=1e-6)


def test_f_tail():
    # with 1 and 1 degrees of freedom the tail is 1 - 2/pi * atan(sqrt(f))
    for f in (0.3, 1.0, 7.0):
        assert stats.f_tail(f, 1, 1) == pytest.approx(1 - 2 / np.pi * np.arctan(np.sqrt(f)))
    # with 2 and d degrees it is (1 + 2f/d)^(-d/2)
    assert stats.f_tail(3.0, 2, 10) == pytest.approx((1 + 0.6) ** -5)


@pytest.mark.parametrize("block_rows", [8, 10_000])
def test_k_nearest_against_brute_force(spark, block_rows):
    rng = np.random.default_rng(2)
    t = np.round(rng.normal(size=(300, 4)), 1)
    t[50:60] = t[49]
    q = np.vstack([t[49:52], rng.normal(size=(20, 4))])
    train = spark.createDataFrame([(i, v.tolist(), int(i % 3)) for i, v in enumerate(t)], "id long, v array<double>, y int").repartition(5)
    query = spark.createDataFrame([(1000 + i, v.tolist()) for i, v in enumerate(q)], "id long, v array<double>")
    rows = nearest.k_nearest(train, query, 7, "id", "v", "y", block_rows).collect()
    dist = np.round(np.sqrt(((q[:, None] - t[None]) ** 2).sum(2)), 9)
    for i in range(len(q)):
        want = sorted(range(len(t)), key=lambda j: (dist[i, j], j))[:7]
        got = [r.near_id for r in sorted((r for r in rows if r.query_id == 1000 + i), key=lambda r: r.place)]
        assert got == want


def test_stratified_split(spark):
    df = spark.createDataFrame([(i, "a" if i < 300 else "b") for i in range(400)], "id int, y string")
    train, test = features.stratified_split(df, "y", "id")
    assert {r.y: r["count"] for r in test.groupBy("y").count().collect()} == {"a": 75, "b": 25}
    assert train.count() == 300 and train.join(test, "id").count() == 0
    again = features.stratified_split(df.repartition(9), "y", "id")[1]
    assert sorted(r.id for r in again.collect()) == sorted(r.id for r in test.collect())


@pytest.fixture(scope="module")
def separable(spark):
    rng = np.random.default_rng(4)
    n = 400
    pdf = pd.DataFrame({"id": range(n), "strong": rng.normal(size=n), "weak": rng.normal(size=n),
                        "kind": rng.choice(["p", "q", "r"], n), "size": rng.choice(["s", "m", "l"], n)})
    pdf["label"] = ((pdf.strong + 0.2 * rng.normal(size=n)) > 0).astype(float)
    return spark.createDataFrame(pdf)


def test_grid_search_scores_and_unknown_levels(spark, separable):
    train, test = features.stratified_split(separable, "label", "id")
    make = lambda model, num: features.build_pipeline(["kind"], {"size": ["s", "m", "l"]}, num, model)
    good, bad = make(classify.logistic(), ["strong", "weak"]), make(classify.tree_classifier(2), ["weak"])
    best, scores = classify.grid_search(train, [bad, good], "id", folds=3)
    by = {r.candidate: r.auc for r in scores.collect()}
    assert by[1] > 0.95 > by[0]
    strange = test.withColumn("kind", F.lit("never seen")).withColumn("size", F.lit(None).cast("string"))
    scored = classify.score(best.bestModel, strange, ["id", "label"])
    assert classify.auc_rank(scored, "label", "score").first().auc > 0.95


def test_auc_rank_matches_evaluator_and_counts_ties_half(spark):
    df = spark.createDataFrame([(1, 0.9), (0, 0.9), (1, 0.4), (0, 0.1)], "y int, s double")
    assert classify.auc_rank(df, "y", "s").first().auc == pytest.approx((0.5 + 1 + 0 + 1) / 4)


def test_attribution_sums_to_the_change_of_score(spark, separable):
    names = ["strong", "weak"]
    prep = features.build_pipeline([], {}, names, None).fit(separable)
    data = prep.transform(separable)
    model = classify.logistic(penalty=0.01).fit(data)
    base = attribution.background(data, "id", 1)
    phi = attribution.attribution(model, data, "id", 2, base, n_perm=4)
    total = {r.id: r.t for r in phi.groupBy("id").agg(F.sum("phi").alias("t")).collect()}
    scored = {r.id: r.score for r in classify.score(model, data, ["id"]).collect()}
    start = classify.score(model, base, ["id"]).first().score
    assert all(total[i] == pytest.approx(scored[i] - start, abs=1e-9) for i in total)
    mean = {r.feature: r.mean_abs for r in attribution.mean_attribution(phi, names).collect()}
    assert mean["strong"] > 5 * mean["weak"]
    loss = {r.feature: r.loss for r in attribution.permutation_importance(model, data, "id", "label", names).collect()}
    assert loss["strong"] > 0.2 > abs(loss["weak"])


def test_cards_survive_scripts_and_missing_fields(spark):
    html = (
        "<script>var t = '<div class=\"card\">';</script><!-- <div class=\"card\"> -->"
        '<div class="card"><div><a href="/1">One &amp; <b>more</b></a></div><p class="price"> 10 </p><button>Buy</button></div>'
        '<div class="card"><a href="/2">Two</a></div><ul><li><a href="/next">&gt;</a></li></ul>'
    )
    pages = spark.createDataFrame([(1, html), (2, "<p>empty</p>"), (3, None)], "id int, html string")
    fields = {"name": r"(?s)<a[^>]*>(.*?)</a>", "price": r'(?s)class="price">(.*?)</p>', "button": r"<button>(.*?)</button>"}
    cards = markup.extract_cards(pages, "html", r'<div class="card">', fields, ["id"]).orderBy("card").collect()
    assert [(c.id, c.name, c.price, c.button) for c in cards] == [(1, "One & more", "10", "Buy"), (1, "Two", "", "")]
    assert [tuple(r) for r in markup.next_page(pages, "html", "id").collect()] == [(1, "/next")]


def test_joins_have_no_cartesian_product(spark):
    left = spark.createDataFrame([("abcdefghij",)], "name string")
    right = spark.createDataFrame([("abcdefghik",)], "known string")
    plan = joins.fuzzy_join(left, right, "name", "known")._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_knn_search_prefers_a_sensible_k(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(200, 2))
    y = (x[:, 0] + 0.8 * rng.normal(size=200) > 0).astype(int)
    df = spark.createDataFrame([(i, v.tolist(), int(t)) for i, (v, t) in enumerate(zip(x, y))], "id long, v array<double>, y int")
    got = {r.k: r.auc for r in nearest.knn_search(df, [1, 15], "id", "v", "y", folds=2).collect()}
    assert got[15] > got[1] > 0.5
