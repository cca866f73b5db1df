"""The shared fits of the search against one fit per candidate."""

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tabloom.models import classify, nearest, search
from tabloom.models.features import build_pipeline, hash_number
from tabloom.plans.written import written


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(4)
    n = 600
    x, kind, zone = rng.normal(size=(n, 2)), rng.integers(0, 4, n), rng.integers(0, 3, n)
    y = (x[:, 0] * (kind == 1) + 0.7 * x[:, 1] + 0.5 * (zone - 1) + 0.6 * rng.normal(size=n) > 0).astype(float)
    data = [(i, f"k{kind[i]}", f"z{zone[i]}", float(x[i, 0]) * 50 + 10, float(x[i, 1]), float(y[i])) for i in range(n)]
    return written(spark.createDataFrame(data, "id long, kind string, zone string, a double, b double, label double"), "search-test")


CAT, ORDER, NUM = ["kind"], {"zone": ["z0", "z1", "z2"]}, ["a", "b"]


def test_there_are_180_candidates():
    assert len(search.candidates()) == len(set(search.candidates())) == 180


@pytest.mark.parametrize("seed", [1, 2])
def test_a_cut_tree_is_the_shallower_tree(spark, rows, seed):
    data = build_pipeline(CAT, ORDER, NUM, None, "none").fit(rows).transform(rows.filter(F.col("id") % (seed + 2) != 0))
    deep = classify.tree_classifier(9).fit(data)
    nodes = search.tree_nodes(spark, deep)
    leaf = {r.id: int(r.leaf) for r in deep.setLeafCol("leaf").transform(data).select("id", "leaf").collect()}
    for depth in range(1, 10):
        scores = search.cut_scores(nodes, depth)
        shallow = classify.tree_classifier(depth).fit(data).transform(data)
        for r in shallow.select("id", vector_to_array("probability")[1].alias("p")).collect():
            assert scores[leaf[r.id]] == pytest.approx(r.p, abs=1e-12), depth


def test_fold_scores_equal_a_fit_per_candidate(rows):
    chosen = search.candidates([1, 6], [2, 5], ["knn", "tree", "svm", "logistic"], search.ENCODINGS, ["standard", "minmax"])
    got = {(r.candidate, r.fold): r.auc for r in search.fold_scores(rows, "id", "label", CAT, ORDER, NUM, chosen, folds=2).collect()}
    assert len(got) == 2 * len(chosen)
    data = rows.withColumn("_fold", (hash_number(F.col("id"), 42) % 2).cast("int"))
    for n, c in enumerate(chosen):
        if n % 3:
            continue  # a fit per candidate is what the search avoids
        for fold in range(2):
            train, test = data.filter(F.col("_fold") != fold), data.filter(F.col("_fold") == fold)
            if c.model == "knn":
                order = ORDER if c.encoding == "one_hot" else {"kind": ["k0", "k1", "k2", "k3"]} | ORDER
                pipe = build_pipeline(CAT if c.encoding == "one_hot" else [], order, NUM, None, c.scaling).fit(train)
                near = nearest.k_nearest(pipe.transform(train), pipe.transform(test), c.param, "id", "features", "label")
                scored = near.groupBy("query_id").agg(F.avg("tag").alias("score")).join(test.select(F.col("id").alias("query_id"), "label"), "query_id")
            else:
                scored = classify.score(search.as_pipeline(c, train, CAT, ORDER, NUM).fit(train), test, ["label"])
            want = classify.auc_rank(scored, "label", "score").first().auc
            assert got[n, fold] == pytest.approx(want, abs=1e-9 if c.model in ("knn", "tree") else 5e-3), (c, fold)


def test_the_best_is_found_and_refitted(rows):
    chosen = search.candidates([3], [2, 4], ["tree", "logistic"], ["ordinal"], ["none"])
    scores = search.fold_scores(rows, "id", "label", CAT, ORDER, NUM, chosen, folds=3)
    best = search.best_of(scores).first()
    means = {r.candidate: r.m for r in scores.groupBy("candidate").agg(F.avg("auc").alias("m")).collect()}
    assert best.auc == max(means.values()) and means[best.candidate] == best.auc
    table = search.described(scores, chosen)
    assert table.columns == ["candidate", "model", "param", "encoding", "scaling", "fold", "auc"] and table.count() == 9
    assert search.as_pipeline(chosen[best.candidate], rows, CAT, ORDER, NUM).fit(rows).transform(rows).count() == 600
    with pytest.raises(ValueError):
        search.as_pipeline(search.Candidate("knn", 3, "one_hot", "none"), rows, CAT, ORDER, NUM)


def test_grouped_auc_against_pairs(spark):
    rng = np.random.default_rng(0)
    rows = [(int(g), float(y), float(s)) for g, y, s in zip(rng.integers(0, 6, 900), rng.integers(0, 2, 900), rng.integers(0, 9, 900))]
    rows += [(50, 1.0, 2.0), (50, 1.0, 3.0)] + [(60, 0.0, None), (60, 1.0, 2.0), (60, 0.0, 1.0)]
    got = {r.g: r.auc for r in classify.grouped_auc(spark.createDataFrame(rows, "g int, y double, s double"), "g", "y", "s").collect()}
    for g in {r[0] for r in rows}:
        pos = [s for h, y, s in rows if h == g and y == 1 and s is not None]
        neg = [s for h, y, s in rows if h == g and y == 0 and s is not None]
        wins = sum((p > q) + (p == q) / 2 for p in pos for q in neg)
        assert got[g] == (pytest.approx(wins / (len(pos) * len(neg))) if pos and neg else None)


def _pairs(t, q, k):
    dist = np.round(np.sqrt(((q[:, None] - t[None]) ** 2).sum(2)), 9)
    return [sorted(range(len(t)), key=lambda j: (dist[i, j], j))[:k] for i in range(len(q))]


@pytest.mark.parametrize("rows_per_pivot, cell_rows", [(30, 32_768), (30, 20), (10**6, 64)])
def test_neighbours_through_pivots_and_cells(spark, monkeypatch, rows_per_pivot, cell_rows):
    """Tight groups far apart, one of them hot and of equal vectors; far from zero, so products alone would lose digits."""
    monkeypatch.setattr(nearest, "CELL_ROWS", cell_rows)
    rng = np.random.default_rng(5)
    centre = rng.normal(size=(8, 3)) * 40 + 1e4
    t = np.vstack([centre[rng.integers(0, 8, 260)] + rng.normal(size=(260, 3)), np.tile(centre[0], (140, 1))])
    q = np.vstack([centre[rng.integers(0, 8, 50)] + rng.normal(size=(50, 3)), centre[:1], t[:3], [[0.0, 0.0, 0.0]]])
    train = spark.createDataFrame([(i, v.tolist(), i % 3) for i, v in enumerate(t)], "id long, v array<double>, y int").repartition(4)
    query = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(q)], "id long, v array<double>").repartition(3)
    got = {}
    for r in nearest.k_nearest(train, query, 9, "id", "v", "y", 16, rows_per_pivot=rows_per_pivot).collect():
        got.setdefault(r.query_id, {})[r.place] = r.near_id
    assert [[got[i][p] for p in range(1, 10)] for i in range(len(q))] == _pairs(t, q, 9)


def test_spaces_are_apart(spark):
    rng = np.random.default_rng(6)
    rows = [(s, i, rng.normal(size=2 + 0 * s).tolist(), i % 2) for s in (4, 9) for i in range(70)]
    df = spark.createDataFrame(rows, "s int, id long, v array<double>, y int")
    got = nearest.k_nearest(df.filter("id >= 20"), df.filter("id < 20"), 4, "id", "v", "y", space_col="s").collect()
    for s in (4, 9):
        own = [np.array(r[2]) for r in rows if r[0] == s]
        for i, want in enumerate(_pairs(np.array(own[20:]), np.array(own[:20]), 4)):
            assert [r.near_id - 20 for r in sorted(got, key=lambda r: r.place) if (r.space, r.query_id) == (s, i)] == want
    assert nearest.k_nearest(df, df.filter("id < 0"), 4, "id", "v", "y").count() == 0


def _plain_shapley(score, x, z):
    """Average over all orders of what a feature adds when it turns from the background row into the row."""
    from itertools import permutations

    phi, orders = np.zeros(len(x)), list(permutations(range(len(x))))
    for order in orders:
        now = z.copy()
        for f in order:
            before = score(now)
            now[f] = x[f]
            phi[f] += (score(now) - before) / len(orders)
    return phi


def test_exact_attribution_of_trees_and_margins(spark, rows):
    from tabloom.models import attribution

    prep = build_pipeline(CAT, ORDER, NUM, None, "none").fit(rows)
    data = prep.transform(rows)
    base, some = data.filter("id < 23"), data.filter("id >= 590")
    vectors = {r.id: r.x for r in data.select("id", vector_to_array("features").alias("x")).collect()}
    tree = classify.tree_classifier(4).fit(data)
    boxes = attribution.tree_leaves(spark, tree)

    def of_tree(v):
        return next(value for value, box in boxes if all(a < v[f] <= b for f, (a, b) in box.items()))

    scored = {r.id: r.score for r in classify.score(tree, some, ["id"]).collect()}
    assert all(of_tree(np.array(vectors[i])) == pytest.approx(s) for i, s in scored.items())
    linear = classify.logistic(penalty=0.05).fit(data)
    weights = linear.coefficients.toArray()
    n = len(weights)
    found = {"tree": attribution.tree_attribution(tree, some, "id", n, base.repartition(4)), "linear": attribution.linear_attribution(linear, some, "id", base)}
    for name, score in (("tree", of_tree), ("linear", lambda v: float(weights @ v))):
        got = {}
        for r in found[name].collect():
            got.setdefault(r.id, np.zeros(n))[r.feature] = r.phi
        assert len(got) == 10
        for i in list(got)[:3]:
            want = np.mean([_plain_shapley(score, np.array(vectors[i]), np.array(vectors[k])) for k in range(23)], axis=0)
            assert np.allclose(got[i], want, atol=1e-9)


def test_sampled_attribution_tends_to_the_exact_one(spark, rows):
    from tabloom.models import attribution

    data = build_pipeline([], {}, NUM, None, "none").fit(rows).transform(rows)
    tree = classify.tree_classifier(3).fit(data)
    base, some = data.filter("id < 10"), data.filter("id >= 580")
    exact = {(r.id, r.feature): r.phi for r in attribution.tree_attribution(tree, some, "id", 2, base).collect()}
    # two features have two orders; many draws hold both about equally often
    sampled = attribution.attribution(tree, some.select("id", "features"), "id", 2, base, n_perm=200)
    assert all(abs(exact[r.id, r.feature] - r.phi) < 0.08 for r in sampled.collect())
    with pytest.raises(Exception, match="at most"):
        wide = spark.range(6000).select(F.lit(1.0).alias("a"), F.lit(2.0).alias("b"), F.col("id"))
        attribution.attribution(tree, some.select("id", "features"), "id", 2, build_pipeline([], {}, NUM, None, "none").fit(rows).transform(wide), n_perm=1).collect()


def test_equal_training_vectors_are_kept_as_often_as_they_can_be_found(spark, monkeypatch):
    """A space with few different vectors holds k rows of each at most; ties still go to the smallest ids."""
    held = []
    inner = nearest._cells
    monkeypatch.setattr(nearest, "_cells", lambda train, *a: (held.append(train.count()), inner(train, *a))[1])
    rows = [(i, i % 2, [float(i % 5)], (i // 7) % 2) for i in range(1000)]
    df = spark.createDataFrame(rows, "id int, s int, v array<double>, y int")
    train, query = df.filter("id >= 20"), df.filter("id < 20")
    got = nearest.k_nearest(train, query, 4, "id", "v", "y", space_col="s").collect()
    assert held == [2 * 5 * 4]
    for q, s, v, _ in rows[:20]:
        want = sorted((abs(w[0] - v[0]), i, y) for i, t, w, y in rows[20:] if t == s)[:4]
        assert sorted((r.dist, r.near_id, r.tag) for r in got if r.query_id == q) == want


@pytest.mark.parametrize("twice", [False, True])
def test_neighbours_through_boxes_and_leaves(spark, monkeypatch, twice):
    """Spaces of more rows than a cell holds: ties on a grid, a hot vector, a far query; compared pairs stay well below all."""
    monkeypatch.setattr(nearest, "CELL_ROWS", 100)
    monkeypatch.setattr(nearest, "BOX_ROWS", 60)
    monkeypatch.setattr(nearest, "LEAF_ROWS", 16)
    rng = np.random.default_rng(8)
    t = {s: np.vstack([rng.integers(0, 6, (500, w)) * 10.0 + (s == 2) * rng.normal(size=(500, w)), np.full((60, w), 30.0)]) for s, w in ((2, 3), (5, 2))}
    q = {s: np.vstack([v[:40], rng.normal(size=(20, v.shape[1])) * 20 + 25, np.full((1, v.shape[1]), 1e4)]) for s, v in t.items()}
    train = spark.createDataFrame([(s, i, x.tolist(), i % 3) for s, v in t.items() for i, x in enumerate(v)], "s int, id long, v array<double>, y int").repartition(3)
    query = spark.createDataFrame([(s, i, x.tolist()) for s, v in q.items() for i, x in enumerate(v)], "s int, id long, v array<double>")
    asked = query.unionByName(query.filter("id < 5")) if twice else query
    got = {}
    for r in nearest.k_nearest(train, asked, 7, "id", "v", "y", space_col="s").collect():
        got.setdefault((r.space, r.query_id), {})[r.place] = (r.near_id, r.tag)
    for s in t:
        for i, want in enumerate(_pairs(t[s], q[s], 7)):
            if twice and i < 5:  # a key that stands twice shares its places
                want = [j for j in want for _ in range(2)][:7]
            assert [got[s, i][p] for p in range(1, 8)] == [(j, j % 3) for j in want], (s, i)


def test_a_query_meets_near_leaves_only(monkeypatch):
    """What a query is compared with does not grow with the rows of its cell."""
    met = []
    inner = nearest._near
    monkeypatch.setattr(nearest, "_near", lambda q, t, *a: (met.append(len(q) * len(t)), inner(q, t, *a))[1])
    rng = np.random.default_rng(9)
    pairs = []
    for n in (8_000, 32_000):
        t, q = rng.random((n, 2)), rng.random((50, 2))
        met.clear()
        dist, ids, _, found = nearest._Leaves(np.arange(n), t, np.zeros(n, np.int32)).nearest(q, np.full(50, np.inf), 5)
        assert (found == 5).all() and ids.tolist() == _pairs(t, q, 5)
        pairs.append(sum(met))
    assert pairs[1] < 1.3 * pairs[0] < 0.5 * 50 * 8_000
