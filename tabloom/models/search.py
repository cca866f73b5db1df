"""Search over many classifiers: few fits, every candidate's ROC-AUC on every fold.

Candidates share what they can. The encoding of a fold is learned once for all families; scaling
statistics of all folds come from one aggregate. One tree per fold and encoding gives all smaller
depths: trees grow level by level, so cutting a deep tree gives the shallower one, and scaling a
column moves no split. One neighbour pass over all folds, encodings and scalings gives all numbers
of neighbours. Linear fits run side by side. All scores go through one grouped AUC.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.ml import Pipeline
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.util import inheritable_thread_target

from tabloom.models.classify import grouped_auc, linear_svm, logistic, tree_classifier
from tabloom.models.features import CategoryEncoder, build_pipeline, hash_number, levels
from tabloom.models.nearest import knn_shares
from tabloom.plans.sizing import packed
from tabloom.plans.written import written
from tabloom.session import shared_dir

#: Rows of a task of a fit.
FIT_ROWS = 100_000
ENCODINGS, SCALINGS = ("one_hot", "ordinal"), ("standard", "minmax", "none")


@dataclass(frozen=True)
class Candidate:
    model: str
    param: int | None
    encoding: str
    scaling: str


def candidates(
    ks: Sequence[int] = range(1, 20), depths: Sequence[int] = range(2, 11), families: Sequence[str] = ("knn", "tree", "svm", "logistic"),
    encodings: Sequence[str] = ENCODINGS, scalings: Sequence[str] = SCALINGS,
) -> list[Candidate]:
    """Every family with each of its parameters, each encoding and each scaling; 180 unless told otherwise."""
    params = {"knn": list(ks), "tree": list(depths), "svm": [None], "logistic": [None]}
    return [Candidate(m, p, e, s) for m in families for p in params[m] for s in scalings for e in encodings]


def _stats(data: DataFrame, num: Sequence[str], folds: int) -> list[dict[str, list[tuple[float, float]]]]:
    """Per fold and scaling, shift and width of each number column over the other folds' rows; one pass."""
    aggs = []
    for f in range(folds):
        for c in num:
            other = F.when(F.col("_fold") != f, F.col(c))
            aggs.append(F.struct(F.avg(other).alias("avg"), F.stddev_samp(other).alias("dev"), F.min(other).alias("min"), F.max(other).alias("max")).alias(f"s{f}_{c}"))
    row = data.agg(*aggs).first() if aggs else {}
    out = []
    for f in range(folds):
        own = [row[f"s{f}_{c}"] for c in num]
        safe = lambda x: float(x) if x else 1.0
        out.append({
            "standard": [(s["avg"] or 0.0, safe(s["dev"])) for s in own],
            "minmax": [(s["min"] or 0.0, safe((s["max"] or 0.0) - (s["min"] or 0.0))) for s in own],
            "none": [(0.0, 1.0)] * len(own),
        })
    return out


def _scaled(limits: Sequence[tuple[float, float]]) -> Column:
    """``cats`` and the scaled ``nums`` of a row as one array."""
    nums = [(F.col("nums")[i] - F.lit(a)) / F.lit(w) for i, (a, w) in enumerate(limits)]
    return F.concat("cats", F.array(*nums)) if nums else F.col("cats")


def _together(spark: SparkSession, tasks: Sequence[Callable], parallelism: int) -> list:
    with ThreadPoolExecutor(parallelism) as pool:
        return list(pool.map(lambda task: inheritable_thread_target(spark)(task)(), tasks))


# ---------------------------------------------------------------------- trees


def tree_nodes(spark: SparkSession, model, *more: str) -> dict[int, dict]:
    """Nodes of a fitted tree by number, as the model writes them; at most 2^(depth + 1) rows."""
    path = shared_dir(spark, "tree")
    model.write().save(path)
    return {r["id"]: r.asDict() for r in spark.read.parquet(f"{path}/data").select("id", "prediction", "impurityStats", "leftChild", "rightChild", *more).collect()}


def cut_scores(nodes: dict[int, dict], depth: int) -> list[float]:
    """Share of class 1 per leaf (numbered from the left) if the tree had been grown to ``depth`` only.

    As in the shallower tree, two leaves that predict the same class become one.
    """
    scores, leaf = [], iter(range(len(nodes)))

    def cut(n: int, left: int) -> list[tuple[float, list[float], list[int]]]:
        node = nodes[n]
        if node["leftChild"] < 0:
            return [(node["prediction"], node["impurityStats"], [next(leaf)])]
        a, b = cut(node["leftChild"], left - 1), cut(node["rightChild"], left - 1)
        own = [i for part in (*a, *b) for i in part[2]]
        if left <= 0 or (len(a) == len(b) == 1 and a[0][0] == b[0][0]):
            return [(node["prediction"], node["impurityStats"], own)]
        return a + b

    for _, stats, leaves in cut(0, depth):
        scores += [(i, stats[1] / sum(stats) if sum(stats) else 0.0) for i in leaves]
    return [s for _, s in sorted(scores)]


# --------------------------------------------------------------------- search


def fold_scores(
    df: DataFrame, key: str, label: str, cat: Sequence[str], order: dict[str, Sequence], num: Sequence[str], chosen: Sequence[Candidate],
    folds: int = 5, seed: int = 42, penalty: float = 0.0, svm_penalty: float = 0.01, parallelism: int = 4,
) -> DataFrame:
    """``candidate`` (its place in ``chosen``), ``fold``, ``auc``: each candidate fitted without the fold and scored on it.

    A row's fold comes from its key. ``label`` is 0/1, ``key`` a whole number. Category columns
    ``cat`` take the candidate's encoding, columns of ``order`` their given places.
    """
    spark = df.sparkSession
    fold = (hash_number(F.col(key), seed) % folds).cast("int").alias("_fold")
    numbers = [F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in num]
    # few, full tasks: a fit passes over its rows up to a hundred times, and a pass costs little per row
    data = packed(written(df.select(key, F.col(label).cast("double").alias(label), *cat, *order, *numbers, fold), "search"), FIT_ROWS)
    at = {c: n for n, c in enumerate(chosen)}
    used = [e for e in ENCODINGS if any(c.encoding == e for c in chosen)]
    scalings = [s for s in SCALINGS if any(c.scaling == s for c in chosen)]
    limits = _stats(data, num, folds)

    def encoded(f: int, e: str) -> DataFrame:
        """All rows, encoded by what the other folds' rows hold."""
        train = data.filter(F.col("_fold") != f)
        if cat or order:
            encoder = CategoryEncoder(cat, order) if e == "one_hot" else CategoryEncoder([], {c: levels(train, c) for c in cat} | dict(order))
            rows = encoder.fit(train).transform(data)
        else:
            rows = data.withColumn("_encoded", array_to_vector(F.array().cast("array<double>")))
        return rows.select(key, label, "_fold", vector_to_array("_encoded").alias("cats"), F.array(*num).cast("array<double>").alias("nums"))

    places = [(f, e) for f in range(folds) for e in used]
    # a written table per fold and encoding, which its fits and the neighbour pass read
    tables = _together(spark, [lambda f=f, e=e: written(encoded(f, e), "search-rows") for f, e in places], parallelism)
    rows_of = [packed(table, FIT_ROWS) for table in tables]
    depths = sorted({c.param for c in chosen if c.model == "tree"})
    linear = [m for m in ("svm", "logistic") if any(c.model == m for c in chosen)]

    def vectors(n: int, f: int, how: str) -> DataFrame:
        return rows_of[n].withColumn("features", array_to_vector(_scaled(limits[f][how])))

    def fit_tree(n, f, e):
        model = tree_classifier(max(depths), label, seed).fit(vectors(n, f, "none").filter(F.col("_fold") != f))
        nodes = tree_nodes(spark, model)
        scores = {d: cut_scores(nodes, d) for d in depths}
        # at most 2^depth leaves; as literals they would stand in the plan once per candidate
        per_leaf = spark.createDataFrame([(i, [scores[d][i] for d in depths]) for i in range(len(scores[depths[0]]))], "leaf int, found array<double>")
        test = model.setLeafCol("leaf").transform(vectors(n, f, "none").filter(F.col("_fold") == f))
        test = test.select(label, F.col("leaf").cast("int").alias("leaf")).join(F.broadcast(per_leaf), "leaf", "left")
        cells = [
            F.struct(F.lit(at[c]).alias("candidate"), F.col("found")[i].alias("score"))
            for i, d in enumerate(depths) for s in scalings if (c := Candidate("tree", d, e, s)) in at
        ]
        return test.select(label, F.lit(f).alias("fold"), F.explode(F.array(*cells)).alias("x")).select(label, "fold", "x.candidate", "x.score")

    def fit_linear(n, f, e, how, name):
        c = Candidate(name, None, e, how)
        if c not in at:
            return None
        fresh = linear_svm(label, svm_penalty) if name == "svm" else logistic(label, penalty)
        model = fresh.fit(vectors(n, f, how).filter(F.col("_fold") != f))
        weights = F.array(*(F.lit(float(w)) for w in model.coefficients.toArray()))
        test = rows_of[n].filter(F.col("_fold") == f).select(label, _scaled(limits[f][how]).alias("x"))
        margin = F.aggregate(F.zip_with("x", weights, lambda a, b: a * b), F.lit(0.0), lambda a, b: a + b) + F.lit(float(model.intercept))
        return test.select(label, F.lit(f).alias("fold"), F.lit(at[c]).alias("candidate"), margin.alias("score"))

    tasks = [lambda a=(n, f, e): fit_tree(*a) for n, (f, e) in enumerate(places)] if depths else []
    tasks += [lambda a=(n, f, e, s, m): fit_linear(*a) for n, (f, e) in enumerate(places) for s in scalings for m in linear]
    parts = [p for p in _together(spark, tasks, parallelism) if p is not None]

    ks = sorted({c.param for c in chosen if c.model == "knn"})
    if ks:
        which, fold_at = F.array(*(F.lit(f) for f, _ in places)), len(scalings)
        rows = None
        for n, table in enumerate(tables):
            part = table.select("*", F.explode(F.array(*(F.lit(n * fold_at + i) for i in range(fold_at)))).alias("space"))
            rows = part if rows is None else rows.unionByName(part)
        # one expression for all spaces: shift and width of a space's columns are looked up
        every = [x for f, _ in places for s in scalings for x in limits[f][s]]
        look = lambda i, side: F.get(F.lit([x[side] for x in every]), F.col("space") * len(num) + i)
        nums = [(F.col("nums")[i] - look(i, 0)) / look(i, 1) for i in range(len(num))]
        rows = rows.select(key, label, "_fold", "space", (F.concat("cats", F.array(*nums)) if nums else F.col("cats")).alias("v"))
        fold_of = F.get(which, F.floor(F.col("space") / fold_at).cast("int"))
        shares = knn_shares(rows, ks, "space", fold_of, "_fold", key, "v", label)
        number = F.array(*(F.array(*(F.lit(at.get(Candidate("knn", k, e, s), -1)) for k in ks)) for _, e in places for s in scalings))
        each = shares.withColumn("fold", fold_of).select(label, "fold", F.get(number, F.col("space")).alias("number"), F.posexplode("shares").alias("i", "score"))
        each = each.withColumn("candidate", F.get("number", F.col("i"))).filter(F.col("candidate") >= 0)
        parts.append(each.select(label, "fold", "candidate", "score"))
    scored = parts[0]
    for p in parts[1:]:
        scored = scored.unionByName(p)
    group = (F.col("candidate") * folds + F.col("fold")).cast("long")
    aucs = grouped_auc(scored.select(label, "score", group.alias("_group")), "_group", label, "score")
    return aucs.select(F.expr(f"cast(_group div {folds} AS int)").alias("candidate"), (F.col("_group") % folds).cast("int").alias("fold"), "auc")


def described(scores: DataFrame, chosen: Sequence[Candidate]) -> DataFrame:
    """Fold scores with what the candidate is: candidate, model, param, encoding, scaling, fold, auc."""
    names = [(n, c.model, c.param, c.encoding, c.scaling) for n, c in enumerate(chosen)]
    table = scores.sparkSession.createDataFrame(names, "candidate int, model string, param int, encoding string, scaling string")
    return F.broadcast(table).join(scores, "candidate")  # a row per candidate the caller listed


def best_of(scores: DataFrame) -> DataFrame:
    """One row: the candidate with the largest mean AUC over its folds (of equals the first), and that mean."""
    means = scores.groupBy("candidate").agg(F.avg("auc").alias("auc"))
    return means.orderBy(F.desc_nulls_last("auc"), "candidate").limit(1)


def as_pipeline(c: Candidate, rows: DataFrame, cat: Sequence[str], order: dict[str, Sequence], num: Sequence[str], label: str = "label") -> Pipeline:
    """The estimator that refits a chosen tree, support-vector or logistic candidate on ``rows``; neighbours need no fit."""
    if c.model == "knn":
        raise ValueError("nearest neighbours are searched, not fitted: use knn_classify")
    model = {"tree": lambda: tree_classifier(c.param, label), "svm": lambda: linear_svm(label), "logistic": lambda: logistic(label)}[c.model]()
    if c.encoding == "one_hot":
        return build_pipeline(cat, order, num, model, c.scaling)
    return build_pipeline([], {x: levels(rows, x) for x in cat} | dict(order), num, model, c.scaling)
