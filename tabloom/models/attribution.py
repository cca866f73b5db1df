"""How much each feature moves a model's score."""

from __future__ import annotations

import math
import random
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabloom.models.classify import auc_rank
from tabloom.models.features import hash_number
from tabloom.models.search import tree_nodes
from tabloom.plans.blocks import running_total
from tabloom.plans.sizing import attach
from tabloom.plans.written import written

#: Rows of a sampled background, and the most that the sampled form takes.
BACKGROUND_ROWS, BACKGROUND_MOST = 100, 5_000


def background(df: DataFrame, key: str, rows: int = BACKGROUND_ROWS, seed: int = 42) -> DataFrame:
    """The sampled rows that stand for an absent feature: those with the smallest hashes."""
    return df.withColumn("_h", hash_number(F.col(key), seed)).orderBy("_h", key).limit(rows).drop("_h")


def attribution(
    model, df: DataFrame, key: str, n_features: int, base: DataFrame, n_perm: int = 8, seed: int = 42,
    features: str = "features",
) -> DataFrame:
    """Shapley values by sampled permutations: key, feature (index), phi.

    ``base`` is the table of :func:`background`, of at most ``BACKGROUND_MOST`` rows: it travels as one row.
    For each permutation and each background row, a row is turned, feature by
    feature, from the background row into itself. Every step is one scored row: it counts for the feature
    that was just set, and against the one that is set next. So the table grows
    to rows × permutations × background × (features + 1), is scored in one batch pass and
    collapses in one grouped sum. Linear margins and single trees have exact forms below.
    """
    rng = random.Random(seed)
    orders = [rng.sample(range(n_features), n_features) for _ in range(n_perm)]
    packed = base.select(vector_to_array(features).alias("x")).agg(F.collect_list("x").alias("_base"), F.count(F.lit(1)).alias("_n"))
    fail = F.raise_error(F.lit(f"a background has at most {BACKGROUND_MOST} rows"))
    packed = packed.select("_n", F.when(F.col("_n") <= BACKGROUND_MOST, F.col("_base")).otherwise(fail.cast("array<array<double>>")).alias("_base"))
    perms = F.array(*(F.struct(F.array(*map(F.lit, o)).alias("ordering")) for o in orders))
    rows = attach(df.select(key, vector_to_array(features).alias("_x")), packed)
    rows = rows.select(key, "_x", "_n", F.explode("_base").alias("bg")).select("*", F.inline(perms))
    steps = rows.select("*", F.explode(F.sequence(F.lit(0), F.lit(n_features))).alias("step"))
    mixed = F.transform(
        F.col("_x"),
        lambda v, i: F.when(F.array_position("ordering", i) <= F.col("step"), v).otherwise(F.element_at("bg", i + 1)),
    )
    scored = model.transform(steps.withColumn(features, array_to_vector(mixed)))
    raw = "probability" if "probability" in scored.columns else "rawPrediction"
    s = vector_to_array(F.col(raw))[1]
    effect = F.array(
        F.struct(F.try_element_at("ordering", F.nullif(F.col("step"), F.lit(0))).alias("feature"), s.alias("d")),
        F.struct(F.try_element_at("ordering", F.col("step") + 1).alias("feature"), (-s).alias("d")),
    )
    moves = scored.select(key, "_n", F.inline(effect)).filter("feature is not null")
    return moves.groupBy(key, "feature").agg((F.sum("d") / (n_perm * F.max("_n"))).alias("phi"))


def linear_attribution(model, df: DataFrame, key: str, base: DataFrame, features: str = "features") -> DataFrame:
    """Exact Shapley values of a linear model's margin: weight × (value − mean of the background); key, feature, phi.

    The background is one aggregate, whatever its size.
    """
    weights = [float(w) for w in model.coefficients.toArray()]
    x = vector_to_array(features)
    means = base.select(x.alias("x")).agg(*(F.avg(F.get("x", F.lit(i))).alias(f"_m{i}") for i in range(len(weights))))
    rows = attach(df.select(key, x.alias("_x")), means)
    phi = F.array(*(F.lit(w) * (F.get("_x", F.lit(i)) - F.col(f"_m{i}")) for i, w in enumerate(weights)))
    return rows.select(key, F.posexplode(phi).alias("feature", "phi"))


def tree_leaves(spark: SparkSession, model) -> list[tuple[float, dict[int, tuple[float, float]]]]:
    """Each leaf's share of class 1 and, per feature on its path, the interval (above, up to] that leads there."""
    nodes, out = tree_nodes(spark, model, "split"), []
    todo = [(0, {})]
    while todo:
        n, box = todo.pop()
        node = nodes[n]
        if node["leftChild"] < 0:
            stats = node["impurityStats"]
            out.append((stats[1] / sum(stats), box))
            continue
        split = node["split"]
        if split["numCategories"] >= 0:
            raise ValueError("splits by category are not read; give the categories as 0/1 slots")
        f, cut = split["featureIndex"], split["leftCategoriesOrThreshold"][0]
        low, high = box.get(f, (-math.inf, math.inf))
        todo += [(node["leftChild"], box | {f: (low, min(high, cut))}), (node["rightChild"], box | {f: (max(low, cut), high)})]
    return out


def _inside(x: np.ndarray, box: dict[int, tuple[float, float]]) -> np.ndarray:
    """For each row and path feature, whether the row's own value leads to the leaf."""
    return np.column_stack([(x[:, f] > a) & (x[:, f] <= b) for f, (a, b) in box.items()]) if box else np.zeros((len(x), 0), bool)


def tree_attribution(model, df: DataFrame, key: str, n_features: int, base: DataFrame, features: str = "features") -> DataFrame:
    """Exact Shapley values of a tree's share of class 1 against all background rows: key, feature (index), phi.

    A leaf is reached by a mixture of a row and a background row if the features
    where only the row's value leads there come from the row, those where only
    the background's does from the background, and none lacks both. So a
    background row matters only through which path features lead it to the leaf:
    these patterns are counted on Spark, a count per leaf and pattern, and rows are
    scored against the patterns.
    """
    spark = df.sparkSession
    leaves = tree_leaves(spark, model)
    kind = df.schema[key].dataType.simpleString()

    def matrix(column) -> np.ndarray:
        return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)

    def patterns(batches):
        seen = {}
        for batch in batches:
            if len(batch):
                x = matrix(batch.column(0))
                for n, (_, box) in enumerate(leaves):
                    rows, counts = np.unique(_inside(x, box), axis=0, return_counts=True)
                    for r, c in zip(rows, counts):
                        at = (n, "".join("01"[int(b)] for b in r))
                        seen[at] = seen.get(at, 0) + int(c)
        if seen:
            yield pa.RecordBatch.from_pylist([{"leaf": n, "pattern": p, "n": c} for (n, p), c in seen.items()], pa.schema([("leaf", pa.int32()), ("pattern", pa.string()), ("n", pa.int64())]))

    counted = base.select(vector_to_array(features).alias("x")).mapInArrow(patterns, "leaf int, pattern string, n long")
    # at most 2^depth patterns per leaf
    known: dict[int, list] = {}
    for r in counted.groupBy("leaf", "pattern").agg(F.sum("n").alias("n")).collect():
        known.setdefault(r["leaf"], []).append((r["pattern"], r["n"]))
    z = {n: (np.array([[c == "1" for c in p] for p, _ in own], bool).reshape(len(own), -1), np.array([c for _, c in own], float)) for n, own in known.items()}
    total = float(sum(z[0][1])) if z else 0.0
    most = max((len(box) for _, box in leaves), default=0)
    fact = [math.factorial(i) for i in range(most + 2)]
    plus = np.array([[fact[max(u - 1, 0)] * fact[v] / fact[u + v] if u and u + v <= most else 0.0 for v in range(most + 1)] for u in range(most + 1)])

    def run(batches):
        for batch in batches:
            if not len(batch):
                continue
            x, phi = matrix(batch.column(1)), np.zeros((len(batch), n_features))
            for n, (value, box) in enumerate(leaves):
                if not box or n not in z:
                    continue
                there, weight = z[n]
                own, other = _inside(x, box).astype(float), there.astype(float)
                u, v = (own @ (1 - other).T).astype(int), ((1 - own) @ other.T).astype(int)
                alive = ((1 - own) @ (1 - other).T) == 0
                gain, loss = (value * weight * alive * w for w in (plus[u, v], plus[v, u]))
                for i, f in enumerate(box):
                    phi[:, f] += own[:, i] * (gain @ (1 - other[:, i])) - (1 - own[:, i]) * (loss @ other[:, i])
            ids = batch.column(0).take(pa.array(np.repeat(np.arange(len(batch)), n_features)))
            slots = np.tile(np.arange(n_features, dtype=np.int32), len(batch))
            yield pa.RecordBatch.from_arrays([ids, pa.array(slots), pa.array((phi / total).ravel())], names=[key, "feature", "phi"])

    return df.select(key, vector_to_array(features).alias("x")).mapInArrow(run, f"`{key}` {kind}, feature int, phi double")


def mean_attribution(phi: DataFrame, names: Sequence[str]) -> DataFrame:
    """Mean absolute Shapley value per feature name."""
    name = F.get(F.array(*[F.lit(n) for n in names]), F.col("feature"))
    return phi.groupBy(name.alias("feature")).agg(F.avg(F.abs("phi")).alias("mean_abs"))


def paired_rows(rows: DataFrame, key: str, seed: int) -> DataFrame:
    """Rows with ``_d``: the ``_x`` of the row at the same place of another hash order; a bijection."""
    hashed = rows.withColumns({"_h1": hash_number(F.col(key), seed), "_h2": hash_number(F.col(key), seed + 1)})
    one = {"_place": F.lit(1)}
    takes = running_total(hashed, F.col("_h1"), F.col("_h2"), one)
    gives = running_total(hashed, F.col("_h2"), F.col("_h1"), one).select("_place", F.col("_x").alias("_d"))
    return takes.join(gives, "_place").drop("_place", "_h1", "_h2")


def permutation_importance(
    model, df: DataFrame, key: str, label: str, names: Sequence[str], seed: int = 42, features: str = "features"
) -> DataFrame:
    """Loss of ROC-AUC when one feature is exchanged between rows; the cheap form.

    A row takes the value of the row that has its own place in a second hash
    order, so every row gives its value once and takes one. ``key`` is unique.
    """
    slots = range(len(names))
    arr = vector_to_array(features)
    rows = df.select(key, label, arr.alias("_x"))
    paired = written(paired_rows(rows, key, seed), "paired")  # read once per feature
    out = None
    for i in [-1, *slots]:
        swapped = F.array(*[F.col("_d")[j] if j == i else F.col("_x")[j] for j in slots])
        scored = model.transform(paired.withColumn(features, array_to_vector(swapped)))
        raw = "probability" if "probability" in scored.columns else "rawPrediction"
        auc = auc_rank(scored.withColumn("_s", vector_to_array(F.col(raw))[1]), label, "_s")
        row = auc.select(F.lit(names[i] if i >= 0 else "").alias("feature"), "auc")
        out = row if out is None else out.unionByName(row)
    whole = out.agg(F.max(F.when(F.col("feature") == "", F.col("auc"))).alias("_all"))
    return attach(out.filter("feature != ''"), whole).select("feature", (F.col("_all") - F.col("auc")).alias("loss"))
