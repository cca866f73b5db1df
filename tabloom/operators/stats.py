"""Correlations, quantiles, scores and least squares."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from itertools import combinations, combinations_with_replacement

import numpy as np
import pandas as pd
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloom.plans.blocks import running_total
from tabloom.plans.quantiles import exact_quantiles
from tabloom.plans.sizing import MAX_ROWS, attach, pinned_if_small
from tabloom.plans.written import written


def _number(df: DataFrame, col: str) -> Column:
    """A column as a number; dates and timestamps in seconds."""
    kind = df.schema[col].dataType.typeName()
    if kind in ("timestamp", "timestamp_ntz", "date"):
        return F.col(col).cast("timestamp").cast("double")
    return F.col(col).cast("double")


def pearson(df: DataFrame, a: str, b: str) -> DataFrame:
    """Pearson correlation over the rows that have both values."""
    return df.agg(F.corr(_number(df, a), _number(df, b)).alias("r"))


def correlation_matrix(df: DataFrame, cols: Sequence[str], method: str = "pearson") -> DataFrame:
    """All pairs as (a, b, r) rows, each pair over the rows that have both values."""
    if method == "spearman":
        return _spearman_matrix(df, list(cols))
    pairs = list(combinations_with_replacement(cols, 2))
    row = df.agg(*[F.corr(_number(df, a), _number(df, b)).alias(f"r{i}") for i, (a, b) in enumerate(pairs)])
    cells = [
        F.struct(F.lit(x).alias("a"), F.lit(y).alias("b"), F.col(f"r{i}").alias("r"))
        for i, (a, b) in enumerate(pairs)
        for x, y in ([(a, b)] if a == b else [(a, b), (b, a)])
    ]
    return row.select(F.inline(F.array(*cells)))


def with_ranks(rows: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Add the rank of every number column among its values (``_r0``, ``_r1`` …), ties averaged; no column holds nulls.

    All columns are ranked in one pass: values are counted per column, and one order over (column, value),
    cut into blocks, runs through all of them. What is joined back is a row per distinct value.
    """
    cells = F.array(*(F.struct(F.lit(i).alias("c"), F.col(c).cast("double").alias("v")) for i, c in enumerate(cols)))
    counts = rows.select(F.explode(cells).alias("x")).groupBy("x.c", "x.v").agg(F.count(F.lit(1)).alias("n"))
    run = running_total(counts, F.col("c"), F.col("v"), {"upto": F.col("n")})
    ranks = written(run.select("c", "v", (F.col("upto") - (F.col("n") - 1) / 2).alias("r"), (F.col("upto") - F.col("n")).alias("before")), "ranks")
    _, few = pinned_if_small(ranks)
    if few is not None:
        seen = {r["c"]: r for r in few.group_by("c").aggregate([("v", "count"), ("before", "min")]).rename_columns(["c", "n", "base"]).to_pylist()}
    else:
        seen = {r["c"]: r.asDict() for r in ranks.groupBy("c").agg(F.count(F.lit(1)).alias("n"), F.min("before").alias("base")).collect()}
    for i, c in enumerate(cols):
        if i not in seen:
            return rows.withColumns({f"_r{j}": F.lit(None).cast("double") for j in range(len(cols))})  # no rows
        table = ranks if few is None else rows.sparkSession.createDataFrame(few.filter(pc.field("c") == i), ranks.schema)
        own = table.filter(F.col("c") == i).select(F.col("v").alias("_v"), (F.col("r") - seen[i]["base"]).alias(f"_r{i}"))
        own = F.broadcast(own) if seen[i]["n"] <= MAX_ROWS else own
        rows = rows.join(own, F.col(c).cast("double") == F.col("_v")).drop("_v")
    return rows


def _rank_correlation(i: int, j: int) -> Column:
    x, y = F.col(f"_r{i}"), F.col(f"_r{j}")
    return F.try_divide(F.covar_pop(x, y), F.sqrt(F.var_pop(x) * F.var_pop(y)))


def spearman(df: DataFrame, a: str, b: str) -> DataFrame:
    """Spearman correlation, ties averaged, over the rows that have both values."""
    rows = df.select(_number(df, a).alias("_a"), _number(df, b).alias("_b")).dropna()
    return with_ranks(rows, ["_a", "_b"]).agg(_rank_correlation(0, 1).alias("r"))


def _spearman_matrix(df: DataFrame, cols: list[str]) -> DataFrame:
    """Columns without nulls are ranked together, once; a pair with nulls over the rows that have both."""
    numbers = df.select(*(_number(df, c).alias(f"_c{i}") for i, c in enumerate(cols)))
    names = numbers.columns
    counts = numbers.agg(F.count(F.lit(1)).alias("n"), *(F.count(c).alias(c) for c in names)).first()
    whole = [i for i, c in enumerate(names) if counts[c] == counts["n"]]
    parts = []
    if whole:
        ranked = with_ranks(numbers.select(*(names[i] for i in whole)), [names[i] for i in whole])
        pairs = [(x, y) for x in range(len(whole)) for y in range(x, len(whole))]
        row = ranked.agg(*(_rank_correlation(x, y).alias(f"r{x}_{y}") for x, y in pairs))
        cells = [
            F.struct(F.lit(cols[whole[p]]).alias("a"), F.lit(cols[whole[q]]).alias("b"), F.col(f"r{x}_{y}").alias("r"))
            for x, y in pairs for p, q in ([(x, y)] if x == y else [(x, y), (y, x)])
        ]
        parts.append(row.select(F.inline(F.array(*cells))))
    for i, a in enumerate(cols):
        if i not in whole:
            one = df.agg(F.when(F.min(a) < F.max(a), F.lit(1.0)).alias("r"))
            parts.append(one.select(F.lit(a).alias("a"), F.lit(a).alias("b"), "r"))
    for (i, a), (j, b) in combinations(enumerate(cols), 2):
        if not (i in whole and j in whole):
            cells = F.array(*(F.struct(F.lit(p).alias("a"), F.lit(q).alias("b"), "r") for p, q in ((a, b), (b, a))))
            parts.append(spearman(df, a, b).select(F.inline(cells)))
    return reduce(DataFrame.unionByName, parts)


def sample_skewness(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Sample-corrected skewness per column; null for fewer than three values."""
    aggs = []
    for c in cols:
        n = F.count(c).cast("double")
        factor = F.when(n > 2, F.sqrt(n * (n - 1)) / F.when(n > 2, n - 2))
        aggs.append((F.skewness(c) * factor).alias(c))
    cells = [F.struct(F.lit(c).alias("column"), F.col(c).alias("skewness")) for c in cols]
    return df.agg(*aggs).select(F.inline(F.array(*cells)))


def quantiles(df: DataFrame, col: str, qs: Sequence[float]) -> DataFrame:
    """Exact quantiles as (q, value) rows."""
    row = exact_quantiles(df, col, qs)
    cells = [F.struct(F.lit(float(q)).alias("q"), F.col("quantiles")[i].alias("value")) for i, q in enumerate(qs)]
    return row.select(F.inline(F.array(*cells)))


def balance_score(
    df: DataFrame, keys: Sequence[str], positive: Column, negative: Column, value: str, how: str = "sum"
) -> DataFrame:
    """Positive minus negative points per group; null if one side has no rows."""
    fold = {"sum": F.sum, "mean": F.avg}[how]
    rows = df.dropna(subset=list(keys)).filter(F.coalesce(positive, F.lit(False)) | F.coalesce(negative, F.lit(False)))
    sides = rows.groupBy(*keys).agg(
        fold(F.when(positive, F.col(value))).alias("positive"), fold(F.when(negative, F.col(value))).alias("negative")
    )
    return sides.withColumn("score", F.col("positive") - F.col("negative"))


# --- association of mixed columns -------------------------------------------------


def _binned(df: DataFrame, cols: Sequence[str], interval_cols: Sequence[str], bins: int) -> DataFrame:
    if not interval_cols:
        return df.select(*[F.col(c).cast("string").alias(c) for c in cols])
    ends = df.agg(
        *[F.min(_number(df, c)).alias(f"_lo_{c}") for c in interval_cols],
        *[F.max(_number(df, c)).alias(f"_hi_{c}") for c in interval_cols],
    )

    def cell(c: str) -> Column:
        if c not in interval_cols:
            return F.col(c).cast("string").alias(c)
        lo, hi = F.col(f"_lo_{c}"), F.col(f"_hi_{c}")
        number = F.least(F.floor(F.try_divide((_number(df, c) - lo) * bins, hi - lo)), F.lit(bins - 1))
        return F.coalesce(number, F.when(F.col(c).isNotNull(), F.lit(0))).cast("string").alias(c)

    return attach(df, ends).select(*[cell(c) for c in cols])


def contingency(df: DataFrame, cols: Sequence[str], interval_cols: Sequence[str] = (), bins: int = 10) -> DataFrame:
    """Cell counts of every column pair: a, b, x, y, n. Rows lacking one value are left out of that pair."""
    pairs = [
        F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(a).alias("x"), F.col(b).alias("y"))
        for a, b in combinations(cols, 2)
    ]
    long = _binned(df, cols, interval_cols, bins).select(F.inline(F.array(*pairs)))
    return long.dropna(subset=["x", "y"]).groupBy("a", "b", "x", "y").agg(F.count(F.lit(1)).alias("n"))


def association_matrix(
    df: DataFrame, cols: Sequence[str], interval_cols: Sequence[str] = (), bins: int = 10
) -> DataFrame:
    """χ², Cramér's V and φk of every column pair: a, b, n, r, k, chi2, cramers_v, phi_k.

    Interval columns are cut in equal bins over their range. Counting is one
    grouped pass; φk is then solved per pair from χ² and the table's size.
    """
    cells, _ = pinned_if_small(contingency(df, cols, interval_cols, bins))
    px = cells.groupBy("a", "b", "x").agg(F.sum("n").alias("nx"))
    py = cells.groupBy("a", "b", "y").agg(F.sum("n").alias("ny"))
    sizes = px.groupBy("a", "b").agg(F.count("x").alias("r"), F.sum("nx").alias("total")).join(
        py.groupBy("a", "b").agg(F.count("y").alias("k")), ["a", "b"]
    )
    terms = cells.join(px, ["a", "b", "x"]).join(py, ["a", "b", "y"])
    n = F.col("n").cast("double")
    chi = terms.groupBy("a", "b").agg(F.sum(n * n / (F.col("nx").cast("double") * F.col("ny"))).alias("_t"))
    chi2 = F.greatest(F.col("total") * (F.col("_t") - 1), F.lit(0.0))
    small = F.least("r", "k") - 1
    out = sizes.join(chi, ["a", "b"]).select("a", "b", F.col("total").alias("n"), "r", "k", chi2.alias("chi2"), small.alias("_m"))
    v = F.sqrt(F.try_divide(F.col("chi2"), F.col("n") * F.col("_m").cast("double")))
    return out.withColumn("cramers_v", v).drop("_m").withColumn("phi_k", _phi_k_column("chi2", "n", "r", "k"))


def _phi_k_column(*cols: str) -> Column:
    @F.pandas_udf("double")
    def solve(chi2: pd.Series, n: pd.Series, r: pd.Series, k: pd.Series) -> pd.Series:
        return pd.Series([phi_k(*row) for row in zip(chi2, n, r, k)])

    return solve(*[F.col(c) for c in cols])


def _normal_cdf(z: np.ndarray) -> np.ndarray:
    return 0.5 * (1.0 + np.vectorize(math.erf)(z / math.sqrt(2.0)))


def _binned_normal_chi2(rho: float, r: int, k: int) -> float:
    """χ² per observation of a standard bivariate normal cut in r × k equal bins on [−5, 5]."""
    ex, ey = np.linspace(-5, 5, r + 1), np.linspace(-5, 5, k + 1)
    nodes, weights = np.polynomial.legendre.leggauss(64)
    mid, half = (ex[1:] + ex[:-1]) / 2, (ex[1:] - ex[:-1]) / 2
    x = mid[:, None] + half[:, None] * nodes
    dens = np.exp(-x * x / 2) / math.sqrt(2 * math.pi) * weights * half[:, None]
    spread = math.sqrt(1 - rho * rho)
    below = _normal_cdf((ey[:, None, None] - rho * x) / spread)
    joint = ((below[1:] - below[:-1]) * dens).sum(axis=2).T
    joint = np.clip(joint, 0, None) / joint.sum()
    expected = np.outer(joint.sum(axis=1), joint.sum(axis=0))
    return float(((joint - expected) ** 2 / np.where(expected > 0, expected, 1)).sum())


def phi_k(chi2: float, n: float, r: int, k: int) -> float | None:
    """Correlation of the binned bivariate normal that has this χ² (Baak et al. 2018).

    χ² below its noise level, the degrees of freedom, is 0; the curve is
    stretched so that the largest χ² a table of this size allows is 1.
    """
    if r < 2 or k < 2 or n <= 0:
        return None
    floor, top = float((r - 1) * (k - 1)), float(n * min(r - 1, k - 1))
    if chi2 <= floor or top <= floor:
        return 0.0
    if chi2 >= top * (1 - 1e-9):
        return 1.0
    limit = 1 - 1e-6
    wanted = (chi2 - floor) / (top - floor) * _binned_normal_chi2(limit, r, k)
    lo, hi = 0.0, limit
    for _ in range(50):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if _binned_normal_chi2(mid, r, k) < wanted else (lo, mid)
    return (lo + hi) / 2


# --- least squares --------------------------------------------------------------


#: Up to so many coefficients, the matrix of all features is put together for its condition number.
CONDITION_FEATURES = 1000


@dataclass
class OlsFit:
    """Coefficient rows (term, coef, se, t, p), the fit as one row, and what residuals need.

    ``effects`` has a row per level of the absorbed column (the column, and the
    constant of its rows as ``_effect``), or is None.
    """

    coefficients: DataFrame
    summary: DataFrame
    weights: dict[str, float]
    const: float
    y: str
    dummy: str | None
    effects: DataFrame | None


def _dot(columns: Sequence[Column], numbers: Sequence[float]) -> Column:
    return reduce(lambda a, b: a + b, [c * F.lit(float(v)) for c, v in zip(columns, numbers)], F.lit(0.0))


def _quadratic(columns: Sequence[Column], matrix: np.ndarray) -> Column:
    """v' M v for a vector of columns."""
    return _dot([a * b for a in columns for b in columns], [matrix[i, j] for i in range(len(columns)) for j in range(len(columns))])


def _with_p(table: DataFrame, dof: int) -> DataFrame:
    """Terms with t and its two-sided p."""

    def run(batches):
        for pdf in batches:
            yield pdf.assign(p=[None if t is None or t != t else f_tail(t * t, 1, dof) for t in pdf["t"]])

    rows = table.withColumn("t", F.try_divide("coef", "se")).select("term", "coef", "se", "t")
    return rows.mapInPandas(run, "term string, coef double, se double, t double, p double")


def ols(df: DataFrame, y: str, xs: Sequence[str], dummy: str | None = None) -> OlsFit:
    """Least squares with a constant, and dummies of one column's levels if asked, the first level being left out.

    Rows with a missing value are dropped. Dummies are absorbed: one pass counts
    each level's rows, means and products about the means; their sums over the levels
    are the normal equations of the features alone, a matrix of features × features, and the
    only thing the driver sees. The levels' coefficients are then read back from the
    table of levels, so there may be any number of them. Features that depend on
    others (or on the levels) share one solution of least length.
    """
    spark, k = df.sparkSession, len(xs)
    rows = df.select(*dict.fromkeys([y, *xs, *([dummy] if dummy else [])])).dropna()
    names = [*xs, y]
    cells = [(i, j) for i in range(k + 1) for j in range(i, k + 1)]
    v = [F.col(f"`{c}`").cast("double") for c in names]
    n = F.count(F.lit(1))
    aggs = [n.alias("_n"), *(F.avg(c).alias(f"_m{i}") for i, c in enumerate(v)), *((F.covar_pop(v[i], v[j]) * n).alias(f"_c{i}_{j}") for i, j in cells)]
    per = rows.groupBy(F.col(dummy).alias("_level") if dummy else F.lit(0).alias("_level")).agg(*aggs)
    per, small = pinned_if_small(per)
    if small is None:
        per = written(per, "ols-levels")
    weight = lambda c: F.sum(F.col("_n") * c)
    sums = per.agg(
        F.sum("_n").alias("n"), n.alias("levels"), F.min("_level").alias("first"), *(weight(F.col(f"_m{i}")).alias(f"s{i}") for i in range(k + 1)),
        *(F.sum(f"_c{i}_{j}").alias(f"c{i}_{j}") for i, j in cells)).first()
    if not sums["n"]:
        raise ValueError("no row has all values")
    total, levels = sums["n"], sums["levels"]
    within = np.zeros((k + 1, k + 1))
    for i, j in cells:
        within[i, j] = within[j, i] = sums[f"c{i}_{j}"]
    mean = [sums[f"s{i}"] / total for i in range(k + 1)]
    between = per.agg(*(weight((F.col(f"_m{i}") - mean[i]) * (F.col(f"_m{j}") - mean[j])).alias(f"b{i}_{j}") for i, j in cells)).first()
    scale = np.sqrt(np.where(np.diag(within)[:k] > 0, np.diag(within)[:k], 1.0))
    inverse = np.linalg.pinv(within[:k, :k] / np.outer(scale, scale), rcond=1e-11, hermitian=True) / np.outer(scale, scale) if k else np.zeros((0, 0))
    rank = int(np.linalg.matrix_rank(within[:k, :k] / np.outer(scale, scale), tol=1e-11, hermitian=True)) if k else 0
    b = inverse @ within[:k, k]
    rss = max(float(within[k, k] - b @ within[:k, k]), 0.0)
    tss = float(within[k, k] + between[f"b{k}_{k}"])
    terms, dof = rank + levels - 1, total - rank - levels
    s2 = rss / dof if dof > 0 else float("nan")
    r2 = 1 - rss / tss if tss > 0 else float("nan")
    f_stat = (r2 / terms) / ((1 - r2) / dof) if terms and dof > 0 and r2 < 1 else float("nan")

    m = [F.col(f"_m{i}") for i in range(k)]
    table = per.withColumn("_effect", F.col(f"_m{k}") - _dot(m, b))
    base = table.filter(F.col("_level") == F.lit(sums["first"])).first()
    gap = [c - F.lit(base[f"_m{i}"]) for i, c in enumerate(m)]
    own = F.lit(s2) * (1 / F.col("_n") + _quadratic(m, inverse))
    other = F.lit(s2) * (1 / F.col("_n") + F.lit(1.0 / base["_n"]) + _quadratic(gap, inverse))
    is_first = F.col("_level") == F.lit(sums["first"])
    of_levels = table.orderBy(is_first, "_level").select(
        F.when(is_first, F.lit("const")).otherwise(F.concat(F.lit(f"{dummy}_"), F.col("_level").cast("string"))).alias("term"),
        F.when(is_first, F.col("_effect")).otherwise(F.col("_effect") - F.lit(base["_effect"])).alias("coef"),
        F.sqrt(F.when(is_first, own).otherwise(other)).alias("se"),
    )
    of_features = [(x, float(c), float(math.sqrt(max(s2 * inverse[i, i], 0.0)))) for i, (x, c) in enumerate(zip(xs, b))]
    every = of_levels if not k else spark.createDataFrame(of_features, "term string, coef double, se double").unionByName(of_levels)
    condition = _condition(table, within, between, mean, total, k, levels)
    fit = [(total, r2, 1 - (1 - r2) * (total - 1) / dof if dof > 0 else float("nan"), f_stat, f_tail(f_stat, terms, dof) if f_stat == f_stat else float("nan"), condition)]
    return OlsFit(
        _with_p(every, dof),
        spark.createDataFrame(pd.DataFrame([tuple(map(float, fit[0]))], columns=["n", "r2", "r2_adj", "f", "f_p", "condition"])),
        dict(zip(xs, map(float, b))),
        float(base["_effect"]),
        y,
        dummy,
        table.select(F.col("_level").alias(dummy), "_effect") if dummy else None,
    )


def _condition(table: DataFrame, within: np.ndarray, between, mean: Sequence[float], n: int, k: int, levels: int) -> float:
    """Square root of the ratio of X'X's largest and smallest eigenvalue; NaN for more features than are put together."""
    if k + levels > CONDITION_FEATURES:
        return float("nan")
    gram = np.zeros((k + levels, k + levels))
    for i in range(k):
        for j in range(i, k):
            gram[i, j] = gram[j, i] = within[i, j] + between[f"b{i}_{j}"] + n * mean[i] * mean[j]
        gram[i, k] = gram[k, i] = n * mean[i]
    gram[k, k] = n
    for at, r in enumerate(table.orderBy("_level").collect()[1:], k + 1):
        gram[at, at] = gram[at, k] = gram[k, at] = r["_n"]
        for i in range(k):
            gram[at, i] = gram[i, at] = r["_n"] * r[f"_m{i}"]
    eig = np.linalg.eigvalsh(gram)
    return float(math.sqrt(eig[-1] / eig[0])) if eig[0] > 0 else float("inf")


def residuals(fit: OlsFit, df: DataFrame, out: str = "resid") -> DataFrame:
    """Observed minus fitted; null where a value is missing or a level was not seen."""
    line = _dot([F.col(f"`{x}`").cast("double") for x in fit.weights], list(fit.weights.values()))
    if fit.dummy is None:
        return df.withColumn(out, F.col(fit.y) - line - F.lit(fit.const))
    both = attach(df, fit.effects, [fit.dummy])
    return both.withColumn(out, F.col(fit.y) - line - F.col("_effect")).drop("_effect")


def f_tail(f: float, d1: float, d2: float) -> float:
    """Upper tail of the F distribution."""
    return _beta_inc(d2 / 2, d1 / 2, d2 / (d2 + d1 * f))


def _beta_inc(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta function, by its continued fraction (Lentz)."""
    if x <= 0 or x >= 1:
        return float(x >= 1)
    if x > (a + 1) / (a + b + 2):
        return 1 - _beta_inc(b, a, 1 - x)
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)) / a
    c, d = 1.0, 1 / (1 - (a + b) * x / (a + 1))
    h = d
    for m in range(1, 500):
        for num in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
                    -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d, c = 1 / (1 + num * d), 1 + num / c
            h *= c * d
        if abs(c * d - 1) < 1e-14:
            break
    return front * h
