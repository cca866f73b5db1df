"""Profiling: completeness, distribution, duplicates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabloom.plans.quantiles import exact_quantiles, wide_quantiles
from tabloom.plans.sizing import attach


def _long(row: DataFrame, fields: Sequence[str], metrics: Sequence[str], name: str = "column") -> DataFrame:
    """One wide aggregate row to one row per column; cells are named metric__column."""
    parts = [
        F.struct(F.lit(f).alias(name), *[F.col(f"{m}__{f}").alias(m) for m in metrics]) for f in fields
    ]
    return row.select(F.inline(F.array(*parts)))


def null_profile(df: DataFrame) -> DataFrame:
    """Null count and share of every column, in one pass."""
    aggs = [F.count_if(F.col(c).isNull()).alias(f"nulls__{c}") for c in df.columns]
    aggs += [F.avg(F.col(c).isNull().cast("double")).alias(f"share__{c}") for c in df.columns]
    return _long(df.agg(*aggs), df.columns, ["nulls", "share"])


def duplicate_count(df: DataFrame, cols: Sequence[str] | None = None, digest: Sequence[str] = ()) -> DataFrame:
    """Rows that repeat an earlier one in the given columns.

    Long texts listed in ``digest`` are compared by their SHA-256, so that 64
    characters per row are shuffled instead of the text.
    """
    cols = list(cols or df.columns)
    keys = [(F.sha2(F.col(c), 256) if c in digest else F.col(c)).alias(c) for c in cols]
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).agg(
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicates")
    )


def duplicate_rows(df: DataFrame, cols: Sequence[str], order: str) -> DataFrame:
    """The repeating rows themselves: all but the first, by ``order``, of every group.

    The first row of a group is an aggregate, so a hot group is never gathered.
    """
    first = df.groupBy(*cols).agg(F.min(order).alias("_first"), F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    same = [df[c].eqNullSafe(first[c]) for c in cols]
    cond = same[0]
    for s in same[1:]:
        cond = cond & s
    return df.join(first.drop("_n"), cond & (df[order] > first["_first"]), "left_semi")


def distinct_values(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Sorted distinct values of the text columns, as (column, value) rows."""
    cols = list(cols or [f.name for f in df.schema if isinstance(f.dataType, T.StringType)])
    long = df.select(*[F.col(c).cast("string").alias(c) for c in cols]).unpivot([], cols, "column", "value")
    return long.distinct().orderBy("column", F.col("value").asc_nulls_last())


def n_unique(df: DataFrame, col: str) -> DataFrame:
    return df.agg(F.count_distinct(F.col(col)).alias("n_unique"))


def describe(df: DataFrame, col: str, by: Sequence[str] = ()) -> DataFrame:
    """Count, mean, sample deviation, minimum, exact quartiles, maximum; per group if asked."""
    by = list(by)
    c = F.col(col).cast("double")
    rows = df.dropna(subset=by) if by else df
    moments = rows.groupBy(*by).agg(
        F.count(c).alias("count"), F.avg(c).alias("mean"), F.stddev_samp(c).alias("std"),
        F.min(c).alias("min"), F.max(c).alias("max"),
    )
    q = exact_quantiles(df, col, [0.25, 0.5, 0.75], by)
    quarters = [F.col("quantiles")[i].alias(f"q{25 * (i + 1)}") for i in range(3)]
    joined = attach(moments, q.select(*by, *quarters), by)
    return joined.select(*by, "count", "mean", "std", "min", "q25", "q50", "q75", "max")


def describe_text(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Count, number of values, most frequent value (ties to the smallest) and its frequency."""
    long = df.select(*[F.col(c).cast("string").alias(c) for c in cols]).unpivot([], cols, "column", "v")
    counts = long.groupBy("column", "v").agg(F.count("v").alias("n"))
    best = F.min(F.when(F.col("v").isNotNull(), F.struct((-F.col("n")).alias("n"), F.col("v").alias("v"))))
    return counts.groupBy("column").agg(
        F.sum("n").alias("count"), F.count("v").alias("unique"), best.alias("b")
    ).select("column", "count", "unique", F.col("b.v").alias("top"), (-F.col("b.n")).alias("freq"))


def schema_profile(df: DataFrame) -> DataFrame:
    """Name, type and non-null count of every column."""
    counts = df.agg(*[F.count(c).alias(f"non_null__{c}") for c in df.columns])
    kinds = dict(df.dtypes)
    parts = [
        F.struct(F.lit(c).alias("column"), F.lit(kinds[c]).alias("type"), F.col(f"non_null__{c}").alias("non_null"))
        for c in df.columns
    ]
    return counts.select(F.inline(F.array(*parts)))


def float_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))]


def summary_table(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Completeness, minimum, maximum, mean, median, p90 and p95 of every float column."""
    cols = list(cols or float_columns(df))
    aggs = []
    for i, c in enumerate(cols):
        aggs += [(F.count(c) / F.count(F.lit(1))).alias(f"complete{i}"), F.avg(c).alias(f"mean{i}")]
    found, row = wide_quantiles(df, cols, [0.0, 0.5, 0.9, 0.95, 1.0], aggs=aggs)
    rows = []
    for i, c in enumerate(cols):
        low, p50, p90, p95, high = found[c][1]
        rows.append((c, row[f"complete{i}"], low, high, row[f"mean{i}"], p50, p90, p95))
    names = "`column` string, complete double, min double, max double, mean double, p50 double, p90 double, p95 double"
    return df.sparkSession.createDataFrame(rows, names)


def time_span(tables: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Earliest and latest time of each table, one row per name."""
    out = None
    for name, (df, col) in tables.items():
        row = df.agg(F.min(col).alias("first"), F.max(col).alias("last")).select(F.lit(name).alias("table"), "*")
        out = row if out is None else out.unionByName(row)
    return out


def histogram(df: DataFrame, col: str, bins: int, lo: float, hi: float) -> DataFrame:
    """Counts in equal bins; the last is closed, values outside are ignored, empty bins are 0."""
    v = F.col(col).cast("double")
    bin_no = F.least(F.width_bucket(v, F.lit(float(lo)), F.lit(float(hi)), F.lit(bins)), F.lit(bins).cast("long"))
    counts = df.filter(v.between(lo, hi)).groupBy(bin_no.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    step = (hi - lo) / bins
    dense = df.sparkSession.range(1, bins + 1).toDF("bin")
    return dense.join(F.broadcast(counts), "bin", "left").select(
        "bin",
        (F.lit(float(lo)) + (F.col("bin") - 1) * step).alias("low"),
        (F.lit(float(lo)) + F.col("bin") * step).alias("high"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def box_stats(df: DataFrame, col: str, by: Sequence[str] = ()) -> DataFrame:
    """Box-plot numbers: quartiles, whiskers inside 1.5 IQR, number of outliers; per group if asked."""
    by = list(by)
    q = exact_quantiles(df, col, [0.25, 0.5, 0.75], by).select(
        *by, *[F.col("quantiles")[i].alias(n) for i, n in enumerate(["q25", "q50", "q75"])]
    )
    reach = (F.col("q75") - F.col("q25")) * 1.5
    rows = attach(df.select(*by, F.col(col).cast("double").alias("_v")).filter("_v is not null"), q, by, "inner")
    inside = F.col("_v").between(F.col("q25") - reach, F.col("q75") + reach)
    return rows.groupBy(*by).agg(
        F.min(F.when(inside, F.col("_v"))).alias("whisker_low"),
        F.max("q25").alias("q25"),
        F.max("q50").alias("q50"),
        F.max("q75").alias("q75"),
        F.max(F.when(inside, F.col("_v"))).alias("whisker_high"),
        F.count_if(~inside).alias("outliers"),
    )
