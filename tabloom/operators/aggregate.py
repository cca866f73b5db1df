"""Grouped aggregates, shares, pivots and funnels.

All of them combine partial results before the shuffle, so a hot key costs one
row per task. Null group keys form no group unless said otherwise.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloom.plans.quantiles import exact_quantiles
from tabloom.plans.sizing import MAX_ROWS, attach, value_table


def _keys(keys: str | Sequence[str]) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def _grouped(df: DataFrame, keys: str | Sequence[str]):
    keys = _keys(keys)
    return df.dropna(subset=keys).groupBy(*keys)


def group_count(df: DataFrame, keys, col: str) -> DataFrame:
    """Non-null values of a column per group."""
    return _grouped(df, keys).agg(F.count(col).alias("n"))


def group_rate(df: DataFrame, key, flag: str) -> DataFrame:
    """Mean and count of a 0/1 flag per group."""
    return _grouped(df, key).agg(F.avg(flag).alias("rate"), F.count(flag).alias("n"))


def group_median(df: DataFrame, key, col: str) -> DataFrame:
    """Exact median per group."""
    keys = _keys(key)
    return exact_quantiles(df, col, [0.5], keys).select(*keys, F.col("quantiles")[0].alias("median"))


def group_sum(df: DataFrame, key, col: str, ascending: bool = False) -> DataFrame:
    """Sum per group, sorted by it; equal sums by key."""
    out = _grouped(df, key).agg(F.coalesce(F.sum(col), F.lit(0)).alias("total"))
    return out.orderBy(F.col("total").asc() if ascending else F.col("total").desc(), *_keys(key))


def group_mean(df: DataFrame, key, col: str, ascending: bool = True) -> DataFrame:
    """Mean and non-null count per group, sorted by the mean; equal means by key."""
    out = _grouped(df, key).agg(F.avg(col).alias("mean"), F.count(col).alias("n"))
    return out.orderBy(F.col("mean").asc_nulls_last() if ascending else F.col("mean").desc_nulls_last(), *_keys(key))


def share_equal(df: DataFrame, key, col: str, value) -> DataFrame:
    """Percent of a group's rows equal to the value (null is unequal), and the rows."""
    hit = F.col(col).eqNullSafe(value).cast("double")
    return _grouped(df, key).agg((F.avg(hit) * 100).alias("percent"), F.count(F.lit(1)).alias("n"))


def value_counts(df: DataFrame, col: str, n: int | None = None) -> DataFrame:
    """Values by falling frequency, null left out, ties by value; the top ``n`` if given."""
    out = _grouped(df, col).agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("n").desc(), F.col(col).asc())
    return out.limit(n) if n is not None else out


def dense_counts(df: DataFrame, col: str, lo: int, hi: int, step: int = 1) -> DataFrame:
    """Counts on the grid lo, lo+step … hi; absent values 0, values off the grid vanish."""
    on_grid = F.col(col).between(lo, hi) & ((F.col(col) - lo) % step == 0)
    counts = df.filter(on_grid).groupBy(F.col(col).cast("long").alias(col)).agg(F.count(F.lit(1)).alias("n"))
    grid = df.sparkSession.range(lo, hi + 1, step).toDF(col)
    # counts holds at most one row per grid point
    points = (hi - lo) // step + 1
    return grid.join(F.broadcast(counts) if points <= MAX_ROWS else counts, col, "left").select(col, F.coalesce("n", F.lit(0)).alias("n"))


def category_share(df: DataFrame, col: str) -> DataFrame:
    """Count and percent of all counted rows per category."""
    counts = _grouped(df, col).agg(F.count(F.lit(1)).alias("n"))
    total = df.agg(F.count(col).alias("_total"))
    return attach(counts, total).select(col, "n", (F.col("n") / F.col("_total") * 100).alias("percent"))


def normalized_share(df: DataFrame, key: str, value: str, groups: Mapping[str, Column | None]) -> DataFrame:
    """Share of each key in the value total, one column per subgroup, in one scan.

    ``groups`` maps a column name to the subgroup's condition, None for all rows.
    A key without rows in a subgroup has a null share there.
    """
    sums = {
        name: F.sum(F.when(cond, F.col(value)) if cond is not None else F.col(value)) for name, cond in groups.items()
    }
    per_key = _grouped(df, key).agg(*[s.alias(name) for name, s in sums.items()])
    totals = df.filter(F.col(key).isNotNull()).agg(*[s.alias(f"_all_{name}") for name, s in sums.items()])
    shares = [F.try_divide(F.col(n).cast("double"), F.col(f"_all_{n}").cast("double")).alias(n) for n in groups]
    return attach(per_key, totals).select(key, *shares)


def cross_count(df: DataFrame, r: str, c: str, values: Sequence) -> DataFrame:
    """Count per row and column category; a missing cell is null."""
    return _grouped(df, r).pivot(c, list(values)).agg(F.count(F.lit(1)))


def cross_sum(df: DataFrame, r: str, c: str, v: str, values: Sequence) -> DataFrame:
    """Sum per row and column category; a missing cell is null."""
    return _grouped(df, r).pivot(c, list(values)).agg(F.sum(v))


def pivot_mean(df: DataFrame, index: str, columns: str, values: str, names: Sequence) -> DataFrame:
    """Mean per index and column category."""
    return _grouped(df, index).pivot(columns, list(names)).agg(F.avg(values))


def pivot_multi(df: DataFrame, index, value: str, aggs: Sequence[str] = ("count", "mean")) -> DataFrame:
    """Several aggregates of one column per index value."""
    made = {"count": F.count, "mean": F.avg, "sum": F.sum, "min": F.min, "max": F.max}
    return _grouped(df, index).agg(*[made[a](value).alias(a) for a in aggs])


def fixed_cross_count(
    df: DataFrame, row: str, rows: Sequence, col: str, values: Sequence, count: str
) -> DataFrame:
    """Table of counts with fixed rows and columns; an empty cell, and an empty row, is 0."""
    kept = df.filter(F.col(row).isin(*rows) & F.col(col).isin(*values))
    counts = kept.groupBy(row).pivot(col, list(values)).agg(F.count(count))
    frame = value_table(df.sparkSession, row, rows, df.schema[row].dataType.simpleString())
    # both sides have at most one row per listed row value
    return frame.join(F.broadcast(counts), row, "left").na.fill(0, subset=[str(v) for v in values])


def quotes_wide(quotes: DataFrame, instrument: str, date: str, close: str, dates: Sequence[str]) -> DataFrame:
    """One row per instrument, one column per date.

    A missing first (base) date is 0, a missing later date is null. Where a date
    carries several quotes the smallest is taken, so the result does not depend
    on the order of rows.
    """
    wide = _grouped(quotes.filter(F.col(date).isin(*dates)), instrument).pivot(date, list(dates)).agg(F.min(close))
    return wide.withColumn(dates[0], F.coalesce(F.col(f"`{dates[0]}`"), F.lit(0).cast("double")))


def indicators_wide(long: DataFrame, keys: Sequence[str], name: str, value: str, names: Mapping[str, str]) -> DataFrame:
    """Long indicator rows to one column per indicator, in one pivot instead of repeated full joins.

    Null and 0 values are skipped, as the collecting loop does; a key remains if
    any indicator has a value for it. ``names`` maps indicator to column name.
    """
    real = long.filter((F.col(value) != 0) & F.col(name).isin(*names))
    wide = _grouped(real, keys).pivot(name, list(names)).agg(F.max(value))
    return wide.withColumnsRenamed(dict(names))


def count_where(df: DataFrame, predicates: Mapping[str, Column]) -> DataFrame:
    """Several conditional counts in one scan."""
    return df.agg(*[F.count_if(F.coalesce(p, F.lit(False))).alias(n) for n, p in predicates.items()])


def representative(df: DataFrame, pair: Sequence[str], col: str) -> DataFrame:
    """Distinct pairs, each with the group's largest value."""
    return _grouped(df, pair).agg(F.max(col).alias(col))


def funnel(df: DataFrame, stages: Mapping[str, Column]) -> DataFrame:
    """Rows per stage in one scan, with the percent of the first stage."""
    counts = count_where(df, stages)
    first = F.col(next(iter(stages)))
    parts = [
        F.struct(
            F.lit(i + 1).alias("step"),
            F.lit(n).alias("stage"),
            F.col(n).alias("n"),
            (F.try_divide(F.col(n).cast("double"), first.cast("double")) * 100).alias("percent"),
        )
        for i, n in enumerate(stages)
    ]
    return counts.select(F.inline(F.array(*parts)))


def keyed_mean(df: DataFrame, key: str, value: str) -> DataFrame:
    """Mean per key from combined (sum, count) pairs."""
    return _grouped(df, key).agg(F.avg(value).alias("mean"))


def keyed_mean_parts(df: DataFrame, key: str, value: str) -> DataFrame:
    """The same mean with its two parts kept, for merging with other batches."""
    return _grouped(df, key).agg(F.sum(value).alias("sum"), F.count(value).alias("count"))


def merge_keyed_means(parts: DataFrame, key: str) -> DataFrame:
    """Final mean from any number of (sum, count) parts per key."""
    out = _grouped(parts, key).agg(F.sum("sum").alias("_s"), F.sum("count").alias("_c"))
    return out.select(key, F.try_divide(F.col("_s").cast("double"), F.col("_c").cast("double")).alias("mean"))


def distinct_by_key(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """One row per key, the first by ``order``; an aggregate, so hot keys are combined early."""
    rest = [c for c in df.columns if c != key]
    picked = F.min_by(F.struct(*rest), F.struct(*order)).alias("_row")
    return df.groupBy(key).agg(picked).select(key, *[F.col("_row")[c].alias(c) for c in rest])
