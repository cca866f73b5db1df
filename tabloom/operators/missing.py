"""Missing values and outliers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloom.plans.neighbours import HOT_ROWS, with_neighbours
from tabloom.plans.quantiles import exact_quantiles, wide_quantiles
from tabloom.plans.sizing import attach


def fill_constant(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    return df.na.fill(dict(values))


def _median(df: DataFrame, col: str, keys: Sequence[str] = ()) -> DataFrame:
    return exact_quantiles(df, col, [0.5], keys).select(*keys, F.col("quantiles")[0].alias("_fill"))


def fill_median(df: DataFrame, col: str | Sequence[str]) -> DataFrame:
    """Nulls to the exact median of the column; several columns share the passes."""
    cols = [col] if isinstance(col, str) else list(col)
    found, _ = wide_quantiles(df, cols, [0.5])
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(found[c][1][0])) for c in cols})


def fill_group_median(df: DataFrame, col: str | Sequence[str], key: str, where: Column | None = None) -> DataFrame:
    """Nulls to the exact median of their group.

    With ``where``, only rows for which it is true give to the medians and are
    filled. A null key, or a group without values, leaves the null. Several
    columns share one pass and one join of medians.
    """
    cols = [col] if isinstance(col, str) else list(col)
    source = df.filter(where) if where is not None else df
    if len(cols) == 1:
        medians = _median(source, cols[0], [key]).withColumnRenamed("_fill", "_fill0")
    else:
        cells = F.array(*(F.struct(F.lit(i).alias("c"), F.col(c).cast("double").alias("v")) for i, c in enumerate(cols)))
        long = source.select(key, F.explode(cells).alias("x")).select(key, F.col("x.c").alias("_c"), F.col("x.v").alias("_v"))
        each = _median(long, "_v", [key, "_c"])
        medians = each.groupBy(key).agg(*(F.max(F.when(F.col("_c") == i, F.col("_fill"))).alias(f"_fill{i}") for i in range(len(cols))))
    may = where if where is not None else F.lit(True)
    new = {c: F.when(F.col(c).isNull() & may, F.col(f"_fill{i}")).otherwise(F.col(c)) for i, c in enumerate(cols)}
    return attach(df, medians, [key]).withColumns(new).drop(*(f"_fill{i}" for i in range(len(cols))))


def fill_group_mean_where(df: DataFrame, col: str, key: str, mask: Column) -> DataFrame:
    """Every row under the mask, null or not, gets the mean of its group (over all rows of the group)."""
    means = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.avg(col).alias("_fill"))
    return attach(df, means, [key]).withColumn(col, F.when(mask, F.col("_fill")).otherwise(F.col(col))).drop("_fill")


_SCRATCH = ("_pos", "_lag", "_lead", "_prev", "_prev_pos", "_next", "_next_pos")


def fill_neighbours(
    df: DataFrame, keys: Sequence[str], order: str, tie: str, cols: Sequence[str], hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Fill a gap from its neighbours, front to back.

    A sequential loop that uses what it has just filled comes to this: with p the
    last value before the gap and n the value of the next row, the cell becomes
    their mean if both exist, else the one that exists. So only the last cell of
    a gap takes the mean, and of leading nulls only the last is filled.
    """
    for col in cols:
        df = with_neighbours(df, keys, order, tie, col, hot_rows)
        fill = F.coalesce((F.col("_prev") + F.col("_lead")) / 2, "_prev", "_lead")
        df = df.withColumn(col, F.coalesce(F.col(col), fill)).drop(*_SCRATCH)
    return df


def interpolate_linear(
    df: DataFrame, keys: Sequence[str], order: str, tie: str, cols: Sequence[str], hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Linear by row position inside a key; trailing gaps carry on, leading stay null."""
    for col in cols:
        df = with_neighbours(df, keys, order, tie, col, hot_rows)
        part = (F.col("_pos") - F.col("_prev_pos")) / (F.col("_next_pos") - F.col("_prev_pos"))
        inner = F.col("_prev") + (F.col("_next") - F.col("_prev")) * part
        df = df.withColumn(col, F.coalesce(F.col(col), inner, "_prev")).drop(*_SCRATCH)
    return df


def cap_outliers(df: DataFrame, col: str, q: float, value: float | None = None) -> DataFrame:
    """Values above the exact quantile become ``value``, by default the median taken before."""
    limits = exact_quantiles(df, col, [q, 0.5]).select(
        F.col("quantiles")[0].alias("_cap"), F.col("quantiles")[1].alias("_mid")
    )
    new = F.col("_mid") if value is None else F.lit(value)
    return (
        attach(df, limits)
        .withColumn(col, F.when(F.col(col) > F.col("_cap"), new).otherwise(F.col(col)))
        .drop("_cap", "_mid")
    )


def impute_scaled(df: DataFrame, col: str, unit: str) -> DataFrame:
    """Nulls to ``unit`` × the average per unit.

    The average is the half-even rounded quotient of the summed rounded group
    means and the summed unit values. Only nulls are replaced, which is the
    stated aim; the groups are those with a mean.
    """
    means = df.filter(F.col(unit).isNotNull()).groupBy(unit).agg(F.bround(F.avg(col)).alias("_m"))
    means = means.filter(F.col("_m").isNotNull())
    average = means.agg(F.bround(F.try_divide(F.sum("_m"), F.sum(F.col(unit).cast("double")))).alias("_avg"))
    return attach(df, average).withColumn(col, F.coalesce(F.col(col), F.col(unit) * F.col("_avg"))).drop("_avg")


def trim_above(df: DataFrame, col: str, limit: float) -> DataFrame:
    """Rows at or below the limit; null goes too."""
    return df.filter(F.col(col) <= limit)


def share_above(df: DataFrame, col: str, limit: float, out: str = "share") -> DataFrame:
    """Share of the rows with a value that trim_above would drop for being too large."""
    over = F.when(F.col(col).isNotNull(), (F.col(col) > limit).cast("double"))
    return df.agg(F.avg(over).alias(out))


def modes(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row: the most frequent value of each text column, ties to the smallest."""
    long = df.select(*cols).unpivot([], list(cols), "c", "v").filter("v is not null")
    counts = long.groupBy("c", "v").agg(F.count(F.lit(1)).alias("n"))
    best = counts.groupBy("c").agg(F.min(F.struct((-F.col("n")).alias("n"), "v"))["v"].alias("v"))
    return best.agg(*[F.max(F.when(F.col("c") == c, F.col("v"))).alias(c) for c in cols])


def fill_mode(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Nulls of text columns to the column's most frequent value."""
    filled = attach(df, modes(df, cols).toDF(*[f"_mode_{c}" for c in cols]))
    return filled.withColumns({c: F.coalesce(c, f"_mode_{c}") for c in cols}).drop(*[f"_mode_{c}" for c in cols])
