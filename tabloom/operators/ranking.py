"""Running shares, ratings, neighbours and top lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloom.functions import times
from tabloom.operators.aggregate import value_counts
from tabloom.operators.filters import time_between
from tabloom.plans.blocks import running_total
from tabloom.plans.neighbours import HOT_ROWS, with_neighbours
from tabloom.plans.sizing import attach


def cumulative_share(df: DataFrame, value: str, key: str, out: str = "share") -> DataFrame:
    """Running sum ÷ total, largest values first, equal values by key (numeric).

    Rows without a value are left out.
    """
    rows = df.filter(F.col(value).isNotNull())
    run = running_total(rows, -F.col(value), F.col(key), {"_run": F.col(value)})
    total = rows.agg(F.sum(value).cast("double").alias("_total"))
    return attach(run, total).withColumn(out, F.try_divide(F.col("_run").cast("double"), F.col("_total"))).drop("_run", "_total")


def pareto_segment(df: DataFrame, value: str, key: str, limit: float = 0.8) -> DataFrame:
    """Rows whose running share is at most the limit."""
    return cumulative_share(df, value, key).filter(F.col("share") <= limit)


def pareto_report(df: DataFrame, value: str, key: str, limit: float = 0.8) -> DataFrame:
    """Size of that segment: rows, share of rows, share of value."""
    inside = F.col("share") <= limit
    return cumulative_share(df, value, key).agg(
        F.count_if(inside).alias("rows"),
        F.avg(inside.cast("double")).alias("row_share"),
        F.try_divide(F.sum(F.when(inside, F.col(value))).cast("double"), F.sum(value).cast("double")).alias("value_share"),
    )


def lag_diff(df: DataFrame, order: str, col: str, out: str = "diff") -> DataFrame:
    """Value − previous value along a unique order; the first is 0; cut to a whole number."""
    rows = with_neighbours(df, [], order, order, col)
    diff = F.coalesce(F.col(col) - F.col("_lag"), F.lit(0)).cast("long")
    return rows.withColumn(out, diff).select(*df.columns, out)


def group_transform(df: DataFrame, key: str, agg: Column, out: str) -> DataFrame:
    """Aggregate per group, given back to every row of the group."""
    table = df.dropna(subset=[key]).groupBy(key).agg(agg.alias(out))
    return attach(df, table, [key])


def neighbours(
    df: DataFrame, keys: Sequence[str], order: str, tie: str, col: str,
    prev: str = "prev", nxt: str = "next", hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Nearest non-null value before, and the value of the next row."""
    rows = with_neighbours(df, keys, order, tie, col, hot_rows)
    return rows.withColumnsRenamed({"_prev": prev, "_lead": nxt}).select(*df.columns, prev, nxt)


def rating(df: DataFrame, score: str) -> DataFrame:
    """First and last place that a row can take, equal scores sharing the range; highest score first."""
    counts = df.filter(F.col(score).isNotNull()).groupBy(score).agg(F.count(F.lit(1)).alias("_n"))
    places = running_total(counts, -F.col(score), F.col(score), {"place_last": F.col("_n")})
    places = places.select(
        score, (F.col("place_last") - F.col("_n") + 1).alias("place_first"), "place_last"
    )
    return attach(df, places, [score])


def durbin_watson(df: DataFrame, keys: Sequence[str], order: str, tie: str, resid: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Σ(eₜ − eₜ₋₁)² ÷ Σeₜ², differences taken inside a key (over all rows without keys)."""
    rows = with_neighbours(df.filter(F.col(resid).isNotNull()), keys, order, tie, resid, hot_rows)
    step = F.col(resid) - F.col("_lag")
    return rows.agg(F.try_divide(F.sum(step * step), F.sum(F.col(resid) * F.col(resid))).alias("durbin_watson"))


def _sort_keys(cols: Sequence[tuple[str, bool]], tie: Sequence[str]) -> list[Column]:
    """(name, ascending) pairs; nulls come last both ways."""
    out = [F.col(c).asc_nulls_last() if up else F.col(c).desc_nulls_last() for c, up in cols]
    return out + [F.col(t).asc_nulls_last() for t in tie]


def sort_stable(df: DataFrame, cols: Sequence[tuple[str, bool]], tie: Sequence[str]) -> DataFrame:
    """Sort by several columns; ties are settled by further columns."""
    return df.orderBy(*_sort_keys(cols, tie))


def top_k(df: DataFrame, cols: Sequence[tuple[str, bool]], k: int, tie: Sequence[str]) -> DataFrame:
    """The first k rows in sort order; each task keeps only its own k."""
    return df.orderBy(*_sort_keys(cols, tie)).limit(k)


def bottom_k(df: DataFrame, cols: Sequence[tuple[str, bool]], k: int, tie: Sequence[str]) -> DataFrame:
    """The last k rows of the same order, taken from its end; nulls last means they are taken first."""
    back = [F.col(c).desc_nulls_first() if up else F.col(c).asc_nulls_first() for c, up in cols]
    back += [F.col(t).desc_nulls_first() for t in tie]
    return df.orderBy(*back).limit(k)


def top_k_filtered(
    df: DataFrame, ts: str, col: str, day: str, t1: str, t2: str, k: int = 10, day_col: str | None = None
) -> DataFrame:
    """Most frequent values of a column on one weekday, strictly between two times of day."""
    name = F.col(day_col) if day_col else times.weekday_name(F.col(ts))
    return value_counts(time_between(df.filter(name == day), ts, t1, t2), col, k)


def filtered_top(
    df: DataFrame, pred: Column, sort: Sequence[tuple[str, bool]], limit: int, tie: Sequence[str]
) -> DataFrame:
    """Filter, sort, first rows."""
    return top_k(df.filter(pred), sort, limit, tie)
