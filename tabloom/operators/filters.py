"""Row filters with explicit null behaviour."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloom.functions import predicates, times
from tabloom.plans.sizing import attach, value_table

IN_LIST_LIMIT = 200


def where(df: DataFrame, cond: str | Column) -> DataFrame:
    """Rows for which a condition, given as text or as a column, is true."""
    return df.filter(cond)


def keep_in(df: DataFrame, col: str, values: Sequence) -> DataFrame:
    """Rows whose value is in the list; a null in the list matches nothing. Long lists become a semi join."""
    values = [v for v in values if v is not None]
    if len(values) <= IN_LIST_LIMIT:
        return df.filter(predicates.is_in(F.col(col), values))
    return df.join(_value_table(df, col, values), col, "left_semi")


def keep_not_in(df: DataFrame, col: str, values: Sequence) -> DataFrame:
    """Rows whose value is not in the list, null included, whether or not the list holds a null. Long lists become an anti join."""
    values = [v for v in values if v is not None]
    if len(values) <= IN_LIST_LIMIT:
        return df.filter(predicates.not_in(F.col(col), values))
    return df.join(_value_table(df, col, values), col, "left_anti")


def _value_table(df: DataFrame, col: str, values: Sequence) -> DataFrame:
    return value_table(df.sparkSession, col, sorted(set(values)), df.schema[col].dataType.simpleString())


def contains(df: DataFrame, col: str, s: str) -> DataFrame:
    """Rows with the substring anywhere in the column; null is out."""
    return df.filter(predicates.has_text(F.col(col), s))


def exclude_where(df: DataFrame, pred: Column) -> DataFrame:
    """Drop the rows for which the predicate is true; unknown is kept."""
    return df.filter(~F.coalesce(pred, F.lit(False)))


def drop_missing(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Drop rows with a null in any of the columns."""
    return df.na.drop(subset=list(subset) if subset else None)


def drop_at_max(df: DataFrame, col: str) -> DataFrame:
    """Drop all rows at the maximum, and those without a value."""
    top = df.agg(F.max(col).alias("_top"))
    return attach(df, top).filter(F.col(col) < F.col("_top")).drop("_top")


def rows_at_extreme(df: DataFrame, col: str, which: str = "max") -> DataFrame:
    """All rows that hold the column's maximum or minimum."""
    edge = df.agg({"max": F.max, "min": F.min}[which](col).alias("_edge"))
    return attach(df, edge).filter(F.col(col) == F.col("_edge")).drop("_edge")


def time_between(df: DataFrame, ts: str, t1: str, t2: str) -> DataFrame:
    """Rows whose time of day lies strictly between two clock texts."""
    clock = F.col(ts) if dict(df.dtypes)[ts] == "string" else times.clock(F.col(ts))
    return df.filter((clock > t1) & (clock < t2))


def since_months(df: DataFrame, ts: str, n: int, as_of: str) -> DataFrame:
    """Rows not older than ``n`` calendar months before the day ``as_of``."""
    cutoff = F.add_months(F.to_date(F.lit(as_of)), -n)
    return df.filter(F.col(ts) >= cutoff.cast(df.schema[ts].dataType))


def in_period_with_keywords(
    df: DataFrame, ts: str, lo: str, hi: str, text: str, words: Sequence[str]
) -> DataFrame:
    """Rows from instant ``lo`` to instant ``hi`` (both included) that hold any keyword."""
    kind = df.schema[ts].dataType
    period = F.col(ts).between(F.lit(lo).cast(kind), F.lit(hi).cast(kind))
    return df.filter(period & predicates.has_any(F.lower(F.col(text)), [w.lower() for w in words]))
