"""Customers at risk: features from long tables, and the segment that carries the profit."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.functions import numeric
from tabloom.operators import joins
from tabloom.operators.aggregate import pivot_mean
from tabloom.operators.filters import drop_at_max


def features(
    market: DataFrame, money: DataFrame, minutes: DataFrame, periods: Sequence[str], minute_periods: Sequence[str],
    current: str, previous: str,
) -> DataFrame:
    """One row per customer: own columns, revenue per period, minutes per period.

    ``money`` and ``minutes`` are long (id, period, value). The customer with the
    largest current revenue, an entry error, and those without revenue in the
    previous period are left out. Equal period names get a suffix.
    """
    revenue = pivot_mean(money, "id", "period", "value", periods)
    revenue = drop_at_max(revenue, current).filter(F.col(previous) > 0)
    spent = pivot_mean(minutes, "id", "period", "value", minute_periods)
    return joins.join_suffixed(joins.join_suffixed(market, revenue, "id", "_revenue"), spent, "id", "_minutes")


def revenue_change(df: DataFrame, current: str, previous: str, out: str = "revenue_change") -> DataFrame:
    """Current revenue over previous, minus one; null where there was none."""
    return df.withColumn(out, numeric.relative_change(F.col(current), F.col(previous)))
