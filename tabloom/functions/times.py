"""Time expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def weekday(col: Column) -> Column:
    """Monday is 0."""
    return F.weekday(col)


def weekday_name(col: Column) -> Column:
    """English weekday name, whatever the session locale is."""
    # fixed values: English weekday names, Monday first
    names = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]
    return F.element_at(F.array(*[F.lit(n) for n in names]), F.weekday(col) + 1)


def month(col: Column) -> Column:
    return F.month(col)


def year(col: Column) -> Column:
    return F.year(col)


def clock(col: Column, fmt: str = "HH:mm:ss") -> Column:
    """Time of day as text, ready for lexical comparison."""
    return F.date_format(col, fmt)


def parse(col: Column, fmt: str | None = None) -> Column:
    """Timestamp from text, null where it does not parse; an offset is honoured."""
    return F.try_to_timestamp(col, F.lit(fmt)) if fmt else F.try_to_timestamp(col)


def epoch(col: Column) -> Column:
    return F.unix_timestamp(col.cast("timestamp"))


def shift_months(col: Column, n: int) -> Column:
    """Same day ``n`` months later (earlier if negative), clipped to the month's last day."""
    return F.add_months(col, n)
