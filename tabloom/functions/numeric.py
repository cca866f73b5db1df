"""Number expressions with the null and rounding rules of data frames."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def absolute(col: Column) -> Column:
    return F.abs(col)


def log(col: Column) -> Column:
    """Natural logarithm; null where it is not finite."""
    return F.when(col > 0, F.ln(col))


def log1p(col: Column) -> Column:
    return F.when(col > -1, F.log1p(col))


def round_even(col: Column, digits: int = 0) -> Column:
    """Round half to even."""
    return F.bround(col, digits)


def truncate(col: Column) -> Column:
    """Whole part, towards zero."""
    return col.cast("long")


def ratio(a: Column, b: Column) -> Column:
    """a / b, null where b is zero."""
    return F.try_divide(a.cast("double"), b.cast("double"))


def relative_change(a: Column, b: Column) -> Column:
    """a / b − 1, null where b is zero."""
    return ratio(a, b) - 1
