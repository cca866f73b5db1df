"""Predicates that keep null rows where data frames keep them."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def is_in(col: Column, values: Sequence) -> Column:
    """Membership; false for null."""
    return F.coalesce(col.isin(*values), F.lit(False))


def not_in(col: Column, values: Sequence) -> Column:
    """Non-membership; a null is in no list and is kept."""
    return ~is_in(col, values)


def differs(col: Column, value) -> Column:
    """``col != value``, true for null."""
    return ~col.eqNullSafe(value)


def has_text(col: Column, s: str) -> Column:
    """Substring anywhere; false for null."""
    return F.coalesce(F.contains(col, F.lit(s)), F.lit(False))


def has_any(col: Column, words: Sequence[str]) -> Column:
    """At least one of the substrings."""
    return reduce(lambda a, b: a | b, [has_text(col, w) for w in words])


def flag_equal(col: Column, value) -> Column:
    """1 where the value is met, 0 elsewhere and for null."""
    return col.eqNullSafe(value).cast("int")
