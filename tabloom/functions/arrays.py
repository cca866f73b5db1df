"""Array and struct expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def size(col: Column) -> Column:
    return F.size(col)


def sorted_list(col: Column) -> Column:
    return F.sort_array(col)


def first_match(col: Column, field: str, value) -> Column:
    """First struct of an array whose field equals the value, else null."""
    return F.try_element_at(F.filter(col, lambda s: s[field] == value), F.lit(1))


def if_null(col: Column, value) -> Column:
    return F.coalesce(col, F.lit(value))
