"""Values to categories: maps, bands, ordered rules."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _chain(pairs: Sequence[tuple[Column, object]], default: Column | None = None) -> Column:
    out = F
    for cond, value in pairs:
        out = out.when(cond, F.lit(value))
    return out if default is None else out.otherwise(default)


def lookup(col: Column, mapping: Mapping, default: Column | None = None) -> Column:
    """Mapped value, else the default (null if none)."""
    hits = [(col == k, v) for k, v in mapping.items() if v is not None]
    return _chain(hits, default)


def bands(col: Column, edges: Sequence[tuple[float, float | None]], labels: Sequence[str]) -> Column:
    """Closed bands (low, high); an open end is None; no band gives null."""
    tests = [(col >= lo) if hi is None else col.between(lo, hi) for lo, hi in edges]
    return _chain(list(zip(tests, labels)))


def first_containing(col: Column, rules: Sequence[tuple[str | Sequence[str], str]]) -> Column:
    """Label of the first rule with a substring in the text; else null."""
    pairs = []
    for needles, label in rules:
        needles = [needles] if isinstance(needles, str) else list(needles)
        cond = F.contains(col, F.lit(needles[0]))
        for n in needles[1:]:
            cond = cond | F.contains(col, F.lit(n))
        pairs.append((cond, label))
    return _chain(pairs)


def member_of(col: Column, sets: Mapping[str, Sequence]) -> Column:
    """Label of the first set that holds the value; else null."""
    return _chain([(col.isin(*values), label) for label, values in sets.items()])


def position(pos: Column, total: Column, first="first", last="last", other="other") -> Column:
    """First, last or other place; a single place is first."""
    return F.when(pos == 1, F.lit(first)).when(pos == total, F.lit(last)).otherwise(F.lit(other))
