"""Text expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: the punctuation removed before words are counted
PUNCTUATION = ".,\"!?:;\\'`"


def lower(col: Column) -> Column:
    return F.lower(col)


def remove_chars(col: Column, chars: str = PUNCTUATION) -> Column:
    """Delete every character of the set; a tab becomes a blank."""
    return F.translate(F.translate(col, chars, ""), "\t", " ")


def strip_literals(col: Column, literals: Sequence[str]) -> Column:
    """Delete literal substrings one after the other; the order matters."""
    for s in literals:
        col = F.replace(col, F.lit(s), F.lit(""))
    return col


def cut_tail(col: Column, n: int) -> Column:
    """Drop the last ``n`` characters."""
    return F.substring(col, F.lit(1), F.greatest(F.length(col) - n, F.lit(0)))


def words(col: Column) -> Column:
    """Lower-cased words between any whitespace; empty ones, at the ends and in between, stay in."""
    blank = "\t\n\r\f\v"
    return F.split(F.translate(F.lower(col), blank + PUNCTUATION, " " * len(blank)), " ")


def join_fields(sep: str, *cols: Column) -> Column:
    return F.concat_ws(sep, *cols)


def similarity(a: Column, b: Column) -> Column:
    """1 − Levenshtein distance ÷ longer length; two empty strings are equal."""
    longer = F.greatest(F.length(a), F.length(b))
    return F.when(longer == 0, F.lit(1.0)).otherwise(1 - F.levenshtein(a, b) / longer)
