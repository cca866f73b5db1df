"""Value repair and categories."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloom.functions import categories, text
from tabloom.plans.quantiles import exact_quantiles
from tabloom.plans.sizing import attach
from tabloom.plans.written import written


def replace_values(df: DataFrame, col: str, mapping: Mapping, out: str | None = None) -> DataFrame:
    """Exact values to new ones, all others unchanged."""
    return df.withColumn(out or col, categories.lookup(F.col(col), mapping, F.col(col)))


def strip_tokens(
    df: DataFrame, col: str, tokens: Sequence[str], chars: tuple[str, str] | None = None, out: str | None = None
) -> DataFrame:
    """Lower-case, translate characters, then delete literal tokens in order.

    An earlier deletion can create or destroy a later match, as with any
    ordered edit list; a token that holds a translated character never matches.
    """
    c = F.lower(F.col(col))
    if chars:
        c = F.translate(c, *chars)
    return df.withColumn(out or col, text.strip_literals(c, tokens))


def replace_literals(df: DataFrame, col: str, edits: Sequence[tuple[str, str]], out: str | None = None) -> DataFrame:
    """Literal substring edits in order, case kept."""
    c = F.col(col)
    for old, new in edits:
        c = F.replace(c, F.lit(old), F.lit(new))
    return df.withColumn(out or col, c)


def bucketize(
    df: DataFrame, col: str, edges: Sequence[tuple[float, float | None]], labels: Sequence[str], out: str
) -> DataFrame:
    """Closed bands; a value between or below them has no label."""
    return df.withColumn(out, categories.bands(F.col(col), edges, labels))


def categorize_contains(df: DataFrame, col: str, rules, out: str, missing: str | None = None) -> DataFrame:
    """First matching rule wins; no match is null; ``missing`` is the label of a null text."""
    label = categories.first_containing(F.col(col), rules)
    if missing is not None:
        label = F.when(F.col(col).isNull(), F.lit(missing)).otherwise(label)
    return df.withColumn(out, label)


def categorize_members(df: DataFrame, col: str, sets: Mapping[str, Sequence], out: str) -> DataFrame:
    """Label of the first set that holds the value; else null."""
    return df.withColumn(out, categories.member_of(F.col(col), sets))


def score_map(df: DataFrame, col: str, mapping: Mapping[str, int], out: str) -> DataFrame:
    """Ordinal answers to points; others null."""
    return df.withColumn(out, categories.lookup(F.col(col), mapping))


def shorten_labels(
    df: DataFrame, col: str, mapping: Mapping[str, str], to_null: Sequence[str] = (), out: str | None = None
) -> DataFrame:
    """Listed labels get short, some become null, all others stay."""
    short = categories.lookup(F.col(col), mapping, F.col(col))
    if to_null:
        short = F.when(~F.coalesce(F.col(col).isin(*to_null), F.lit(False)), short)
    return df.withColumn(out or col, short)


def position_group(df: DataFrame, pos: str, total: str, out: str, labels=("first", "last", "other")) -> DataFrame:
    """First place, last place or other; first wins."""
    return df.withColumn(out, categories.position(F.col(pos), F.col(total), *labels))


def apply_corrections(df: DataFrame, corrections: DataFrame, key: str, col: str) -> DataFrame:
    """Point fixes from a table (``key``, ``new_value``, ``set_null``), one row per key.

    A key listed with ``set_null`` clears the cell, otherwise ``new_value``
    replaces it; keys not listed stay as they are. Two fixes for one key are an
    error, since they would multiply the row.
    """
    checked = corrections.groupBy(key).agg(
        F.when(F.count(F.lit(1)) > 1, F.raise_error(F.lit("more than one correction for a key")).cast("string"))
        .alias("_dup"),
        F.max("new_value").alias("_new"),
        F.max("set_null").alias("_null"),
    )
    fixed = F.when(F.coalesce("_null", F.lit(False)), F.lit(None)).when(F.col("_dup").isNull(), F.coalesce("_new", col))
    return attach(df, checked, [key]).withColumn(col, fixed).drop("_new", "_null", "_dup")


def conditional_set(df: DataFrame, mask: Column, col: str, value) -> DataFrame:
    """Overwrite where the mask is true; elsewhere, and where it is unknown, keep."""
    return df.withColumn(col, F.when(mask, F.lit(value)).otherwise(F.col(col)))


def speed_class(
    df: DataFrame,
    col: str,
    lo_q: float = 0.25,
    hi_q: float = 0.75,
    out: str = "speed",
    labels: tuple[str, str, str] = ("fast", "normal", "slow"),
) -> DataFrame:
    """Below the low quantile fast, above the high one slow."""
    # the quantiles pass over the values several times; they are written once, so that no pass repeats the joins they come from
    q = exact_quantiles(written(df.select(col), "speed"), col, [lo_q, hi_q]).select(
        F.col("quantiles")[0].alias("_lo"), F.col("quantiles")[1].alias("_hi")
    )
    label = (
        F.when(F.col(col) < F.col("_lo"), F.lit(labels[0]))
        .when(F.col(col) > F.col("_hi"), F.lit(labels[2]))
        .when(F.col(col).isNotNull(), F.lit(labels[1]))
    )
    return attach(df, q).withColumn(out, label).drop("_lo", "_hi")
