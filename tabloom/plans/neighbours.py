"""Previous and next values along an order, also for keys that hold most rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabloom.plans.blocks import with_blocks
from tabloom.plans.sizing import hot_keys, pinned_if_small

HOT_ROWS = 5_000_000


def with_neighbours(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    tie: str,
    col: str,
    hot_rows: int = HOT_ROWS,
    n_blocks: int | None = None,
) -> DataFrame:
    """Add, per key and in (order, tie) order, the surroundings of ``col``.

    ``_pos``: 1-based position. ``_lag``, ``_lead``: value of the row before and
    after. ``_prev``, ``_next``: nearest non-null value before and after, with
    ``_prev_pos`` and ``_next_pos``. Unused ones are pruned by the optimizer.

    Ordinary keys are one window partition each. A key with more than
    ``hot_rows`` rows, and the whole table when there is no key, is cut into
    order blocks; each block then gets its missing context from a table with one
    row per hot key and block.
    """
    keys = list(keys)
    split = _split_hot(df, keys, order, tie, hot_rows, n_blocks)
    rows, hot = split if split else (df.withColumn("_block", F.lit(None).cast("long")), False)

    part = [*keys, "_block"]
    fwd = Window.partitionBy(*part).orderBy(F.col(order), F.col(tie))
    back = Window.partitionBy(*part).orderBy(F.col(order).desc(), F.col(tie).desc())
    past_f = fwd.rowsBetween(Window.unboundedPreceding, -1)
    past_b = back.rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("_pos", F.row_number().over(fwd).cast("long"))
    own_pos = F.when(F.col(col).isNotNull(), F.col("_pos"))
    rows = rows.withColumns(
        {
            "_lag": F.lag(col).over(fwd),
            "_lead": F.lead(col).over(fwd),
            "_ends": F.lead(F.lit(False), 1, True).over(fwd),
            "_prev": F.last(col, ignorenulls=True).over(past_f),
            "_prev_pos": F.last(own_pos, ignorenulls=True).over(past_f),
        }
    ).withColumns(
        {
            "_next": F.last(col, ignorenulls=True).over(past_b),
            "_next_pos": F.last(own_pos, ignorenulls=True).over(past_b),
        }
    )
    if hot:
        rows = _carry(rows, keys, col, own_pos)
    return rows.drop("_block", "_ends")


def _split_hot(df, keys, order, tie, hot_rows, n_blocks):
    if not keys:
        return with_blocks(df, F.col(order), F.col(tie), "_block", n_blocks), True
    hot = hot_keys(df, keys, hot_rows)
    if hot is None:
        return None
    probe = same_keys(df, hot, keys, "left_semi")
    blocked = with_blocks(df, F.col(order), F.col(tie), "_block", n_blocks, probe)
    flagged = same_keys(blocked, hot.withColumn("_hot", F.lit(True)), keys, "left")
    return flagged.withColumn("_block", F.when(F.col("_hot"), F.col("_block"))).drop("_hot"), True


def same_keys(df: DataFrame, other: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Join on keys of which null equals null; the keys come from ``df``."""
    renamed = other.withColumnsRenamed({k: f"_same_{k}" for k in keys})
    cond = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_same_{k}")) for k in keys])
    return df.join(renamed, cond, how).drop(*[f"_same_{k}" for k in keys])


def _carry(rows: DataFrame, keys: list[str], col: str, own_pos) -> DataFrame:
    """Fill what lies outside a row's block from the summaries of the other blocks."""
    filled = F.when(F.col(col).isNotNull(), F.col("_pos"))
    # lists a struct where the value may be null, so that min_by keeps it
    summary = (
        rows.filter(F.col("_block").isNotNull())
        .groupBy(*keys, "_block")
        .agg(
            F.count(F.lit(1)).alias("_n"),
            F.min_by(col, "_pos").alias("_head"),
            F.max_by(col, "_pos").alias("_tail"),
            F.min_by(col, filled).alias("_first"),
            F.min(own_pos).alias("_first_pos"),
            F.max_by(col, filled).alias("_last"),
            F.max(own_pos).alias("_last_pos"),
        )
    )
    along = Window.partitionBy(*keys).orderBy("_block")
    past = along.rowsBetween(Window.unboundedPreceding, -1)
    ahead = Window.partitionBy(*keys).orderBy(F.col("_block").desc()).rowsBetween(Window.unboundedPreceding, -1)
    summary = summary.withColumn("_off", F.coalesce(F.sum("_n").over(past), F.lit(0)))
    carry = summary.select(
        *keys,
        "_block",
        "_off",
        F.lag("_tail").over(along).alias("_c_lag"),
        F.lead("_head").over(along).alias("_c_lead"),
        F.last("_last", ignorenulls=True).over(past).alias("_c_prev"),
        F.last(F.col("_last_pos") + F.col("_off"), ignorenulls=True).over(past).alias("_c_prev_pos"),
        F.last("_first", ignorenulls=True).over(ahead).alias("_c_next"),
        F.last(F.col("_first_pos") + F.col("_off"), ignorenulls=True).over(ahead).alias("_c_next_pos"),
    )
    carry, _ = pinned_if_small(carry)
    out = same_keys(rows, carry, [*keys, "_block"], "left")
    off = F.coalesce(F.col("_off"), F.lit(0))
    return out.withColumns(
        {
            "_lag": F.when(F.col("_pos") == 1, F.col("_c_lag")).otherwise(F.col("_lag")),
            "_lead": F.when(F.col("_ends"), F.col("_c_lead")).otherwise(F.col("_lead")),
            "_prev": F.coalesce("_prev", "_c_prev"),
            "_prev_pos": F.coalesce(F.col("_prev_pos") + off, "_c_prev_pos"),
            "_next": F.coalesce("_next", "_c_next"),
            "_next_pos": F.coalesce(F.col("_next_pos") + off, "_c_next_pos"),
        }
    ).withColumn("_pos", F.col("_pos") + off).drop(
        "_off", "_c_lag", "_c_lead", "_c_prev", "_c_prev_pos", "_c_next", "_c_next_pos"
    )
