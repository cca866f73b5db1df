"""Cut a total order into blocks, so that an ordered scan runs block by block.

Block limits are (order, tie) pairs, literal values taken once from a bounded sample of
the rows. A block id is therefore a pure function of the row: a lost executor recomputes
the same blocks, and nothing has to be materialised between passes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

#: Sampled rows per block, and characters of a text that a block limit holds.
SAMPLED, LIMIT_CHARS = 64, 256


def _sortable(df: DataFrame, c: Column) -> tuple[Column, DataType]:
    """The column as a value that a literal holds exactly and that sorts as the column does, with its type."""
    kind = df.select(c.alias("c")).schema["c"].dataType.typeName()
    if kind in ("timestamp", "date"):
        c = F.unix_micros(c.cast("timestamp"))
    elif kind == "timestamp_ntz":
        c = F.unix_micros(F.to_utc_timestamp(c.cast("timestamp"), F.current_timezone()))
    return c, df.select(c.alias("c")).schema["c"].dataType


def block_limits(rows: DataFrame, n: int) -> list[tuple]:
    """Up to n - 1 pairs that cut ``rows(o, t)`` into parts of about equal size.

    The sample is the rows with the smallest hashes, so each task keeps a bounded number
    of them; the row number in the hash spreads rows that are equal in both columns.
    A long text's beginning serves as a limit as well as the text: any pair may be one.
    """
    short = [F.substring(c, 1, LIMIT_CHARS).alias(c) if k in ("string", "binary") else F.col(c) for c, k in rows.dtypes]
    hashed = rows.select(*short, F.xxhash64("o", "t", F.monotonically_increasing_id()).alias("h"))
    sample = hashed.orderBy("h").limit(SAMPLED * n).drop("h").orderBy("o", "t").collect()
    at = sorted({len(sample) * k // n for k in range(1, n)} - {0})
    return list(dict.fromkeys((sample[i]["o"], sample[i]["t"]) for i in at if i < len(sample)))


def _located(df: DataFrame, point: Column, limits: Sequence[tuple], kinds: Sequence[DataType], out: str) -> DataFrame:
    """How many limits are at or below the point, by halving; nulls sort first, as in a window."""
    lit = lambda v, kind: F.lit(v).cast(kind)
    table = F.array(*(F.struct(lit(o, kinds[0]).alias("o"), lit(t, kinds[1]).alias("t")) for o, t in limits))
    df = df.withColumn(out, F.lit(0).cast("long"))
    for k in reversed(range(len(limits).bit_length())):
        ahead = F.col(out) + (1 << k)
        df = df.withColumn(out, F.when(F.get(table, (ahead - 1).cast("int")) <= point, ahead).otherwise(F.col(out)))
    return df


def with_blocks(
    df: DataFrame,
    order: Column,
    tie: Column,
    out: str = "_block",
    n_blocks: int | None = None,
    probe: DataFrame | None = None,
) -> DataFrame:
    """Add a block id that never decreases along (order, tie), nulls first.

    ``order`` and ``tie`` may be of any type that can be sorted. There are as many blocks
    as shuffle partitions unless told otherwise. Limits compare whole values, first
    ``order``, then ``tie``: a value of ``order`` held by a large part of the rows (null
    is one) is cut along ``tie``, so no block grows with it. ``probe`` gives other rows
    from which to take the limits.
    """
    n = n_blocks or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    (o, o_kind), (t, t_kind) = _sortable(df, order), _sortable(df, tie)
    limits = block_limits((probe if probe is not None else df).select(o.alias("o"), t.alias("t")), n)
    if not limits:
        return df.withColumn(out, F.lit(0).cast("long"))
    point = F.struct(F.col("_bo").alias("o"), F.col("_bt").alias("t"))
    return _located(df.withColumns({"_bo": o, "_bt": t}), point, limits, (o_kind, t_kind), out).drop("_bo", "_bt")


def running_total(
    df: DataFrame, order: Column, tie: Column, totals: dict[str, Column], n_blocks: int | None = None
) -> DataFrame:
    """Inclusive running sums over all rows in (order, tie) order.

    The plan is a sum per block, a prefix over the block sums (one small row per
    block) and a window inside each block. ``totals`` maps new names to the
    summed expressions.
    """
    # the order value is stored, so a tie on it is decided by the tie column alone
    blocked = with_blocks(df, order, tie, "_block", n_blocks)
    sums = blocked.groupBy("_block").agg(*[F.sum(e).alias(f"_s_{k}") for k, e in totals.items()])
    before = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(
        "_block", *[F.sum(f"_s_{k}").over(before).alias(f"_o_{k}") for k in totals]
    )
    upto = Window.partitionBy("_block").orderBy(order, tie).rowsBetween(Window.unboundedPreceding, 0)
    out = blocked.join(F.broadcast(offsets), "_block")
    for k, e in totals.items():
        out = out.withColumn(k, F.coalesce(F.sum(e).over(upto), F.lit(0)) + F.coalesce(F.col(f"_o_{k}"), F.lit(0)))
    return out.drop("_block", *[f"_o_{k}" for k in totals])
