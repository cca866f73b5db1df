"""Broadcast only what has been measured to be small."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MAX_ROWS = 50_000
MAX_BYTES = 32 << 20


def pinned_if_small(
    df: DataFrame, max_rows: int = MAX_ROWS, max_bytes: int = MAX_BYTES
) -> tuple[DataFrame, pa.Table | None]:
    """Evaluate ``df`` once, at most ``max_rows + 1`` rows of it.

    If it fits both bounds, the rows come back as a local table with a
    broadcast hint, and as Arrow. Otherwise ``df`` itself comes back, still
    lazy, with None: the caller joins it by shuffle.
    """
    table = df.limit(max_rows + 1).toArrow()
    if table.num_rows > max_rows or table.nbytes > max_bytes:
        return df, None
    return F.broadcast(df.sparkSession.createDataFrame(table, df.schema)), table


def attach(df: DataFrame, lookup: DataFrame, on: Sequence[str] = (), how: str = "left") -> DataFrame:
    """Join a per-key table (one row per key) to the rows of ``df``.

    A lookup measured to be small is broadcast, so ``df`` does not move. A
    larger one is joined by shuffle, where adaptive execution splits hot keys.
    With no keys the lookup must have one row, as an aggregate without groups
    has; more rows raise an error instead of multiplying ``df``.
    """
    if not on:
        rows = lookup.select(F.struct(*lookup.columns).alias("_row"))
        fail = F.raise_error(F.lit("a lookup without keys has several rows"))
        one = rows.agg(F.when(F.count(F.lit(1)) <= 1, F.first("_row")).otherwise(fail).alias("_row"))
        return df.crossJoin(F.broadcast(one)).select(*df.columns, "_row.*")
    small, _ = pinned_if_small(lookup)
    return df.join(small, list(on), how)


def value_table(spark: SparkSession, name: str, values: Sequence, kind: str) -> DataFrame:
    """A one-column table of values that the caller already holds in memory."""
    return spark.createDataFrame(pa.table({name: list(values)}), f"`{name}` {kind}")


def spread(df: DataFrame) -> DataFrame:
    """Deal a table's rows out to all cores when its files give fewer splits than there are cores.

    Meant for plain scans of small files that feed heavy expressions; a table
    with enough splits, as any large one has, is returned as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def hot_keys(df: DataFrame, keys: Sequence[str], hot_rows: int) -> DataFrame | None:
    """Keys with more than ``hot_rows`` rows (at most rows/hot_rows of them), or None."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    found, table = pinned_if_small(counts.filter(F.col("_n") > hot_rows).select(*keys))
    return None if table is not None and table.num_rows == 0 else found


def packed(df: DataFrame, rows_per_task: int = 20_000) -> DataFrame:
    """Fewer, fuller partitions for a small table that an iterative fit passes over many times.

    Every pass pays for every task. A table large enough for its partitions
    keeps them.
    """
    return df.coalesce(max(1, -(-df.count() // rows_per_task)))
