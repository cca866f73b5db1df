"""Unions, distinct rows and the turnover between stages."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Stack tables by column name; a column missing from one is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def distinct_rows(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Distinct rows, of the chosen columns if given."""
    return (df.select(*cols) if cols else df).distinct()


def set_turnover(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Keys of two sets: how many stayed, left and are new."""
    marked = a.select(key).distinct().withColumn("_a", F.lit(1)).withColumn("_b", F.lit(0)).unionByName(
        b.select(key).distinct().withColumn("_a", F.lit(0)).withColumn("_b", F.lit(1))
    )
    per_key = marked.groupBy(key).agg(F.max("_a").alias("a"), F.max("_b").alias("b"))
    return per_key.agg(
        F.count_if((F.col("a") == 1) & (F.col("b") == 1)).alias("stayed"),
        F.count_if((F.col("a") == 1) & (F.col("b") == 0)).alias("left"),
        F.count_if((F.col("a") == 0) & (F.col("b") == 1)).alias("new"),
    )


def transition_edges(stages: Mapping[str, DataFrame], key: str) -> DataFrame:
    """Edges of the flow between consecutive stages: source, target, value.

    From each stage one edge leads to the next stage (those who stayed) and one
    to ``left <stage>`` (those who dropped out). A zero edge is kept.
    """
    names = list(stages)
    parts = []
    for src, dst in zip(names, names[1:]):
        t = set_turnover(stages[src], stages[dst], key)
        parts.append(
            t.select(
                F.inline(
                    F.array(
                        F.struct(F.lit(src).alias("source"), F.lit(dst).alias("target"), F.col("stayed").alias("value")),
                        F.struct(
                            F.lit(src).alias("source"), F.lit(f"left {src}").alias("target"), F.col("left").alias("value")
                        ),
                    )
                )
            )
        )
    return union_all(parts)
