"""Readers. Schemas are given, never inferred, so reading costs no extra pass."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _struct(schema: T.StructType | str) -> T.StructType:
    return T.StructType.fromDDL(schema) if isinstance(schema, str) else schema


def read_table(
    spark: SparkSession, path: str | Sequence[str], fmt: str = "csv", schema: T.StructType | str | None = None, **options
) -> DataFrame:
    """A file table; CSV means comma, UTF-8 and a header row unless options say otherwise."""
    defaults = {"header": True, "encoding": "UTF-8"} if fmt == "csv" else {}
    reader = spark.read.format(fmt).options(**{**defaults, **options})
    return (reader.schema(schema) if schema is not None else reader).load(path)


def read_delimited(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: T.StructType | str,
    sep: str = ";",
    decimal: str = ",",
    **options,
) -> DataFrame:
    """Separated text whose numbers may use a decimal comma; what does not parse is null."""
    fields = _struct(schema).fields
    raw = T.StructType([T.StructField(f.name, T.StringType()) for f in fields])
    df = read_table(spark, path, "csv", raw, sep=sep, **options)

    def typed(f: T.StructField):
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType, T.DecimalType)) and decimal != ".":
            c = F.replace(c, F.lit(decimal), F.lit("."))
        return c.try_cast(f.dataType).alias(f.name)

    return df.select(*[typed(f) for f in fields])


def read_lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """One row per line, in the column ``value``."""
    return spark.read.text(path)


def read_parquet(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    return spark.read.parquet(*([path] if isinstance(path, str) else path))


def _after_lines(n: int):
    """Leave out the first ``n`` lines of every file's first block."""

    def run(batches):
        block, left = None, 0
        for batch in batches:
            files, starts = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            keep, k = [], 0
            while k < len(files):
                if (files[k], starts[k]) != block:
                    block, left = (files[k], starts[k]), n if starts[k] == 0 else 0
                end = k
                while end < len(files) and (files[end], starts[end]) == block:
                    end += 1
                skipped = min(left, end - k)
                left -= skipped
                keep.append(batch.slice(k + skipped, end - k - skipped))
                k = end
            yield from (part.select(["value"]) for part in keep if part.num_rows)

    return run


def read_many(
    spark: SparkSession,
    groups: Iterable[tuple[str | Sequence[str], int]],
    schema: T.StructType | str,
    sep: str = ",",
) -> DataFrame:
    """Stack files of one layout whose header stands after ``skip`` leading lines.

    ``groups`` gives (path, glob or list of paths; lines before the header in
    each of those files). Only the block at offset 0 of a file can hold its
    preamble. A task reads a block's lines in their order, so it counts them off
    where such a block begins; how blocks are packed into tasks is of no matter.
    """
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in _struct(schema))

    def one(path: str | Sequence[str], skip: int) -> DataFrame:
        lines = spark.read.text(path).select(
            "value",
            F.col("_metadata.file_path").alias("_file"),
            F.col("_metadata.file_block_start").alias("_at"),
        )
        body = lines.mapInArrow(_after_lines(skip + 1), "value string").filter(F.length("value") > 0)
        return body.select(F.from_csv("value", ddl, {"sep": sep}).alias("_r")).select("_r.*")

    return reduce(DataFrame.unionByName, [one(path, skip) for path, skip in groups])
