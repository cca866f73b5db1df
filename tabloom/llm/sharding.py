"""Contiguous shards of equal bytes from global prefix sums.

Rows are dealt by ranges of their id and sorted, each task adds up its own
bytes, and the totals per range (one row each) give every range its global
start. A row's shard follows from the middle of its bytes on the global line,
cut at equal targets, so shards are contiguous in id order and differ by about
one row's size. The law held is ``bytes``; equal texts are not kept together,
since a group of copies may be larger than a shard.

The dealt rows are written before they are added up: both passes then see the
same ranges, and a lost executor rereads files.

Cases: a null text has no bytes and checksum 0, and still counts one byte; a
null id sorts first; equal ids are ordered by size and checksum, rows equal in
all three take neighbouring slots; an empty table gives no rows; shards may be
empty when there are fewer rows than shards; further columns are only carried
if they are named in ``keep``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.llm.files import mapped
from tabloom.plans.written import written


def prefix_sums(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> tuple[DataFrame, int]:
    """Rows with ``size``, ``text_crc32``, and the rows and bytes before them in id order; and all bytes."""
    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    rows = docs.select(F.col(id_col).alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"), *(F.col(c).alias(f"_{c}") for c in keep))

    def add_up(batches):
        part, n, total = TaskContext.get().partitionId(), 0, 0
        for batch in batches:
            sizes = batch.column(1).to_numpy()
            upto = total + np.cumsum(sizes)
            own = [np.full(len(sizes), part, np.int32), n + np.arange(len(sizes)), upto - sizes]
            yield pa.RecordBatch.from_arrays([*batch.columns, *map(pa.array, own)], names=[*batch.schema.names, "part", "row", "before"])
            n += len(sizes)
            total = int(upto[-1]) if len(sizes) else total

    order = ["doc_id", "size", "text_crc32"]
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    dealt = written(mapped(dealt, add_up, f"{fields}, part int, row long, before long"), "shard-rows")
    totals = dealt.groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("bytes")).toArrow().sort_by("part")
    n, size = totals["n"].to_numpy(), totals["bytes"].to_numpy()
    starts = pa.table({"part": totals["part"], "row0": pa.array(np.cumsum(n) - n, pa.int64()), "byte0": pa.array(np.cumsum(size) - size, pa.int64())})
    known = F.broadcast(docs.sparkSession.createDataFrame(starts, "part int, row0 long, byte0 long"))  # one row per range
    placed = dealt.join(known, "part").withColumn("row", F.col("row") + F.col("row0")).withColumn("before", F.col("before") + F.col("byte0"))
    return placed.drop("part", "row0", "byte0"), int(size.sum())


def balanced_shards(docs: DataFrame, shards: int = 8, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """Each row's size, checksum, law, shard and slot, and the columns in ``keep``."""
    placed, total = prefix_sums(docs, id_col, text_col, keep)
    middle = F.col("before") * 2 + F.col("size")
    shard = F.least(F.expr("_mid * _shards div _all"), F.lit(shards - 1)).cast("int")
    placed = placed.withColumns({"_mid": middle, "_shards": F.lit(shards).cast("long"), "_all": F.lit(max(1, 2 * total)).cast("long")})
    placed = placed.withColumn("shard", shard)
    first = F.broadcast(placed.groupBy("shard").agg(F.min("row").alias("first")))  # at most ``shards`` rows
    out = placed.join(first, "shard")
    return out.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("row") - F.col("first")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"), *(F.col(f"_{c}").alias(c) for c in keep),
    )


def write_shards(docs: DataFrame, folder: str, shards: int = 8, **cols) -> None:
    """Texts by shard: one folder per shard, written by as many tasks as there are ranges."""
    balanced_shards(docs, shards, keep=("text",), **cols).write.partitionBy("shard").parquet(folder)
