"""Incremental feed: keep what is new, drop what was seen or is too old."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloom.session import shared_dir


def dedupe_stream(df: DataFrame, key: str, ts: str, delay: str, since: str | Column | None = None) -> DataFrame:
    """Drop keys already seen within ``delay`` and rows older than ``since``.

    State holds one entry per key and is cleared once the watermark has passed,
    so it does not grow with the length of the feed. The batch twin is
    ``first_by_key``.
    """
    if df.schema[ts].dataType.typeName() != "timestamp":
        df = df.withColumn(ts, F.col(ts).cast("timestamp"))
    if since is not None:
        cutoff = since if isinstance(since, Column) else F.to_timestamp(F.lit(since))
        df = df.filter(F.col(ts) >= cutoff)
    return df.withWatermark(ts, delay).dropDuplicatesWithinWatermark([key])


def drain(df: DataFrame, path: str, checkpoint: str | None = None) -> None:
    """Process all input that is there now, write it as Parquet, and stop."""
    place = checkpoint or shared_dir(df.sparkSession, "stream-state")
    query = (
        df.writeStream.format("parquet").outputMode("append")
        .option("checkpointLocation", place).trigger(availableNow=True).start(path)
    )
    query.awaitTermination()
