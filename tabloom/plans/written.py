"""Cut lineage by a written table."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tabloom.session import shared_dir


def written(df: DataFrame, name: str) -> DataFrame:
    """Write once to the shared folder and read back.

    For tables that an iterative fit reads many times: a lost executor rereads
    files instead of recomputing what led to them.
    """
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
