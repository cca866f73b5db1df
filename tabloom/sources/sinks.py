"""Writers. Every executor writes its own part files; nothing is gathered. An existing table is an error unless a mode says otherwise."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_csv(df: DataFrame, path: str, columns: Sequence[str] | None = None, mode: str = "error") -> None:
    """Header row, UTF-8, only the chosen columns."""
    out = df.select(*columns) if columns else df
    out.write.mode(mode).csv(path, header=True, encoding="UTF-8")


def write_text(df: DataFrame, path: str, columns: Sequence[str] | None = None, sep: str = "\t", mode: str = "error") -> None:
    """One line per row: the columns as text, joined by ``sep``; a null is an empty field."""
    cols = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns or df.columns]
    df.select(F.concat_ws(sep, *cols).alias("value")).write.mode(mode).text(path)


def write_parquet(df: DataFrame, path: str, mode: str = "error") -> None:
    df.write.mode(mode).parquet(path)


def write_json(df: DataFrame, path: str, mode: str = "error") -> None:
    """One JSON record per line; times keep their microseconds."""
    micros = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
    df.write.mode(mode).options(timestampFormat=micros + "XXX", timestampNTZFormat=micros).json(path)
