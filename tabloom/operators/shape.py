"""Projection, renaming and derived columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabloom.functions.predicates import flag_equal
from tabloom.plans.sizing import attach


def project(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Keep the named columns, in this order."""
    return df.select(*names)


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename; names that are absent are ignored."""
    return df.withColumnsRenamed(dict(mapping))


def rename_positional(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.toDF(*names)


def normalize_names(df: DataFrame) -> DataFrame:
    """Trim, lower-case, blanks to underscores."""
    return df.toDF(*[c.strip().lower().replace(" ", "_") for c in df.columns])


def conform(df: DataFrame, schema: T.StructType | str, constants: Mapping[str, object] | None = None) -> DataFrame:
    """Bring a table to a target schema: constants first, then own columns, else null."""
    struct = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    constants = constants or {}

    def source(name: str) -> Column:
        if name in constants:
            return F.lit(constants[name])
        return F.col(name) if name in df.columns else F.lit(None)

    return df.select(*[source(f.name).cast(f.dataType).alias(f.name) for f in struct])


def drop_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.drop(*names)


def derive(df: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    """Add columns; a later one may use an earlier one."""
    for name, expr in columns.items():
        df = df.withColumn(name, expr)
    return df


def scale_by(df: DataFrame, col: str, scalar_df: DataFrame, out: str) -> DataFrame:
    """Multiply a column by the value of a one-row, one-column aggregate."""
    (name,) = scalar_df.columns
    scalar = scalar_df.select(F.max(name).alias("_scalar"))
    return attach(df, scalar).withColumn(out, F.col(col) * F.col("_scalar")).drop("_scalar")


def convert(df: DataFrame, types: Mapping[str, str], formats: Mapping[str, str] | None = None) -> DataFrame:
    """Change types; what cannot be converted becomes null.

    ``date`` and ``timestamp`` take a pattern from ``formats``; the type ``year``
    turns a year number into the first day of that year. Fractions given to an
    integer type are cut off towards zero.
    """
    formats = formats or {}

    def cast(name: str, kind: str) -> Column:
        c = F.col(name)
        if kind == "year":
            return F.try_to_date(F.concat(c.cast("string"), F.lit("-01-01")))
        if kind == "timestamp" and name in formats:
            return F.try_to_timestamp(c, F.lit(formats[name]))
        if kind == "date" and name in formats:
            return F.try_to_timestamp(c, F.lit(formats[name])).cast("date")
        if kind in ("int", "bigint", "long") and dict(df.dtypes)[name] == "string":
            c = c.try_cast("double")
        return c.try_cast(kind)

    return df.withColumns({n: cast(n, k) for n, k in types.items()})


def flag_token(df: DataFrame, col: str, token: str, out: str) -> DataFrame:
    """Split a mixed text column into a 0/1 flag for the token and whole points.

    Token, null and unreadable text count 0 points. A row that found no partner
    in a left join is null here and so counts as present with 0 points.
    """
    flag = flag_equal(F.col(col), token)
    return df.withColumn(out, flag).withColumn(col, F.coalesce(F.col(col).try_cast("double").cast("int"), F.lit(0)))
