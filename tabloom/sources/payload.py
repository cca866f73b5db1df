"""Records out of JSON payload rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def from_payload(df: DataFrame, col: str, path: str, schema: str, keep: Sequence[str] = (), outer: bool = False) -> DataFrame:
    """One row per element of the array found at ``path`` (such as ``$.results`` or ``$[1]``).

    A payload without that array gives no row, or one row of nulls if ``outer``.
    """
    items = F.from_json(F.get_json_object(F.col(col), path), f"array<struct<{schema}>>")
    explode = F.explode_outer if outer else F.explode
    return df.select(*keep, explode(items).alias("_item")).select(*keep, "_item.*")


def flatten(df: DataFrame, fields: Mapping[str, str]) -> DataFrame:
    """Fixed list of fields by dotted path, each under its new header."""
    return df.select(*[F.col(path).alias(name) for name, path in fields.items()])


def names_by_status(df: DataFrame, status: str, allowed: Sequence[str], status_col: str, name_col: str) -> DataFrame:
    """Names of the rows with one status; a status that is not allowed gives nothing."""
    wanted = F.lit(status in allowed) & (F.col(status_col) == status)
    return df.filter(wanted).select(name_col)


def nested_lookup(df: DataFrame, col: str, outer: str, inner: str, children: str = "areas", out: str = "id") -> DataFrame:
    """Find ``outer`` by name in an array of structs, then ``inner`` among its children.

    The first match counts; the id of the inner struct is added, null if absent.
    """
    parents = F.filter(F.col(col), lambda p: p["name"] == outer)
    kids = F.filter(F.try_element_at(parents, F.lit(1))[children], lambda c: c["name"] == inner)
    return df.withColumn(out, F.try_element_at(kids, F.lit(1))["id"])
