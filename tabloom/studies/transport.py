"""Transport layers of one country brought to one schema."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame

from tabloom.operators.sets import union_all
from tabloom.operators.shape import conform, rename

SCHEMA = (
    "country string, transport string, geometry string, name string, type string, scalerank int, natrlscale double,"
    " abbrev string, website string, road_class string"
)


def layer(df: DataFrame, country: str, transport: str, names: Mapping[str, str], constants: Mapping[str, object] | None = None) -> DataFrame:
    """One layer in the common schema; geometry is carried as text."""
    return conform(rename(df, names), SCHEMA, {"country": country, "transport": transport, **(constants or {})})


def stack(layers: Sequence[DataFrame]) -> DataFrame:
    """Layers of one kind of geometry; points and lines are stacked separately."""
    return union_all(layers)
