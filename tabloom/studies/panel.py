"""Country panel: assemble, add indicators, fill gaps, regress."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.functions import numeric
from tabloom.operators import joins, missing
from tabloom.operators.aggregate import indicators_wide
from tabloom.operators.filters import drop_missing, keep_not_in
from tabloom.operators.shape import derive, rename_positional
from tabloom.operators.stats import OlsFit, ols


def assemble(exports: DataFrame, imports: DataFrame, gdp: DataFrame, excluded: Sequence[str] = ()) -> DataFrame:
    """One row per country and year with trade, its shares of output in logarithms, and no missing exports.

    Each input has the columns (country, year, value); zero output gives a null share.
    """
    keys = ["country", "year"]
    sides = [rename_positional(d, [*keys, n]) for d, n in ((exports, "export"), (imports, "import"), (gdp, "gdp"))]
    df = joins.inner_join(joins.inner_join(keep_not_in(sides[0], "country", excluded), sides[1], keys), sides[2], keys)
    df = derive(
        df,
        {
            "trade_turnover": F.col("export") + F.col("import"),
            "export_share": numeric.log(numeric.ratio(F.col("export"), F.col("gdp"))),
            "turnover_share": numeric.log(numeric.ratio(F.col("trade_turnover"), F.col("gdp"))),
        },
    )
    return drop_missing(df, ["export"])


def with_indicators(
    panel: DataFrame, codes: DataFrame, long: DataFrame, names: Mapping[str, str], threshold: float = 0.9
) -> DataFrame:
    """Country codes by similar name, then one column per indicator.

    ``codes`` has (name, iso2Code), ``long`` has (iso2Code, year, indicator,
    value). Names are matched once per country, so years do not multiply rows.
    """
    countries = joins.fuzzy_join(panel.select("country").distinct(), codes, "country", "name", threshold)
    coded = joins.map_join(panel, countries.select("country", "iso2Code"), "country")
    return joins.left_join(coded, indicators_wide(long, ["iso2Code", "year"], "indicator", "value", names), ["iso2Code", "year"])


def fill_panel(df: DataFrame, interpolated: Sequence[str], neighbour: Sequence[str]) -> DataFrame:
    """Per country along the years: linear inside gaps, then from neighbours; incomplete rows go."""
    df = missing.interpolate_linear(df, ["country"], "year", "year", interpolated)
    return missing.fill_neighbours(df, ["country"], "year", "year", neighbour)


def regress(df: DataFrame, y: str, xs: Sequence[str], logs: Sequence[str] = ()) -> OlsFit:
    """Least squares with year dummies; the listed features enter as log(1 + x)."""
    df = derive(df, {f"log_{c}": numeric.log1p(F.col(c)) for c in logs})
    feats = [f"log_{c}" if c in logs else c for c in xs]
    return ols(df, y, feats, "year")
