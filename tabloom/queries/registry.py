"""Query registry and table access."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabloom.plans.sizing import spread


class Tables:
    """The driver's tables, read when asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def dealt(self, name: str) -> DataFrame:
        """A table whose rows go through costly expressions: split over all cores even if its file is not."""
        return spread(getattr(self, name))


@dataclass(frozen=True)
class Query:
    run: Callable[[Tables], DataFrame]
    sql: str | None


REGISTRY: dict[str, Query] = {}


def query(name: str, sql: str | None = None):
    """Register a function of the tables under a name, with the SQL that must give the same rows."""

    def add(fn: Callable[[Tables], DataFrame]):
        if name in REGISTRY:
            raise ValueError(f"{name} is registered twice")
        REGISTRY[name] = Query(fn, sql)
        return fn

    return add


def rounded(df: DataFrame, digits: int = 6, cols: list[str] | None = None) -> DataFrame:
    """Doubles rounded for comparison between engines."""
    names = cols or [c for c, k in df.dtypes if k == "double"]
    return df.withColumns({c: F.round(F.col(c), digits) for c in names})


def labelled(t: Tables) -> DataFrame:
    """Documents with their labels; unlabelled ones have nulls."""
    return t.documents.select("doc_id", "lang", "source", "n_chars").join(t.labels, "doc_id", "left")


def gappy_events(t: Tables) -> DataFrame:
    """Events whose value is missing for two of the event types."""
    return t.events.withColumn("value", F.when(~F.col("event_type").isin("view", "error"), F.col("value")))


# the same two tables as SQL text
LABELLED = "(select d.doc_id, d.lang, d.source, d.n_chars, l.quality, l.toxic from documents d left join labels l using (doc_id))"
GAPPY = (
    "(select event_id, ts, user_id, event_type, props,"
    " case when event_type not in ('view', 'error') then value end as value from events)"
)


def epoch_day(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd")
