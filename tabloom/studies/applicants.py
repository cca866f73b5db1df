"""Applicants: results of two exams, rating, funnel and turnover of the leading places."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.operators import joins, ranking, sets
from tabloom.operators.aggregate import funnel
from tabloom.operators.shape import flag_token

# fixed values: the no-show word, the mark of no consent, thresholds and places
ABSENT, NO_CONSENT = "неявка", "—"
ECON_THRESHOLD, STAT_THRESHOLD, PLACES = 36, 22, 44


def results(econ: DataFrame, stat: DataFrame, extra: DataFrame, final: DataFrame) -> DataFrame:
    """One row per applicant of the first exam; points as numbers, absences as flags."""
    df = econ
    for other in (stat, extra, final):
        df = joins.left_join(df, other, ["id"])
    df = flag_token(df, "econ_points", ABSENT, "econ_missing")
    df = flag_token(df, "stat_points", ABSENT, "stat_missing")
    df = df.withColumn("additional_points", F.coalesce(F.col("additional_points").cast("int"), F.lit(0)))
    return df.withColumn("sum_points", F.col("econ_points") + F.col("stat_points") + F.col("additional_points"))


def rating(df: DataFrame) -> DataFrame:
    """Places that each applicant can take by the sum of points."""
    return ranking.rating(df.select("id", "sum_points"), "sum_points")


def admission_funnel(df: DataFrame) -> DataFrame:
    """Applicants left after each stage."""
    econ = (F.col("econ_missing") == 0) & (F.col("econ_points") >= ECON_THRESHOLD)
    stat = econ & (F.col("stat_missing") == 0) & (F.col("stat_points") >= STAT_THRESHOLD)
    agreed = F.col("acceptance").isNotNull() & (F.col("acceptance") != NO_CONSENT)
    return funnel(
        df,
        {
            "applied": F.lit(True),
            "wrote the first exam": F.col("econ_missing") == 0,
            "passed the first exam": econ,
            "passed the second exam": stat,
            "in the final list": F.col("total_points").isNotNull(),
            "agreed": agreed,
        },
    )


def turnover(df: DataFrame, k: int = PLACES, stages: Sequence[tuple[str, str, bool]] | None = None) -> DataFrame:
    """Who stays among the first k, and who drops out, from stage to stage; ties go to the smaller id."""
    df = df.withColumn("econ_stat_sum", F.col("econ_points") + F.col("stat_points"))
    stages = stages or [
        ("first exam", "econ_points", False), ("both exams", "econ_stat_sum", False),
        ("all points", "total_points", False), ("final list", "final_rating", True),
    ]
    tops = {n: ranking.top_k(df, [(c, up)], k, ["id"]).select("id") for n, c, up in stages}
    return sets.transition_edges(tops, "id")
