"""Course survey against refunds: satisfaction score and importance of goals."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.operators import joins, repair
from tabloom.operators.aggregate import cross_sum, normalized_share
from tabloom.operators.stats import balance_score

# fixed values: statement codes by sense, points of the answers, short refund reasons
POSITIVE = [
    "D0", "B3", "D3", "D8", "F6", "B11", "Y1", "Y0", "Y2", "B5", "A5", "F7", "F11", "B7", "A0", "B8", "F8", "B6",
    "A3", "F4", "A1", "X0", "F0", "A4", "B0", "D1", "B1", "Z0", "F1",
]
NEGATIVE = ["C3", "E3", "C11", "E7", "E1", "E5", "C5", "C0", "C6", "C4", "C1", "E10", "E0"]
POINTS = {"да": 2, "скорее да": 1, "не знаю": 0, "скорее нет": -1, "нет": -2}
COHORT_EDITS = [
    ("designer-plus", "designer_plus"), ("_praktikum", ""), ("_8", "_08"), ("_9", "_09"), ("_dop", ""), ("C", ""),
    ("_months", ""),
]
NO_REASON = ["Другое", "Не указано"]


def unify_cohorts(df: DataFrame, cols=("cohort", "current_cohort")) -> DataFrame:
    for c in cols:
        df = repair.replace_literals(df, c, COHORT_EDITS)
    return df


def satisfaction(answers: DataFrame, goals: DataFrame, refunds: DataFrame, how: str = "sum") -> DataFrame:
    """Score per student and course, with flags for those who set goals or took a refund."""
    df = repair.categorize_members(answers, "question_number", {"positive": POSITIVE, "negative": NEGATIVE}, "side")
    df = repair.score_map(df, "grade_content", POINTS, "points")
    score = balance_score(
        df, ["user_id", "profession_name"], F.col("side") == "positive", F.col("side") == "negative", "points", how
    )
    score = joins.flag_members(score, goals, "user_id", "is_in_goals")
    return joins.flag_members(score, refunds, "user_id", "is_in_returns")


def goal_importance(goals: DataFrame, refunds: DataFrame) -> DataFrame:
    """Share of all points that each goal gets: everyone, without refund, with refund."""
    joined = joins.left_join(goals, refunds.select("user_id", "refund_reason"), ["user_id"])
    no = F.col("refund_reason").isNull()
    return normalized_share(joined, "statement_content", "value", {"everyone": None, "kept": no, "refunded": ~no})


def goals_by_reason(goals: DataFrame, refunds: DataFrame, short: dict[str, str], reasons: list[str]) -> DataFrame:
    """Points per goal and (shortened) refund reason, side by side; unstated reasons are left out."""
    joined = joins.left_join(goals, refunds.select("user_id", "refund_reason"), ["user_id"])
    named = repair.shorten_labels(joined, "refund_reason", short, NO_REASON, "reason")
    return cross_sum(named, "statement_content", "reason", "value", reasons)
