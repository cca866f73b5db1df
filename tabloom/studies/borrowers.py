"""Credit default rates by children, family, income band and loan purpose."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.functions import numeric, predicates
from tabloom.operators.aggregate import group_rate
from tabloom.operators.missing import fill_group_median
from tabloom.operators.repair import bucketize, categorize_contains
from tabloom.operators.sets import distinct_rows

# fixed values: income bands and loan purposes
BANDS = [(0, 30000), (30001, 50000), (50001, 200000), (200001, 1000000), (1000001, None)]
BAND_LABELS = ["E", "D", "C", "B", "A"]
PURPOSES = [
    ("автом", "операции с автомобилем"),
    (["жил", "недвиж"], "операции с недвижимостью"),
    ("свад", "проведение свадьбы"),
    ("образов", "получение образования"),
]
NO_PURPOSE = "нет категории"
WRONG_CHILDREN = [-1, 20]


def clean_clients(df: DataFrame) -> DataFrame:
    """Fill income and employment by income type, drop impossible rows and repeats, add categories."""
    df = fill_group_median(df, "total_income", "income_type")
    df = df.withColumn("days_employed", numeric.absolute(F.col("days_employed")))
    df = df.filter(predicates.not_in(F.col("children"), WRONG_CHILDREN))
    df = fill_group_median(df, "days_employed", "income_type")
    df = df.withColumns({"total_income": F.col("total_income").cast("long"), "education": F.lower("education")})
    return with_categories(distinct_rows(df))


def with_categories(df: DataFrame) -> DataFrame:
    df = bucketize(df, "total_income", BANDS, BAND_LABELS, "total_income_category")
    return categorize_contains(df, "purpose", PURPOSES, "purpose_category", NO_PURPOSE)


def default_rates(clients: DataFrame, by: str) -> DataFrame:
    """Share of debtors and number of clients per group."""
    return group_rate(clients, by, "debt")
