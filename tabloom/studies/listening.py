"""Listening habits by city, weekday and time of day."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.functions import times
from tabloom.operators.aggregate import fixed_cross_count
from tabloom.operators.ranking import top_k_filtered

# fixed values: the two cities and the three days compared
CITIES = ["Moscow", "Saint-Petersburg"]
DAYS = ["Monday", "Wednesday", "Friday"]


def with_city(events: DataFrame) -> DataFrame:
    """The event table as listens: even users live in one city, odd ones in the other."""
    return events.withColumn("city", F.when(F.col("user_id") % 2 == 0, CITIES[0]).otherwise(CITIES[1])).withColumn(
        "day", times.weekday_name(F.col("ts"))
    )


def number_tracks(listens: DataFrame, cities: Sequence[str] = CITIES, days: Sequence[str] = DAYS) -> DataFrame:
    """Listens per city and weekday: every cell of the table in one scan."""
    return fixed_cross_count(listens, "city", cities, "day", days, "user_id")


def genre_weekday(listens: DataFrame, day: str, t1: str, t2: str, k: int = 10, genre: str = "event_type") -> DataFrame:
    """Top genres on one weekday between two times of day."""
    return top_k_filtered(listens, "ts", genre, day, t1, t2, k)
