"""Flat listings: cleanup, price by locality, price by distance."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.functions import numeric, times
from tabloom.operators import missing, repair
from tabloom.operators.aggregate import group_median, pivot_multi
from tabloom.operators.filters import drop_missing, rows_at_extreme, where
from tabloom.operators.ranking import lag_diff, top_k
from tabloom.operators.shape import rename
from tabloom.plans.written import written

# fixed values: limits, city and the words that go from a locality's name
CITY = "санкт-петербург"
AREA_LIMIT, ROOM_LIMIT, FLOOR_LIMIT = 190, 5, 35
LOCALITY_WORDS = [
    "поселок ", "городского типа ", "городской ", "деревня ", "коттеджный ", "село ", "посёлок ",
    "при железнодорожной станции ", "станции ", "садоводческое некоммерческое товарищество ", "садовое товарищество ",
]
NAMES = {
    "parks_around3000": "parks_around_3000",
    "ponds_around3000": "ponds_around_3000",
    "cityCenters_nearest": "city_centers_nearest",
}


def clean_listings(df: DataFrame) -> DataFrame:
    """Trim outliers, fill gaps, unify locality names.

    Where notes and code of the study differ, the notes are followed: only
    missing living areas are imputed, and distances to the centre are filled by
    locality outside the city.
    """
    df = rename(df, NAMES)
    df = missing.trim_above(missing.trim_above(df, "total_area", AREA_LIMIT), "rooms", ROOM_LIMIT)
    df = repair.conditional_set(df, (F.col("rooms") == 0) & F.col("studio"), "rooms", 1)
    df = missing.fill_median(missing.cap_outliers(df, "ceiling_height", 0.995), "ceiling_height")
    df = drop_missing(missing.trim_above(df, "floors_total", FLOOR_LIMIT), ["locality_name"])
    df = missing.impute_scaled(df, "living_area", "rooms")
    open_kitchen = F.col("kitchen_area").isNull() & (F.coalesce("studio", F.lit(False)) | F.coalesce("open_plan", F.lit(False)))
    df = repair.conditional_set(df, open_kitchen, "kitchen_area", 0.0)
    df = repair.strip_tokens(df, "locality_name", LOCALITY_WORDS, ("ё", "е"))
    # what follows passes over the rows several times; they are written once, so that no pass repeats the steps above
    df = written(df, "listings")
    df = missing.fill_group_median(df, ["airports_nearest", "city_centers_nearest"], "locality_name", F.col("locality_name") != CITY)
    df = missing.fill_median(missing.fill_group_median(df, "parks_nearest", "locality_name"), "parks_nearest")
    return missing.fill_constant(
        df,
        {"is_apartment": False, "kitchen_area": -1.0, "balcony": 0.0, "airports_nearest": -1.0,
         "city_centers_nearest": -1.0, "parks_nearest": -1.0, "parks_around_3000": -1.0, "ponds_nearest": -1.0,
         "ponds_around_3000": -1.0, "days_exposition": -1.0},
    )


def with_features(df: DataFrame) -> DataFrame:
    """Price per square metre, parts of the date, floor group, kilometres to the centre."""
    day = times.parse(F.col("first_day_exposition"), "yyyy-MM-dd'T'HH:mm:ss")
    df = df.withColumns(
        {
            "price_sq_meter": numeric.ratio(F.col("last_price"), F.col("total_area")),
            "weekday_exposition": times.weekday(day),
            "month_exposition": times.month(day),
            "year_exposition": times.year(day),
            "city_centers_nearest_km": F.col("city_centers_nearest") / 1000,
        }
    )
    return repair.position_group(df, "floor", "floors_total", "floor_group", ("первый", "последний", "другой"))


def price_by_locality(df: DataFrame, locality: str = "locality_name", price: str = "price_sq_meter", k: int = 10) -> DataFrame:
    """Listings and mean price of the k localities with most listings."""
    return top_k(pivot_multi(df, locality, price), [("count", False)], k, [locality])


def price_extremes(df: DataFrame, locality: str = "locality_name", price: str = "price_sq_meter") -> DataFrame:
    """The dearest and the cheapest locality, with all ties."""
    means = pivot_multi(df, locality, price)
    high = rows_at_extreme(means, "mean", "max").withColumn("edge", F.lit("highest"))
    return high.unionByName(rows_at_extreme(means, "mean", "min").withColumn("edge", F.lit("lowest")))


def price_per_km(
    df: DataFrame, km: str = "city_centers_nearest_km", price: str = "price_sq_meter", city: str | None = CITY
) -> DataFrame:
    """Median price per whole kilometre from the centre, and its change to the kilometre before."""
    inside = where(df, F.col(km) >= 0)
    if city is not None:
        inside = where(inside, F.col("locality_name") == city)
    rows = inside.withColumn("km", numeric.round_even(F.col(km)).cast("long"))
    return lag_diff(group_median(rows, "km", price), "km", "median")
