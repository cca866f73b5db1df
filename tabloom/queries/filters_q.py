"""Filters."""

from pyspark.sql import functions as F

from tabloom.operators import filters
from tabloom.queries.registry import LABELLED, Tables, labelled, query

ORDER_COLS = ["o_orderkey", "o_orderstatus", "o_totalprice"]


@query(
    "f1_where",
    "select l_orderkey, l_linenumber, l_quantity, l_discount from lineitem where l_quantity <= 10 and (l_discount > 0.05 or l_returnflag = 'R')",
)
def f1(t: Tables):
    kept = filters.where(t.lineitem, "l_quantity <= 10 and (l_discount > 0.05 or l_returnflag = 'R')")
    return kept.select("l_orderkey", "l_linenumber", "l_quantity", "l_discount")


@query("f2_is_in", "select doc_id, lang from documents where lang in ('en', 'fr')")
def f2_in(t: Tables):
    return filters.keep_in(t.documents.select("doc_id", "lang"), "lang", ["en", "fr"])


@query(
    "f2_not_in_keeps_null",
    f"select doc_id, quality from {LABELLED} where quality is null or quality not in (0)",
)
def f2_not(t: Tables):
    return filters.keep_not_in(labelled(t).select("doc_id", "quality"), "quality", [0])


@query("f2_is_in_long_list", "select o_orderkey, o_custkey from orders where o_custkey between 100 and 599")
def f2_long(t: Tables):
    return filters.keep_in(t.orders.select("o_orderkey", "o_custkey"), "o_custkey", list(range(100, 600)))


@query("f3_contains", "select p_partkey, p_name from part where contains(p_name, 'ring')")
def f3(t: Tables):
    return filters.contains(t.part.select("p_partkey", "p_name"), "p_name", "ring")


@query(
    "f4_exclude_where",
    f"select doc_id, lang, quality from {LABELLED} where not coalesce(lang = 'en' and quality = 1, false)",
)
def f4(t: Tables):
    return filters.exclude_where(
        labelled(t).select("doc_id", "lang", "quality"), (F.col("lang") == "en") & (F.col("quality") == 1)
    )


@query("f5_drop_missing", f"select doc_id, quality, toxic from {LABELLED} where quality is not null and toxic is not null")
def f5(t: Tables):
    return filters.drop_missing(labelled(t).select("doc_id", "quality", "toxic"), ["quality", "toxic"])


@query(
    "f6_drop_at_max",
    "select l_orderkey, l_linenumber, l_quantity from lineitem where l_quantity < (select max(l_quantity) from lineitem)",
)
def f6(t: Tables):
    return filters.drop_at_max(t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity"), "l_quantity")


@query("f7_rows_at_max", "select p_partkey, p_size from part where p_size = (select max(p_size) from part)")
def f7_max(t: Tables):
    return filters.rows_at_extreme(t.part.select("p_partkey", "p_size"), "p_size", "max")


@query("f7_rows_at_min", "select p_partkey, p_size from part where p_size = (select min(p_size) from part)")
def f7_min(t: Tables):
    return filters.rows_at_extreme(t.part.select("p_partkey", "p_size"), "p_size", "min")


@query(
    "f8_time_between",
    "select event_id, user_id from events where strftime(ts, '%H:%M:%S') > '07:00' and strftime(ts, '%H:%M:%S') < '11:00'",
)
def f8(t: Tables):
    return filters.time_between(t.events, "ts", "07:00", "11:00").select("event_id", "user_id")


@query("f9_since_months", "select o_orderkey from orders where o_orderdate >= date '2001-07-31' - interval 5 month")
def f9(t: Tables):
    return filters.since_months(t.orders, "o_orderdate", 5, "2001-07-31").select("o_orderkey")


@query(
    "f10_in_period_with_keywords",
    """
    select event_id, event_type from events where ts >= timestamp '2024-01-08 00:00:00' and ts <= timestamp '2024-01-15 12:00:00'
      and (contains(lower(event_type), 'click') or contains(lower(event_type), 'err'))
    """,
)
def f10(t: Tables):
    kept = filters.in_period_with_keywords(
        t.events, "ts", "2024-01-08 00:00:00", "2024-01-15 12:00:00", "event_type", ["Click", "ERR"]
    )
    return kept.select("event_id", "event_type")
