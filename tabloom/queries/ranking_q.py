"""Windows, sorting, top lists."""

from pyspark.sql import functions as F

from tabloom.operators import ranking
from tabloom.queries.registry import GAPPY, Tables, gappy_events, query, rounded
from tabloom.studies.listening import genre_weekday, with_city

RUN = "sum(o_totalprice) over (order by o_totalprice desc, o_orderkey rows unbounded preceding) / sum(o_totalprice) over ()"


@query("w1_cumulative_share", f"select o_orderkey, o_totalprice, round({RUN}, 9) as share from orders")
def w1(t: Tables):
    return rounded(ranking.cumulative_share(t.orders.select("o_orderkey", "o_totalprice"), "o_totalprice", "o_orderkey"), 9)


@query("w2_pareto_segment", f"select o_orderkey, o_totalprice, round(share, 9) as share from (select *, {RUN} as share from orders) where share <= 0.8")
def w2(t: Tables):
    return rounded(ranking.pareto_segment(t.orders.select("o_orderkey", "o_totalprice"), "o_totalprice", "o_orderkey"), 9)


@query(
    "w2_pareto_report",
    f"""
    with s as (select *, {RUN} as share from orders)
    select count_if(share <= 0.8)::bigint as rows, round(avg((share <= 0.8)::int), 9) as row_share,
      round(sum(o_totalprice) filter (share <= 0.8) / sum(o_totalprice), 9) as value_share from s
    """,
)
def w2_report(t: Tables):
    return rounded(ranking.pareto_report(t.orders, "o_totalprice", "o_orderkey"), 9)


@query(
    "w3_lag_diff",
    """
    with g as (select round_even(l_extendedprice / 1000, 0)::bigint as km, median(l_extendedprice / l_quantity) as price from lineitem group by 1)
    select km, round(price, 6) as price, coalesce(trunc(price - lag(price) over (order by km)), 0)::bigint as diff from g
    """,
)
def w3(t: Tables):
    from tabloom.operators.aggregate import group_median

    rows = t.lineitem.select(
        F.bround(F.col("l_extendedprice") / 1000).cast("long").alias("km"), (F.col("l_extendedprice") / F.col("l_quantity")).alias("price")
    )
    return rounded(ranking.lag_diff(group_median(rows, "km", "price").withColumnRenamed("median", "price"), "km", "price"))


@query(
    "w4_group_transform",
    "select l_orderkey, l_partkey, l_suppkey, l_linenumber, round(avg(l_quantity) over (partition by l_suppkey), 6) as mean from lineitem",
)
def w4(t: Tables):
    out = ranking.group_transform(t.lineitem, "l_suppkey", F.avg("l_quantity"), "mean")
    return rounded(out.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "mean"))


@query(
    "w5_neighbours",
    f"""
    select event_id, last_value(value ignore nulls) over (partition by user_id order by ts, event_id rows between unbounded preceding and 1 preceding) as prev,
      lead(value) over (partition by user_id order by ts, event_id) as next from {GAPPY}
    """,
)
def w5(t: Tables):
    return ranking.neighbours(gappy_events(t), ["user_id"], "ts", "event_id", "value").select("event_id", "prev", "next")


#: Days as text, with gaps in the day and in the key; every day is shared by many rows, so the tie decides.
TEXT_DAYS = (
    "(select event_id, value, case when event_id % 11 > 0 then strftime(ts, '%Y-%m-%d') end as day,"
    f" case when user_id % 7 > 0 then user_id % 3 end as k from {GAPPY})"
)


def text_days(t: Tables):
    day = F.when(F.col("event_id") % 11 > 0, F.date_format("ts", "yyyy-MM-dd"))
    key = F.when(F.col("user_id") % 7 > 0, F.col("user_id") % 3)
    return gappy_events(t).select("event_id", "value", day.alias("day"), key.alias("k"))


def _text_neighbours(part: str) -> str:
    over = f"over ({part}order by day nulls first, event_id"
    return f"""
    select event_id, last_value(value ignore nulls) {over} rows between unbounded preceding and 1 preceding) as prev,
      lead(value) {over}) as next from {TEXT_DAYS}
    """


@query("w5_neighbours_text_order", _text_neighbours("partition by k "))
def w5_text(t: Tables):
    return ranking.neighbours(text_days(t), ["k"], "day", "event_id", "value").select("event_id", "prev", "next")


@query("w5_neighbours_text_order_hot", _text_neighbours("partition by k "))
def w5_text_hot(t: Tables):
    return ranking.neighbours(text_days(t), ["k"], "day", "event_id", "value", hot_rows=100).select("event_id", "prev", "next")


@query("w5_neighbours_text_order_whole", _text_neighbours(""))
def w5_text_whole(t: Tables):
    return ranking.neighbours(text_days(t), [], "day", "event_id", "value").select("event_id", "prev", "next")


@query(
    "w1_cumulative_share_null_keys",
    """
    with r as (select l_quantity, case when l_orderkey % 10 > 0 then l_orderkey::varchar || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey end as k from lineitem)
    select l_quantity, round(sum(l_quantity) over (order by l_quantity desc, k nulls first rows unbounded preceding) / sum(l_quantity) over (), 9) as share from r
    """,
)
def w1_nulls(t: Tables):
    key = F.when(F.col("l_orderkey") % 10 > 0, F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"))
    return rounded(ranking.cumulative_share(t.lineitem.select("l_quantity", key.alias("k")), "l_quantity", "k").drop("k"), 9)


@query(
    "w6_rating",
    """
    with s as (select c_custkey, floor(c_acctbal / 100)::bigint as score from customer)
    select c_custkey, score, rank() over (order by score desc) as place_first,
      rank() over (order by score desc) + count(*) over (partition by score) - 1 as place_last from s
    """,
)
def w6(t: Tables):
    scores = t.customer.select("c_custkey", F.floor(F.col("c_acctbal") / 100).alias("score"))
    return ranking.rating(scores, "score")


@query(
    "w7_durbin_watson",
    """
    with e as (select user_id, ts, event_id, value - avg(value) over () as r from events),
    l as (select r, r - lag(r) over (partition by user_id order by ts, event_id) as d from e)
    select round(sum(d * d) / sum(r * r), 9) as durbin_watson from l
    """,
)
def w7(t: Tables):
    from tabloom.plans import attach

    mean = t.events.agg(F.avg("value").alias("m"))
    rows = attach(t.events, mean).withColumn("r", F.col("value") - F.col("m"))
    return rounded(ranking.durbin_watson(rows, ["user_id"], "ts", "event_id", "r"), 9)


@query(
    "w7_durbin_watson_all_rows",
    """
    with l as (select value as r, value - lag(value) over (order by ts, event_id) as d from events)
    select round(sum(d * d) / sum(r * r), 9) as durbin_watson from l
    """,
)
def w7_all(t: Tables):
    return rounded(ranking.durbin_watson(t.events, [], "ts", "event_id", "value"), 9)


@query("t1_sort_stable", "select o_orderkey, o_orderpriority, o_totalprice from orders")
def t1(t: Tables):
    rows = t.orders.select("o_orderkey", "o_orderpriority", "o_totalprice")
    return ranking.sort_stable(rows, [("o_orderpriority", True), ("o_totalprice", False)], ["o_orderkey"])


@query("t2_top_k", "select event_id, value from events order by value desc, event_id limit 25")
def t2(t: Tables):
    return ranking.top_k(t.events.select("event_id", "value"), [("value", False)], 25, ["event_id"])


@query("t2_bottom_k", "select event_id, value from events order by value, event_id desc limit 25")
def t2_tail(t: Tables):
    return ranking.bottom_k(t.events.select("event_id", "value"), [("value", False)], 25, ["event_id"])


GENRES = """
    select event_type, count(*) as n from events where dayname(ts) = '{day}' and strftime(ts, '%H:%M:%S') > '{a}'
      and strftime(ts, '%H:%M:%S') < '{b}' {more} group by event_type order by n desc, event_type limit 10
"""


@query("t3_top_k_filtered", GENRES.format(day="Monday", a="07:00", b="11:00", more=""))
def t3(t: Tables):
    return genre_weekday(t.events, "Monday", "07:00", "11:00")


@query("t3_genre_weekday_friday_evening_city", GENRES.format(day="Friday", a="17:00", b="23:00", more="and user_id % 2 = 0"))
def t3_city(t: Tables):
    return genre_weekday(with_city(t.events).filter("city = 'Moscow'"), "Friday", "17:00", "23:00")


@query(
    "t4_filtered_top",
    "select c_custkey, c_name, c_acctbal from customer where c_mktsegment = 'MACHINERY' and c_acctbal > 0 order by c_acctbal desc, c_custkey limit 100",
)
def t4(t: Tables):
    pred = (F.col("c_mktsegment") == "MACHINERY") & (F.col("c_acctbal") > 0)
    top = ranking.filtered_top(t.customer, pred, [("c_acctbal", False)], 100, ["c_custkey"])
    return top.select("c_custkey", "c_name", "c_acctbal")
