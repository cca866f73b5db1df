"""Aggregates, shares, pivots, funnels and word counts."""

from pyspark.sql import functions as F

from tabloom.operators import aggregate as agg
from tabloom.operators.joins import left_join
from tabloom.operators.words import frequency_index, word_count
from tabloom.queries.registry import LABELLED, Tables, labelled, query, rounded
from tabloom.queries.sources_q import WORDS

TYPES = ["click", "error", "purchase", "signup", "view"]
# fixed values: a small English stop list
STOP_WORDS = [
    "a", "an", "and", "are", "as", "at", "be", "by", "for", "from", "he", "in", "is", "it", "its", "of", "on",
    "or", "she", "that", "the", "they", "this", "to", "was", "were", "which", "with", "you",
]


@query("a1_group_count", "select event_type, count(user_id) as n from events group by event_type")
def a1(t: Tables):
    return agg.group_count(t.events, "event_type", "user_id")


@query("a2_group_rate", f"select lang, round(avg(toxic), 9) as rate, count(toxic) as n from {LABELLED} group by lang")
def a2(t: Tables):
    return rounded(agg.group_rate(labelled(t), "lang", "toxic"), 9)


@query("a3_group_median", "select l_suppkey, round(median(l_extendedprice), 6) as median from lineitem group by l_suppkey")
def a3(t: Tables):
    return rounded(agg.group_median(t.lineitem, "l_suppkey", "l_extendedprice"))


@query("a4_group_sum", "select o_custkey, round(sum(o_totalprice), 2) as total from orders group by o_custkey")
def a4(t: Tables):
    return rounded(agg.group_sum(t.orders, "o_custkey", "o_totalprice"), 2)


@query("a5_group_mean", "select c_nationkey, round(avg(c_acctbal), 6) as mean, count(c_acctbal) as n from customer group by c_nationkey")
def a5(t: Tables):
    return rounded(agg.group_mean(t.customer, "c_nationkey", "c_acctbal"))


@query("a6_share_equal", "select l_suppkey, round(avg((l_returnflag = 'R')::int) * 100, 6) as percent, count(*) as n from lineitem group by l_suppkey")
def a6(t: Tables):
    return rounded(agg.share_equal(t.lineitem, "l_suppkey", "l_returnflag", "R"))


@query("a7_value_counts", "select p_name, count(*) as n from part group by p_name")
def a7(t: Tables):
    return agg.value_counts(t.part, "p_name")


@query("a7_value_counts_top", "select p_brand, count(*) as n from part group by p_brand order by n desc, p_brand limit 10")
def a7_top(t: Tables):
    return agg.value_counts(t.part, "p_brand", 10)


@query(
    "a8_dense_counts",
    """
    with g as (select range as p_size from range(0, 61, 2))
    select g.p_size, count(p.p_partkey) as n from g left join part p on p.p_size = g.p_size group by g.p_size
    """,
)
def a8(t: Tables):
    return agg.dense_counts(t.part, "p_size", 0, 60, 2)


@query(
    "a9_category_share",
    "select c_mktsegment, count(*) as n, round(count(*) * 100.0 / (select count(*) from customer), 6) as percent from customer group by c_mktsegment",
)
def a9(t: Tables):
    return rounded(agg.category_share(t.customer, "c_mktsegment"))


@query(
    "a10_normalized_share",
    """
    select o_orderpriority, round(sum(o_totalprice) / (select sum(o_totalprice) from orders), 9) as everyone,
      round(sum(o_totalprice) filter (o_orderstatus <> 'F') / (select sum(o_totalprice) from orders where o_orderstatus <> 'F'), 9) as kept,
      round(sum(o_totalprice) filter (o_orderstatus = 'F') / (select sum(o_totalprice) from orders where o_orderstatus = 'F'), 9) as refunded
    from orders group by o_orderpriority
    """,
)
def a10(t: Tables):
    groups = {"everyone": None, "kept": F.col("o_orderstatus") != "F", "refunded": F.col("o_orderstatus") == "F"}
    return rounded(agg.normalized_share(t.orders, "o_orderpriority", "o_totalprice", groups), 9)


@query(
    "a11_cross_count",
    """
    select o_custkey, nullif(count_if(o_orderstatus = 'F'), 0)::bigint as F, nullif(count_if(o_orderstatus = 'O'), 0)::bigint as O,
      nullif(count_if(o_orderstatus = 'P'), 0)::bigint as P from orders group by o_custkey
    """,
)
def a11(t: Tables):
    return agg.cross_count(t.orders, "o_custkey", "o_orderstatus", ["F", "O", "P"])


@query(
    "a11_cross_sum",
    """
    select o_custkey, round(sum(o_totalprice) filter (o_orderstatus = 'F'), 2) as F, round(sum(o_totalprice) filter (o_orderstatus = 'O'), 2) as O,
      round(sum(o_totalprice) filter (o_orderstatus = 'P'), 2) as P from orders group by o_custkey
    """,
)
def a11_sum(t: Tables):
    return rounded(agg.cross_sum(t.orders, "o_custkey", "o_orderstatus", "o_totalprice", ["F", "O", "P"]), 2)


@query(
    "a12_pivot_mean",
    "select user_id, "
    + ", ".join(f"round(avg(value) filter (event_type = '{k}'), 6) as {k}" for k in TYPES)
    + " from events group by user_id",
)
def a12(t: Tables):
    return rounded(agg.pivot_mean(t.events, "user_id", "event_type", "value", TYPES))


@query("a13_pivot_multi", "select l_suppkey, count(l_quantity) as count, round(avg(l_quantity), 6) as mean from lineitem group by l_suppkey")
def a13(t: Tables):
    return rounded(agg.pivot_multi(t.lineitem, "l_suppkey", "l_quantity"))


@query(
    "a14_fixed_cross_count",
    """
    select city, count(user_id) filter (dayname(ts) = 'Monday') as Monday, count(user_id) filter (dayname(ts) = 'Wednesday') as Wednesday,
      count(user_id) filter (dayname(ts) = 'Friday') as Friday
    from (select *, case when user_id % 2 = 0 then 'Moscow' else 'Saint-Petersburg' end as city from events) group by city
    """,
)
def a14(t: Tables):
    from tabloom.studies.listening import number_tracks, with_city

    return number_tracks(with_city(t.events))


DATES = ["2024-01-01", "2024-01-02", "2024-01-03", "2024-01-04"]


@query(
    "a15_quotes_wide",
    "select user_id, coalesce(min(value) filter (strftime(ts, '%Y-%m-%d') = '2024-01-01'), 0) as \"2024-01-01\", "
    + ", ".join(f"min(value) filter (strftime(ts, '%Y-%m-%d') = '{d}') as \"{d}\"" for d in DATES[1:])
    + " from events where strftime(ts, '%Y-%m-%d') in ('" + "', '".join(DATES) + "') group by user_id",
)
def a15(t: Tables):
    daily = t.events.withColumn("date", F.date_format("ts", "yyyy-MM-dd"))
    return agg.quotes_wide(daily, "user_id", "date", "value", DATES)


@query(
    "a16_indicators_wide",
    """
    with l as (select user_id, strftime(ts, '%Y-%m-%d') as day, event_type, max(value) as value from events group by all)
    select user_id, day, max(value) filter (event_type = 'click') as clicks, max(value) filter (event_type = 'purchase') as buys,
      max(value) filter (event_type = 'error') as faults
    from l where value <> 0 and event_type in ('click', 'purchase', 'error') group by user_id, day
    """,
)
def a16(t: Tables):
    day = F.date_format("ts", "yyyy-MM-dd").alias("day")
    long = t.events.groupBy("user_id", day, "event_type").agg(F.max("value").alias("value"))
    names = {"click": "clicks", "purchase": "buys", "error": "faults"}
    return agg.indicators_wide(long, ["user_id", "day"], "event_type", "value", names)


@query(
    "a17_count_where",
    "select count_if(o_orderstatus = 'F')::bigint as final, count_if(o_orderstatus = 'P')::bigint as pending from orders",
)
def a17(t: Tables):
    return agg.count_where(t.orders, {"final": F.col("o_orderstatus") == "F", "pending": F.col("o_orderstatus") == "P"})


@query("a18_representative", "select p_brand, p_type, max(p_partkey) as p_partkey from part group by p_brand, p_type")
def a18(t: Tables):
    return agg.representative(t.part, ["p_brand", "p_type"], "p_partkey")


@query(
    "a19_funnel",
    """
    with j as (select o_orderkey, o_orderstatus, o_totalprice, s.lines from orders
      left join (select l_orderkey, count(*) as lines from lineitem group by 1) s on l_orderkey = o_orderkey),
    c as (select count(*)::bigint as a, count_if(lines is not null)::bigint as b, count_if(lines is not null and o_totalprice >= 100000)::bigint as c,
      count_if(lines is not null and o_totalprice >= 100000 and o_orderstatus = 'F')::bigint as d from j)
    select 1 as step, 'placed' as stage, a as n, 100.0::double as percent from c union all
    select 2, 'with lines', b, round(b * 100.0 / a, 6) from c union all
    select 3, 'large', c, round(c * 100.0 / a, 6) from c union all
    select 4, 'final', d, round(d * 100.0 / a, 6) from c
    """,
)
def a19(t: Tables):
    lines = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count(F.lit(1)).alias("lines"))
    has = F.col("lines").isNotNull()
    large = has & (F.col("o_totalprice") >= 100000)
    stages = {"placed": F.lit(True), "with lines": has, "large": large, "final": large & (F.col("o_orderstatus") == "F")}
    return rounded(agg.funnel(left_join(t.orders, lines, ["o_orderkey"]), stages))


@query("a20_word_count", WORDS)
def a20(t: Tables):
    return word_count(t.dealt("documents"), "text")


@query("a21_word_count_without_stop_words", f"select * from ({WORDS}) where word not in ('" + "', '".join(STOP_WORDS) + "')")
def a21(t: Tables):
    return word_count(t.dealt("documents"), "text", STOP_WORDS)


@query(
    "a22_frequency_index",
    f"""
    with w as ({WORDS}), p as (select word, num, count(*) over (partition by num) as word_count,
      (row_number() over (partition by num order by word) - 1) // 5000 as part from w)
    select num, part, string_agg(word, ',' order by word) as words, any_value(word_count) as word_count from p group by num, part
    """,
)
def a22(t: Tables):
    index = frequency_index(word_count(t.dealt("documents"), "text"), list_size=5000)
    return index.withColumn("words", F.concat_ws(",", "words"))


@query("a23_keyed_mean", "select user_id, round(avg(value), 6) as mean from events group by user_id")
def a23(t: Tables):
    return rounded(agg.keyed_mean(t.events, "user_id", "value"))


@query("a23_keyed_mean_from_parts", "select event_type, round(avg(value), 6) as mean from events group by event_type")
def a23_parts(t: Tables):
    per_day = t.events.withColumn("day", F.to_date("ts"))
    parts = agg.keyed_mean_parts(per_day.withColumn("k", F.struct("event_type", "day")), "k", "value")
    return rounded(agg.merge_keyed_means(parts.withColumn("event_type", F.col("k.event_type")), "event_type", ))


@query(
    "a24_distinct_by_key",
    """
    select user_id, event_id, event_type from (
      select *, row_number() over (partition by user_id order by ts, event_id) as rn from events) where rn = 1
    """,
)
def a24(t: Tables):
    first = agg.distinct_by_key(t.events.select("user_id", "ts", "event_id", "event_type"), "user_id", ["ts", "event_id"])
    return first.select("user_id", "event_id", "event_type")
