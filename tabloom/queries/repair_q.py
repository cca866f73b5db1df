"""Value repair and categories."""

from pyspark.sql import functions as F

from tabloom.operators import repair
from tabloom.operators.joins import left_join
from tabloom.plans import attach
from tabloom.queries.registry import Tables, query

PRIORITY = {"1-URGENT": 2, "2-HIGH": 1, "3-MEDIUM": 0, "4-NOT SPECIFIED": -1}


@query(
    "c1_replace_values",
    """
    select p_partkey, case p_type when 'ECONOMY' then 'basic' when 'SMALL' then 'basic' when 'LARGE' then 'big' else p_type end as p_type
    from part
    """,
)
def c1(t: Tables):
    return repair.replace_values(
        t.part.select("p_partkey", "p_type"), "p_type", {"ECONOMY": "basic", "SMALL": "basic", "LARGE": "big"}
    )


@query(
    "c2_strip_tokens",
    """
    select p_partkey, replace(replace(replace(translate(lower(p_name), 'e', 'i'), 'rid ', ''), 'small ', ''), 'blue ', '') as p_name
    from part
    """,
)
def c2(t: Tables):
    # 'blue ' can never match, since e has become i before
    return repair.strip_tokens(t.part.select("p_partkey", "p_name"), "p_name", ["rid ", "small ", "blue "], ("e", "i"))


@query(
    "c2_replace_literals",
    """
    select p_partkey, replace(replace(replace(p_brand, 'Brand#', 'b_'), '_1', '_01'), '_2', '_02') as p_brand from part
    """,
)
def c2_edits(t: Tables):
    return repair.replace_literals(
        t.part.select("p_partkey", "p_brand"), "p_brand", [("Brand#", "b_"), ("_1", "_01"), ("_2", "_02")]
    )


@query(
    "c3_bucketize",
    """
    with o as (select o_orderkey, trunc(o_totalprice)::int as price from orders)
    select o_orderkey, case when price between 0 and 30000 then 'E' when price between 30001 and 50000 then 'D'
      when price between 50001 and 200000 then 'C' when price between 200001 and 1000000 then 'B'
      when price >= 1000001 then 'A' end as band from o
    """,
)
def c3(t: Tables):
    whole = t.orders.select("o_orderkey", F.col("o_totalprice").cast("int").alias("price"))
    edges = [(0, 30000), (30001, 50000), (50001, 200000), (200001, 1000000), (1000001, None)]
    return repair.bucketize(whole, "price", edges, ["E", "D", "C", "B", "A"], "band").drop("price")


@query(
    "c4_categorize_contains",
    """
    select p_partkey, case when contains(p_name, 'red') then 'warm' when contains(p_name, 'blue') or contains(p_name, 'green') then 'cold'
      when contains(p_name, 'ring') then 'ring' end as kind from part
    """,
)
def c4(t: Tables):
    rules = [("red", "warm"), (["blue", "green"], "cold"), ("ring", "ring")]
    return repair.categorize_contains(t.part.select("p_partkey", "p_name"), "p_name", rules, "kind", "none").drop("p_name")


@query(
    "c5_categorize_members",
    """
    select p_partkey, case when p_brand in ('Brand#1', 'Brand#2', 'Brand#3') then 'positive'
      when p_brand in ('Brand#3', 'Brand#11', 'Brand#12') then 'negative' end as side from part
    """,
)
def c5(t: Tables):
    sets = {"positive": ["Brand#1", "Brand#2", "Brand#3"], "negative": ["Brand#3", "Brand#11", "Brand#12"]}
    return repair.categorize_members(t.part.select("p_partkey", "p_brand"), "p_brand", sets, "side").drop("p_brand")


@query(
    "c6_score_map",
    """
    select o_orderkey, case o_orderpriority when '1-URGENT' then 2 when '2-HIGH' then 1 when '3-MEDIUM' then 0
      when '4-NOT SPECIFIED' then -1 end as points from orders
    """,
)
def c6(t: Tables):
    return repair.score_map(t.orders, "o_orderpriority", PRIORITY, "points").select("o_orderkey", "points")


@query(
    "c7_shorten_labels",
    """
    select c_custkey, case when c_mktsegment in ('FURNITURE', 'HOUSEHOLD') then null when c_mktsegment = 'MACHINERY' then 'mach'
      when c_mktsegment = 'AUTOMOBILE' then 'auto' else c_mktsegment end as segment from customer
    """,
)
def c7(t: Tables):
    short = repair.shorten_labels(
        t.customer, "c_mktsegment", {"MACHINERY": "mach", "AUTOMOBILE": "auto"}, ["FURNITURE", "HOUSEHOLD"], "segment"
    )
    return short.select("c_custkey", "segment")


@query(
    "c8_position_group",
    """
    select l_orderkey, l_partkey, l_suppkey, l_linenumber, case when l_linenumber = 1 then 'first'
      when l_linenumber = (select max(l_linenumber) from lineitem) then 'last' else 'other' end as place from lineitem
    """,
)
def c8(t: Tables):
    top = t.lineitem.agg(F.max("l_linenumber").alias("total"))
    placed = repair.position_group(attach(t.lineitem, top), "l_linenumber", "total", "place")
    return placed.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "place")


@query(
    "c9_apply_corrections",
    """
    select c_custkey, case when c_acctbal < 500 and c_mktsegment = 'MACHINERY' then null
      when c_acctbal < 500 then 'corrected ' || c_custkey else c_name end as c_name from customer
    """,
)
def c9(t: Tables):
    fixes = t.customer.filter("c_acctbal < 500").select(
        "c_custkey",
        F.concat(F.lit("corrected "), F.col("c_custkey").cast("string")).alias("new_value"),
        (F.col("c_mktsegment") == "MACHINERY").alias("set_null"),
    )
    return repair.apply_corrections(t.customer.select("c_custkey", "c_name"), fixes, "c_custkey", "c_name")


@query(
    "c10_conditional_set",
    "select o_orderkey, case when o_orderstatus = 'P' and o_totalprice > 200000 then 200000.0 else o_totalprice end as o_totalprice from orders",
)
def c10(t: Tables):
    mask = (F.col("o_orderstatus") == "P") & (F.col("o_totalprice") > 200000)
    return repair.conditional_set(t.orders, mask, "o_totalprice", 200000.0).select("o_orderkey", "o_totalprice")


@query(
    "c11_speed_class",
    """
    with d as (select l_orderkey, l_partkey, l_suppkey, l_linenumber, date_diff('day', o_orderdate, l_shipdate) as days
               from lineitem left join orders on l_orderkey = o_orderkey),
    q as (select quantile_cont(days, 0.25) as lo, quantile_cont(days, 0.75) as hi from d)
    select l_orderkey, l_partkey, l_suppkey, l_linenumber, case when days < lo then 'fast' when days > hi then 'slow'
      when days is not null then 'normal' end as speed from d, q
    """,
)
def c11(t: Tables):
    orders = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate")
    joined = left_join(t.lineitem, orders, ["l_orderkey"])
    days = joined.withColumn("days", F.datediff("l_shipdate", "o_orderdate"))
    return repair.speed_class(days, "days").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "speed")
