"""Projection, renaming, derivation."""

from pyspark.sql import functions as F

from tabloom.functions import numeric
from tabloom.operators import shape
from tabloom.queries.registry import Tables, query, rounded


@query("p1_project", "select c_mktsegment, c_name, c_acctbal from customer")
def p1(t: Tables):
    return shape.project(t.customer, ["c_mktsegment", "c_name", "c_acctbal"])


@query("p2_rename", "select o_orderkey as id, o_custkey as customer, o_orderstatus, o_totalprice as price from orders")
def p2(t: Tables):
    orders = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    return shape.rename(orders, {"o_orderkey": "id", "o_custkey": "customer", "o_totalprice": "price", "absent": "x"})


@query("p3_rename_positional", "select s_suppkey as id, s_name as name, s_nationkey as nation, s_acctbal as balance from supplier")
def p3(t: Tables):
    return shape.rename_positional(t.supplier, ["id", "name", "nation", "balance"])


@query("p4_normalize_names", "select o_orderkey as order_key, o_orderstatus as order_status from orders")
def p4(t: Tables):
    messy = t.orders.select(F.col("o_orderkey").alias("  Order Key"), F.col("o_orderstatus").alias("Order Status  "))
    return shape.normalize_names(messy)


TARGET = "kind string, id bigint, name string, nation int, balance double, segment string"


@query(
    "p5_conform",
    """
    select 'customer' as kind, c_custkey as id, c_name as name, c_nationkey as nation, c_acctbal as balance,
           c_mktsegment as segment from customer
    union all select 'supplier', s_suppkey, s_name, s_nationkey, s_acctbal, null from supplier
    """,
)
def p5(t: Tables):
    customers = shape.rename(
        t.customer,
        {"c_custkey": "id", "c_name": "name", "c_nationkey": "nation", "c_acctbal": "balance", "c_mktsegment": "segment"},
    )
    suppliers = shape.rename(
        t.supplier, {"s_suppkey": "id", "s_name": "name", "s_nationkey": "nation", "s_acctbal": "balance"}
    )
    return shape.conform(customers, TARGET, {"kind": "customer"}).unionByName(
        shape.conform(suppliers, TARGET, {"kind": "supplier"})
    )


@query("p6_drop_columns", "select l_orderkey, l_linenumber, l_quantity, l_extendedprice from lineitem")
def p6(t: Tables):
    return shape.drop_columns(
        t.lineitem,
        ["l_partkey", "l_suppkey", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate", "absent"],
    )


@query(
    "p7_derive",
    """
    select l_orderkey, l_linenumber, l_partkey, round(l_extendedprice / nullif(l_quantity, 0), 6) as unit_price,
      round(l_discount / nullif(l_tax, 0), 6) as discount_per_tax, round(l_discount / nullif(l_tax, 0) - 1, 6) as change,
      round(l_extendedprice + l_extendedprice * l_tax, 6) as gross, round(l_extendedprice / 1000, 6) as thousands
    from lineitem
    """,
)
def p7(t: Tables):
    df = shape.derive(
        t.lineitem,
        {
            "unit_price": numeric.ratio(F.col("l_extendedprice"), F.col("l_quantity")),
            "discount_per_tax": numeric.ratio(F.col("l_discount"), F.col("l_tax")),
            "change": numeric.relative_change(F.col("l_discount"), F.col("l_tax")),
            "gross": F.col("l_extendedprice") + F.col("l_extendedprice") * F.col("l_tax"),
            "thousands": F.col("l_extendedprice") / 1000,
        },
    )
    return rounded(
        df.select("l_orderkey", "l_linenumber", "l_partkey", "unit_price", "discount_per_tax", "change", "gross", "thousands")
    )


@query(
    "p8_scale_by",
    "select p_partkey, round(p_size * (select avg(p_retailprice) from part), 4) as scaled from part",
)
def p8(t: Tables):
    scaled = shape.scale_by(t.part, "p_size", t.part.agg(F.avg("p_retailprice").alias("m")), "scaled")
    return rounded(scaled.select("p_partkey", "scaled"), 4)


@query(
    "p9_convert",
    """
    select event_id, (props ->> '$.k')::int as k, trunc(value)::int as whole, value > 10 as big,
      strftime(ts, '%Y-%m-%d')::date as day, try_cast(event_type as double) as bad, make_date(2000 + user_id, 1, 1) as y
    from events
    """,
)
def p9(t: Tables):
    raw = t.events.select(
        "event_id",
        F.get_json_object("props", "$.k").alias("k"),
        F.col("value").alias("whole"),
        (F.col("value") > 10).cast("string").alias("big"),
        F.date_format("ts", "dd.MM.yyyy").alias("day"),
        F.col("event_type").alias("bad"),
        (F.col("user_id") + 2000).alias("y"),
    )
    kinds = {"k": "int", "whole": "int", "big": "boolean", "day": "date", "bad": "double", "y": "year"}
    return shape.convert(raw, kinds, {"day": "dd.MM.yyyy"})


@query(
    "p10_flag_token",
    """
    select o_orderkey, case when o_orderstatus = 'P' then 0 else trunc(o_totalprice / 1000)::int end as points,
      (o_orderstatus = 'P')::int as missing from orders
    """,
)
def p10(t: Tables):
    points = F.when(F.col("o_orderstatus") == "P", F.lit("absent")).otherwise(
        F.floor(F.col("o_totalprice") / 1000).cast("string")
    )
    return shape.flag_token(t.orders.select("o_orderkey", points.alias("points")), "points", "absent", "missing")
