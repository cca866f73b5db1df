"""Missing values and outliers."""

from pyspark.sql import functions as F

from tabloom.operators import missing
from tabloom.queries.registry import GAPPY, LABELLED, Tables, gappy_events, labelled, query, rounded

LINE_KEY = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
# the price is missing on returned lines, the group is the supplier
GAPPY_LINES = (
    "(select l_orderkey, l_partkey, l_suppkey, l_linenumber, l_linestatus, l_quantity,"
    " case when l_returnflag <> 'R' then l_extendedprice end as price from lineitem)"
)


def gappy_lines(t: Tables):
    price = F.when(F.col("l_returnflag") != "R", F.col("l_extendedprice"))
    return t.lineitem.select(*LINE_KEY, "l_linestatus", "l_quantity", price.alias("price"))


@query(
    "m1_fill_constant",
    f"select doc_id, coalesce(quality, -1) as quality, coalesce(toxic, 0) as toxic, lang from {LABELLED}",
)
def m1(t: Tables):
    return missing.fill_constant(labelled(t).select("doc_id", "quality", "toxic", "lang"), {"quality": -1, "toxic": 0, "lang": "unknown"})


@query("m2_fill_median", f"select event_id, round(coalesce(value, median(value) over ()), 6) as value from {GAPPY}")
def m2(t: Tables):
    return rounded(missing.fill_median(gappy_events(t), "value").select("event_id", "value"))


@query(
    "m3_fill_group_median",
    f"""
    with g as {GAPPY_LINES}, m as (select l_suppkey, median(price) as med from g group by l_suppkey)
    select l_orderkey, l_partkey, l_suppkey, l_linenumber, round(coalesce(price, med), 6) as price from g left join m using (l_suppkey)
    """,
)
def m3(t: Tables):
    return rounded(missing.fill_group_median(gappy_lines(t), "price", "l_suppkey").select(*LINE_KEY, "price"))


@query(
    "m3_fill_group_median_where",
    f"""
    with g as {GAPPY_LINES},
    m as (select l_suppkey, median(price) as med from g where l_linestatus <> 'O' group by l_suppkey)
    select l_orderkey, l_partkey, l_suppkey, l_linenumber,
      round(case when price is null and l_linestatus <> 'O' then med else price end, 6) as price
    from g left join m using (l_suppkey)
    """,
)
def m3_where(t: Tables):
    filled = missing.fill_group_median(gappy_lines(t), "price", "l_suppkey", F.col("l_linestatus") != "O")
    return rounded(filled.select(*LINE_KEY, "price"))


@query(
    "m4_fill_group_mean_where",
    f"""
    with g as {GAPPY_LINES}, m as (select l_suppkey, avg(price) as mean from g group by l_suppkey)
    select l_orderkey, l_partkey, l_suppkey, l_linenumber, round(case when l_quantity <= 5 then mean else price end, 4) as price
    from g left join m using (l_suppkey)
    """,
)
def m4(t: Tables):
    filled = missing.fill_group_mean_where(gappy_lines(t), "price", "l_suppkey", F.col("l_quantity") <= 5)
    return rounded(filled.select(*LINE_KEY, "price"), 4)


@query(
    "m5_fill_neighbours",
    f"""
    with w as (select event_id, value, last_value(value ignore nulls) over p as prev, lead(value) over o as nxt from {GAPPY}
      window o as (partition by user_id order by ts, event_id),
             p as (partition by user_id order by ts, event_id rows between unbounded preceding and 1 preceding))
    select event_id, round(coalesce(value, (prev + nxt) / 2, prev, nxt), 6) as value from w
    """,
)
def m5(t: Tables):
    filled = missing.fill_neighbours(gappy_events(t), ["user_id"], "ts", "event_id", ["value"])
    return rounded(filled.select("event_id", "value"))


INTERPOLATED = """
    with r as (select event_id, value, row_number() over (partition by {part} order by ts, event_id) as pos, {key} from {gappy}),
    w as (select event_id, value, pos,
        last_value(value ignore nulls) over b as pv, last_value(case when value is not null then pos end ignore nulls) over b as pp,
        first_value(value ignore nulls) over a as nv, first_value(case when value is not null then pos end ignore nulls) over a as np
      from r window b as (partition by {part} order by pos rows between unbounded preceding and 1 preceding),
                    a as (partition by {part} order by pos rows between 1 following and unbounded following))
    select event_id, round(coalesce(value, pv + (nv - pv) * (pos - pp) / (np - pp), pv), 6) as value from w
"""


@query("m6_interpolate_linear", INTERPOLATED.format(part="user_id", key="user_id", gappy=GAPPY))
def m6(t: Tables):
    filled = missing.interpolate_linear(gappy_events(t), ["user_id"], "ts", "event_id", ["value"])
    return rounded(filled.select("event_id", "value"))


@query("m6_interpolate_linear_one_series", INTERPOLATED.format(part="one", key="1 as one", gappy=GAPPY).replace("over (partition by one order by ts", "over (order by ts"))
def m6_one(t: Tables):
    filled = missing.interpolate_linear(gappy_events(t), [], "ts", "event_id", ["value"])
    return rounded(filled.select("event_id", "value"))


@query(
    "m7_cap_outliers",
    """
    with q as (select quantile_cont(l_extendedprice, 0.995) as cap, median(l_extendedprice) as mid from lineitem)
    select l_orderkey, l_partkey, l_suppkey, l_linenumber,
      round(case when l_extendedprice > cap then mid else l_extendedprice end, 6) as l_extendedprice from lineitem, q
    """,
)
def m7(t: Tables):
    capped = missing.cap_outliers(t.lineitem, "l_extendedprice", 0.995)
    return rounded(capped.select(*LINE_KEY, "l_extendedprice"))


@query(
    "m8_impute_scaled",
    """
    with p as (select p_partkey, p_size, case when p_type <> 'SMALL' then p_retailprice end as price from part),
    m as (select p_size, round_even(avg(price), 0) as m from p group by p_size having avg(price) is not null),
    a as (select round_even(sum(m) / sum(p_size), 0) as unit from m)
    select p_partkey, coalesce(price, p_size * unit) as price from p, a
    """,
)
def m8(t: Tables):
    price = F.when(F.col("p_type") != "SMALL", F.col("p_retailprice"))
    return missing.impute_scaled(t.part.select("p_partkey", "p_size", price.alias("price")), "price", "p_size").select("p_partkey", "price")


@query("m9_trim_above", "select l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity from lineitem where l_quantity <= 40")
def m9(t: Tables):
    return missing.trim_above(t.lineitem, "l_quantity", 40).select(*LINE_KEY, "l_quantity")


@query("m9_share_above", "select round(avg((l_quantity > 40)::int), 9) as share from lineitem")
def m9_share(t: Tables):
    return rounded(missing.share_above(t.lineitem, "l_quantity", 40), 9)


@query(
    "m10_fill_mode",
    """
    with c as (select c_custkey, case when c_acctbal > 1000 then c_mktsegment end as segment,
                 case when c_acctbal > 2000 then c_nationkey::varchar end as nation from customer),
    s as (select segment from c where segment is not null group by 1 order by count(*) desc, 1 limit 1),
    n as (select nation from c where nation is not null group by 1 order by count(*) desc, 1 limit 1)
    select c_custkey, coalesce(c.segment, s.segment) as segment, coalesce(c.nation, n.nation) as nation from c, s, n
    """,
)
def m10(t: Tables):
    gaps = t.customer.select(
        "c_custkey",
        F.when(F.col("c_acctbal") > 1000, F.col("c_mktsegment")).alias("segment"),
        F.when(F.col("c_acctbal") > 2000, F.col("c_nationkey").cast("string")).alias("nation"),
    )
    return missing.fill_mode(gaps, ["segment", "nation"])
