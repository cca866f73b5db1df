"""Profiling."""

from pyspark.sql import functions as F

from tabloom.operators import profile
from tabloom.queries.registry import LABELLED, Tables, labelled, query, rounded


@query(
    "q1_null_profile",
    " union all ".join(
        f"select '{c}' as \"column\", count_if({c} is null)::bigint as nulls, round(avg(({c} is null)::int), 9) as share from {LABELLED}"
        for c in ("doc_id", "lang", "quality", "toxic")
    ),
)
def q1(t: Tables):
    return rounded(profile.null_profile(labelled(t).select("doc_id", "lang", "quality", "toxic")), 9)


@query("q2_duplicate_count", "select (count(*) - count(distinct text))::bigint as duplicates from documents")
def q2(t: Tables):
    return profile.duplicate_count(t.documents, ["text"], digest=["text"])


@query(
    "q2_duplicate_count_columns",
    "select (sum(n) - count(*))::bigint as duplicates from (select count(*) as n from lineitem group by l_partkey, l_quantity)",
)
def q2_cols(t: Tables):
    return profile.duplicate_count(t.lineitem, ["l_partkey", "l_quantity"])


@query(
    "q2_duplicate_rows",
    """
    select o_orderkey, o_custkey, o_orderpriority from (
      select *, row_number() over (partition by o_custkey, o_orderpriority order by o_orderkey) as rn from orders) where rn > 1
    """,
)
def q2_rows(t: Tables):
    return profile.duplicate_rows(
        t.orders.select("o_orderkey", "o_custkey", "o_orderpriority"), ["o_custkey", "o_orderpriority"], "o_orderkey"
    )


@query(
    "q3_distinct_values",
    " union all ".join(
        f"select distinct '{c}' as \"column\", {c} as value from part" for c in ("p_name", "p_brand", "p_type")
    ),
)
def q3(t: Tables):
    return profile.distinct_values(t.part)


@query("q3_n_unique", "select count(distinct l_partkey) as n_unique from lineitem")
def q3_n(t: Tables):
    return profile.n_unique(t.lineitem, "l_partkey")


DESCRIBE = """
    {by} count({c}) as count, round(avg({c}), 4) as mean, round(stddev_samp({c}), 4) as std, min({c}) as min,
    round(quantile_cont({c}, 0.25), 4) as q25, round(quantile_cont({c}, 0.5), 4) as q50, round(quantile_cont({c}, 0.75), 4) as q75,
    max({c}) as max from {t} {group}
"""


@query("q4_describe", DESCRIBE.format(by="select", c="o_totalprice", t="orders", group=""))
def q4(t: Tables):
    return rounded(profile.describe(t.orders, "o_totalprice"), 4)


@query(
    "q4_describe_by_group",
    DESCRIBE.format(by="select o_orderpriority,", c="o_totalprice", t="orders", group="group by o_orderpriority"),
)
def q4_by(t: Tables):
    return rounded(profile.describe(t.orders, "o_totalprice", ["o_orderpriority"]), 4)


def _text_sql(c: str) -> str:
    return (
        f"select '{c}' as \"column\", (select count({c}) from customer) as count, (select count(distinct {c}) from customer) as \"unique\","
        f" v as top, n as freq from (select {c}::varchar as v, count(*) as n from customer group by 1 order by n desc, v limit 1)"
    )


@query("q4_describe_text", _text_sql("c_mktsegment") + " union all " + _text_sql("c_nationkey"))
def q4_text(t: Tables):
    return profile.describe_text(t.customer, ["c_mktsegment", "c_nationkey"])


@query(
    "q5_schema_profile",
    " union all ".join(
        f"select '{c}' as \"column\", '{k}' as type, count({c}) as non_null from {LABELLED}"
        for c, k in [("doc_id", "bigint"), ("lang", "string"), ("quality", "int"), ("toxic", "int"), ("n_chars", "bigint")]
    ),
)
def q5(t: Tables):
    return profile.schema_profile(labelled(t).select("doc_id", "lang", "quality", "toxic", "n_chars"))


def _summary_sql(c: str) -> str:
    return (
        f"select '{c}' as \"column\", count({c}) / count(*) as complete, min({c}) as min, max({c}) as max, round(avg({c}), 4) as mean,"
        f" round(quantile_cont({c}, 0.5), 4) as p50, round(quantile_cont({c}, 0.9), 4) as p90, round(quantile_cont({c}, 0.95), 4) as p95"
        " from lineitem"
    )


@query(
    "q6_summary_table",
    " union all ".join(_summary_sql(c) for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")),
)
def q6(t: Tables):
    return rounded(profile.summary_table(t.lineitem), 4)


@query(
    "q8_time_span",
    """
    select 'events' as "table", min(ts) as first, max(ts) as last from events
    union all select 'orders', min(o_orderdate), max(o_orderdate) from orders
    union all select 'lineitem', min(l_shipdate), max(l_shipdate) from lineitem
    """,
)
def q8(t: Tables):
    return profile.time_span(
        {"events": (t.events, "ts"), "orders": (t.orders, "o_orderdate"), "lineitem": (t.lineitem, "l_shipdate")}
    )


@query(
    "q9_histogram",
    """
    with b as (select range as bin from range(1, 51)),
    c as (select least(floor(l_extendedprice / 1500)::bigint + 1, 50) as bin, count(*) as n from lineitem
          where l_extendedprice between 0 and 75000 group by 1)
    select b.bin, (b.bin - 1) * 1500.0::double as low, b.bin * 1500.0::double as high, coalesce(n, 0) as n from b left join c using (bin)
    """,
)
def q9(t: Tables):
    return profile.histogram(t.lineitem, "l_extendedprice", 50, 0, 75_000)


@query(
    "q10_box_stats",
    """
    with q as (select o_orderstatus, quantile_cont(o_totalprice, 0.25) as q25, quantile_cont(o_totalprice, 0.5) as q50,
                 quantile_cont(o_totalprice, 0.75) as q75 from orders group by o_orderstatus),
    r as (select o.o_orderstatus, o_totalprice as v, q25, q50, q75,
            o_totalprice between q25 - 1.5 * (q75 - q25) and q75 + 1.5 * (q75 - q25) as inside from orders o join q using (o_orderstatus))
    select o_orderstatus, round(min(case when inside then v end), 4) as whisker_low, round(any_value(q25), 4) as q25,
      round(any_value(q50), 4) as q50, round(any_value(q75), 4) as q75, round(max(case when inside then v end), 4) as whisker_high,
      count_if(not inside)::bigint as outliers from r group by o_orderstatus
    """,
)
def q10(t: Tables):
    return rounded(profile.box_stats(t.orders, "o_totalprice", ["o_orderstatus"]), 4)


@query(
    "q10_box_stats_all",
    """
    with q as (select quantile_cont(n_chars, 0.25) as q25, quantile_cont(n_chars, 0.5) as q50, quantile_cont(n_chars, 0.75) as q75 from documents),
    r as (select n_chars::double as v, q25, q50, q75, n_chars between q25 - 1.5 * (q75 - q25) and q75 + 1.5 * (q75 - q25) as inside from documents, q)
    select min(case when inside then v end) as whisker_low, any_value(q25) as q25, any_value(q50) as q50, any_value(q75) as q75,
      max(case when inside then v end) as whisker_high, count_if(not inside)::bigint as outliers from r
    """,
)
def q10_all(t: Tables):
    return profile.box_stats(t.documents.withColumn("n_chars", F.col("n_chars")), "n_chars")
