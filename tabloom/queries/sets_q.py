"""Set operations."""

from pyspark.sql import functions as F

from tabloom.operators import ranking, sets
from tabloom.queries.registry import Tables, query

K = 44
# the k best customers by the sum of final, final and open, and all orders
STAGE = "(select o_custkey from orders where o_orderstatus in ({s}) group by 1 order by round(sum(o_totalprice), 2) desc, o_custkey limit 44)"
SETS = {"final": "'F'", "final and open": "'F', 'O'", "all": "'F', 'O', 'P'"}
SQL = {n: STAGE.format(s=s) for n, s in SETS.items()}


def stages(t: Tables):
    out = {}
    for name, wanted in {"final": ["F"], "final and open": ["F", "O"], "all": ["F", "O", "P"]}.items():
        sums = t.orders.filter(F.col("o_orderstatus").isin(*wanted)).groupBy("o_custkey").agg(
            F.round(F.sum("o_totalprice"), 2).alias("total")
        )
        out[name] = ranking.top_k(sums, [("total", False)], K, ["o_custkey"]).select("o_custkey")
    return out


@query(
    "u1_union_all",
    "select c_name as name, c_acctbal as balance, c_mktsegment as segment from customer union all select s_name, s_acctbal, null from supplier",
)
def u1(t: Tables):
    a = t.customer.select(F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment"))
    b = t.supplier.select(F.col("s_acctbal").alias("balance"), F.col("s_name").alias("name"))
    return sets.union_all([a, b])


@query("u2_distinct_rows", "select distinct l_suppkey, l_returnflag, l_linestatus from lineitem")
def u2(t: Tables):
    return sets.distinct_rows(t.lineitem, ["l_suppkey", "l_returnflag", "l_linestatus"])


def _turnover(a: str, b: str) -> str:
    return (
        f"(select count(*) from {SQL[a]} where o_custkey in {SQL[b]}) as stayed,"
        f" (select count(*) from {SQL[a]} where o_custkey not in {SQL[b]}) as \"left\","
        f" (select count(*) from {SQL[b]} where o_custkey not in {SQL[a]}) as new"
    )


@query("u3_set_turnover", "select " + _turnover("final", "final and open"))
def u3(t: Tables):
    s = stages(t)
    return sets.set_turnover(s["final"], s["final and open"], "o_custkey")


def _edges(a: str, b: str) -> str:
    return (
        f"select '{a}' as source, '{b}' as target, stayed as value from (select {_turnover(a, b)}) union all "
        f"select '{a}', 'left {a}', \"left\" from (select {_turnover(a, b)})"
    )


@query("u5_transition_edges", _edges("final", "final and open") + " union all " + _edges("final and open", "all"))
def u5(t: Tables):
    return sets.transition_edges(stages(t), "o_custkey")
