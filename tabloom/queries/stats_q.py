"""Statistics."""

from itertools import combinations_with_replacement

from pyspark.sql import functions as F

from tabloom.operators import stats
from tabloom.queries.registry import Tables, query, rounded

LINE = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("n1_pearson", "select round(corr(l_quantity, l_extendedprice), 9) as r from lineitem")
def n1(t: Tables):
    return rounded(stats.pearson(t.lineitem, "l_quantity", "l_extendedprice"), 9)


def _pairs_sql(cols: dict[str, str], table: str) -> str:
    out = []
    for a, b in combinations_with_replacement(cols, 2):
        for x, y in {(a, b), (b, a)}:
            out.append(f"select '{x}' as a, '{y}' as b, round(corr({cols[a]}, {cols[b]}), 9) as r from {table}")
    return " union all ".join(out)


@query("n2_correlation_matrix", _pairs_sql({**{c: c for c in LINE}, "l_shipdate": "epoch(l_shipdate)"}, "lineitem"))
def n2(t: Tables):
    return rounded(stats.correlation_matrix(t.lineitem, [*LINE, "l_shipdate"]), 9)


RANKS = """
    (select (rank() over (order by o_totalprice) + (count(*) over (partition by o_totalprice) - 1) / 2) as price,
       (rank() over (order by o_custkey) + (count(*) over (partition by o_custkey) - 1) / 2) as cust,
       (rank() over (order by d) + (count(*) over (partition by d) - 1) / 2) as day
     from (select *, epoch(o_orderdate) as d from orders))
"""


@query("n3_spearman", f"select round(corr(price, cust), 9) as r from {RANKS}")
def n3(t: Tables):
    return rounded(stats.spearman(t.orders, "o_totalprice", "o_custkey"), 9)


@query("n3_spearman_matrix", _pairs_sql({"o_totalprice": "price", "o_custkey": "cust", "o_orderdate": "day"}, RANKS))
def n3_matrix(t: Tables):
    return rounded(stats.correlation_matrix(t.orders, ["o_totalprice", "o_custkey", "o_orderdate"], "spearman"), 9)


ASSOC = ["c_mktsegment", "c_nationkey", "c_acctbal"]
BINNED = """
    (select c_mktsegment, c_nationkey::varchar as c_nationkey,
       least(floor((c_acctbal - lo) * 10 / (hi - lo)), 9)::varchar as c_acctbal
     from customer, (select min(c_acctbal) as lo, max(c_acctbal) as hi from customer))
"""


def _chi_sql(a: str, b: str) -> str:
    return f"""
    select '{a}' as a, '{b}' as b, any_value(total)::bigint as n, any_value(r) as r, any_value(k) as k,
      round(any_value(total) * (sum(n * n / (nx * ny)) - 1), 6) as chi2,
      round(sqrt((sum(n * n / (nx * ny)) - 1) / (least(any_value(r), any_value(k)) - 1)), 9) as cramers_v
    from (select x, y, n::double as n, (sum(n) over (partition by x))::double as nx, (sum(n) over (partition by y))::double as ny,
            sum(n) over () as total, (select count(distinct {a}) from {BINNED}) as r, (select count(distinct {b}) from {BINNED}) as k
          from (select {a} as x, {b} as y, count(*) as n from {BINNED} group by all))
    """


@query(
    "n4_association_chi2_cramers_v",
    " union all ".join(_chi_sql(a, b) for a, b in [(ASSOC[0], ASSOC[1]), (ASSOC[0], ASSOC[2]), (ASSOC[1], ASSOC[2])]),
)
def n4(t: Tables):
    out = stats.association_matrix(t.customer, ASSOC, ["c_acctbal"]).drop("phi_k")
    return rounded(rounded(out, 6, ["chi2"]), 9, ["cramers_v"])


@query("n4_association_matrix_phi_k")
def n4_phi(t: Tables):
    # price and quantity of a line are related, the flags are not
    cols = ["l_quantity", "l_extendedprice", "l_returnflag", "l_linestatus"]
    return rounded(stats.association_matrix(t.lineitem, cols, ["l_quantity", "l_extendedprice"]))


@query(
    "n4_phi_k_of_two_by_two",
    """
    with c as (select (l_quantity > 25)::int as x, (l_extendedprice > 20000)::int as y, count(*)::double as n from lineitem group by all),
    k as (select any_value(tot) as n, any_value(tot) * (sum(n * n / (nx * ny)) - 1) as chi2
      from (select *, sum(n) over (partition by x) as nx, sum(n) over (partition by y) as ny, sum(n) over () as tot from c))
    select 'big' as a, 'dear' as b, round(case when chi2 <= 1 then 0
      else sin(pi() / 2 * sqrt((chi2 - 1) / (n - 1) * pow(2 * asin(1 - 1e-6) / pi(), 2))) end, 4) as phi_k from k
    """,
)
def n4_two(t: Tables):
    """Of two halves each, χ² per row is (2 asin ρ / π)²; φk is that curve read backwards, above the noise level."""
    rows = t.lineitem.select((F.col("l_quantity") > 25).cast("string").alias("big"), (F.col("l_extendedprice") > 20000).cast("string").alias("dear"))
    return rounded(stats.association_matrix(rows, ["big", "dear"], []).select("a", "b", "phi_k"), 4)


@query(
    "n5_sample_skewness",
    " union all ".join(f"select '{c}' as \"column\", round(skewness({c}), 6) as skewness from lineitem" for c in LINE),
)
def n5(t: Tables):
    return rounded(stats.sample_skewness(t.lineitem, LINE), 6)


QS = [0.8, 0.9, 0.95, 0.99, 0.995, 1.0]


@query(
    "n6_quantiles",
    " union all ".join(f"select {q}::double as q, round(quantile_cont(value, {q}), 6) as value from events" for q in QS),
)
def n6(t: Tables):
    return rounded(stats.quantiles(t.events, "value", QS))


@query(
    "n7_balance_score",
    """
    select user_id, round(sum(value) filter (event_type in ('click', 'purchase')), 4) as positive,
      round(sum(value) filter (event_type = 'error'), 4) as negative,
      round(sum(value) filter (event_type in ('click', 'purchase')) - sum(value) filter (event_type = 'error'), 4) as score
    from events where event_type in ('click', 'purchase', 'error') group by user_id
    """,
)
def n7(t: Tables):
    positive, negative = F.col("event_type").isin("click", "purchase"), F.col("event_type") == "error"
    return rounded(stats.balance_score(t.events, ["user_id"], positive, negative, "value"), 4)


@query(
    "n8_ols_one_feature",
    """
    with s as (select count(*) as n, regr_slope(l_extendedprice, l_quantity) as b, regr_intercept(l_extendedprice, l_quantity) as a,
        regr_sxx(l_extendedprice, l_quantity) as sxx, regr_syy(l_extendedprice, l_quantity) as syy, avg(l_quantity) as m from lineitem),
    v as (select *, (syy - b * b * sxx) / (n - 2) as s2 from s)
    select 'l_quantity' as term, round(b, 6) as coef, round(sqrt(s2 / sxx), 6) as se, round(b / sqrt(s2 / sxx), 4) as t from v
    union all select 'const', round(a, 6), round(sqrt(s2 * (1.0 / n + m * m / sxx)), 6), round(a / sqrt(s2 * (1.0 / n + m * m / sxx)), 4) from v
    """,
)
def n8(t: Tables):
    fit = stats.ols(t.lineitem, "l_extendedprice", ["l_quantity"])
    return rounded(rounded(fit.coefficients.drop("p"), 6, ["coef", "se"]), 4, ["t"])


@query(
    "n8_ols_fit",
    """
    select count(*) as n, round(regr_r2(l_extendedprice, l_quantity), 9) as r2,
      round(1 - (1 - regr_r2(l_extendedprice, l_quantity)) * (count(*) - 1) / (count(*) - 2), 9) as r2_adj from lineitem
    """,
)
def n8_fit(t: Tables):
    fit = stats.ols(t.lineitem, "l_extendedprice", ["l_quantity"])
    return rounded(fit.summary.select(F.col("n").cast("long").alias("n"), "r2", "r2_adj"), 9)


@query(
    "n8_ols_year_dummies",
    """
    with m as (select year(o_orderdate) as y, avg(o_totalprice) as m from orders group by 1), f as (select m from m where y = (select min(y) from m))
    select 'const' as term, round(m, 4) as coef from f union all
    select 'year_' || y, round(m.m - f.m, 4) from m, f where y > (select min(y) from m)
    """,
)
def n8_years(t: Tables):
    fit = stats.ols(t.orders.withColumn("year", F.year("o_orderdate")), "o_totalprice", [], "year")
    return rounded(fit.coefficients.select("term", "coef"), 4)


def _det(a: str, b: str, c: str) -> str:
    """Determinant of three columns of three names each."""
    (a1, a2, a3), (b1, b2, b3), (c1, c2, c3) = a.split(), b.split(), c.split()
    return f"({a1} * ({b2} * {c3} - {b3} * {c2}) - {b1} * ({a2} * {c3} - {a3} * {c2}) + {c1} * ({a2} * {b3} - {a3} * {b2}))"


QQ, DD, TT, YY = "qq qd qt", "qd dd dt", "qt dt tt", "qy dy ty"
LEAST_SQUARES = f"""
    r as (select l_shipdate, l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey as tie, year(l_shipdate) as g,
      l_quantity as q, l_discount as d, l_tax as t, l_extendedprice as y from lineitem),
    m as (select g, avg(q) as mq, avg(d) as md, avg(t) as mt, avg(y) as my, count(*) as n from r group by g),
    w as (select q - mq as q, d - md as d, t - mt as t, y - my as y from r join m using (g)),
    s as (select sum(q*q) as qq, sum(q*d) as qd, sum(q*t) as qt, sum(d*d) as dd, sum(d*t) as dt, sum(t*t) as tt, sum(q*y) as qy, sum(d*y) as dy, sum(t*y) as ty from w),
    b as (select {_det(YY, DD, TT)} / {_det(QQ, DD, TT)} as bq, {_det(QQ, YY, TT)} / {_det(QQ, DD, TT)} as bd, {_det(QQ, DD, YY)} / {_det(QQ, DD, TT)} as bt from s),
    f as (select g, my - bq * mq - bd * md - bt * mt as a from m, b),
    e as (select l_shipdate, tie, y - bq * q - bd * d - bt * t - a as e from r join f using (g), b),
    l as (select e, e - lag(e) over (order by l_shipdate, tie) as step from e)
"""


@query(
    "n8_ols_mixed_with_residual_test",
    f"""
    with {LEAST_SQUARES}, z as (select a from f order by g limit 1)
    select term, round(coef, 3) as coef from (
      select 'l_quantity' as term, bq as coef from b union all select 'l_discount', bd from b union all select 'l_tax', bt from b
      union all select 'const', a from z union all select 'year_' || g, f.a - z.a from f, z where g > (select min(g) from f)
      union all select 'durbin_watson', sum(step * step) / sum(e * e) from l)
    """,
)
def n8_mixed(t: Tables):
    from tabloom.operators.ranking import durbin_watson

    rows = t.lineitem.withColumn("year", F.year("l_shipdate"))
    fit = stats.ols(rows, "l_extendedprice", ["l_quantity", "l_discount", "l_tax"], "year")
    line = fit.coefficients.select("term", F.round("coef", 3).alias("coef"))
    tie = F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    dw = durbin_watson(stats.residuals(fit, rows).withColumn("tie", tie), [], "l_shipdate", "tie", "resid")
    return line.unionByName(dw.select(F.lit("durbin_watson").alias("term"), F.round("durbin_watson", 3).alias("coef")))


@query(
    "n8_ols_many_levels",
    """
    with m as (select l_partkey as g, avg(l_extendedprice) as my, avg(l_quantity) as mq from lineitem group by 1),
    b as (select sum((l_quantity - mq) * (l_extendedprice - my)) / sum((l_quantity - mq) * (l_quantity - mq)) as b from lineitem join m on g = l_partkey),
    f as (select g, my - b * mq as a from m, b), z as (select a from f order by g limit 1)
    select 'l_quantity' as term, round(b, 3) as coef from b union all select 'const', round(a, 3) from z
    union all select 'l_partkey_' || g, round(f.a - z.a, 3) from f, z where g > (select min(g) from f)
    """,
)
def n8_levels(t: Tables):
    """A level per part: more dummies than a matrix of them would hold."""
    fit = stats.ols(t.lineitem, "l_extendedprice", ["l_quantity"], "l_partkey")
    return fit.coefficients.select("term", F.round("coef", 3).alias("coef"))
