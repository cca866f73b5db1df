"""Joins."""

from pyspark.sql import functions as F

from tabloom.operators import aggregate as agg
from tabloom.operators import joins
from tabloom.queries.registry import Tables, query, rounded


@query(
    "j1_inner_join",
    "select o_orderkey, o_totalprice, c_name, c_mktsegment from orders join customer on o_custkey = c_custkey",
)
def j1(t: Tables):
    customers = t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_name", "c_mktsegment")
    joined = joins.inner_join(t.orders, customers, ["o_custkey"])
    return joined.select("o_orderkey", "o_totalprice", "c_name", "c_mktsegment")


@query(
    "j1_inner_join_two_keys",
    """
    with a as (select l_suppkey, l_returnflag, count(*) as n from lineitem group by all),
    b as (select l_suppkey, l_returnflag, round(sum(l_quantity), 2) as q from lineitem where l_linestatus = 'F' group by all)
    select l_suppkey, l_returnflag, n, q from a join b using (l_suppkey, l_returnflag)
    """,
)
def j1_two(t: Tables):
    keys = ["l_suppkey", "l_returnflag"]
    a = t.lineitem.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    b = t.lineitem.filter("l_linestatus = 'F'").groupBy(*keys).agg(F.sum("l_quantity").alias("q"))
    return rounded(joins.inner_join(a, b, keys), 2)


@query("j2_left_join", "select doc_id, lang, quality, toxic from documents left join labels using (doc_id)")
def j2(t: Tables):
    return joins.left_join(t.documents.select("doc_id", "lang"), t.labels, ["doc_id"])


@query(
    "j3_full_join",
    """
    with p as (select o_custkey, o_orderpriority, round(sum(o_totalprice), 2) as points from orders where o_orderstatus = 'F' group by all),
    n as (select o_custkey, o_orderpriority, round(sum(o_totalprice), 2) as points from orders where o_orderstatus = 'P' group by all)
    select coalesce(p.o_custkey, n.o_custkey) as o_custkey, coalesce(p.o_orderpriority, n.o_orderpriority) as o_orderpriority,
      p.points as points_positive, n.points as points_negative, round(p.points - n.points, 2) as score
    from p full join n on p.o_custkey = n.o_custkey and p.o_orderpriority = n.o_orderpriority
    """,
)
def j3(t: Tables):
    keys = ["o_custkey", "o_orderpriority"]
    side = lambda s: rounded(t.orders.filter(F.col("o_orderstatus") == s).groupBy(*keys).agg(F.sum("o_totalprice").alias("points")), 2)
    both = joins.full_join(side("F"), side("P"), keys, ("_positive", "_negative"))
    return rounded(both.withColumn("score", F.col("points_positive") - F.col("points_negative")), 2)


@query(
    "j3_full_join_raw_keys",
    """
    select coalesce(d.doc_id, l.doc_id) as doc_id, d.n_chars, l.quality from (select doc_id, n_chars from documents where lang = 'en') d
    full join (select doc_id, quality from labels) l on d.doc_id = l.doc_id
    """,
)
def j3_raw(t: Tables):
    return joins.full_join(t.documents.filter("lang = 'en'").select("doc_id", "n_chars"), t.labels.select("doc_id", "quality"), ["doc_id"])


@query(
    "j4_join_suffixed",
    """
    with v as (select user_id, avg(value) filter (event_type = 'click') as click, avg(value) filter (event_type = 'view') as view from events group by user_id),
    c as (select user_id, count(*) filter (event_type = 'click') as click, count(*) filter (event_type = 'view') as view from events group by user_id)
    select v.user_id, round(v.click, 6) as click, round(v.view, 6) as view, nullif(c.click, 0) as click_n, nullif(c.view, 0) as view_n
    from v join c on v.user_id = c.user_id
    """,
)
def j4(t: Tables):
    means = agg.pivot_mean(t.events, "user_id", "event_type", "value", ["click", "view"])
    counts = agg.cross_count(t.events, "user_id", "event_type", ["click", "view"])
    return rounded(joins.join_suffixed(means, counts, "user_id", "_n"))


@query(
    "j5_overlap_report",
    """
    select count_if(d.doc_id is not null and l.doc_id is not null)::bigint as both, count_if(l.doc_id is null)::bigint as left_only,
      count_if(d.doc_id is null)::bigint as right_only
    from (select distinct doc_id from documents where lang <> 'de') d full join (select distinct doc_id from labels) l using (doc_id)
    """,
)
def j5(t: Tables):
    return joins.overlap_report(t.documents.filter("lang <> 'de'"), t.labels, "doc_id")


@query(
    "j6_flag_members",
    "select c_custkey, c_custkey in (select o_custkey from orders where o_orderstatus = 'P') as has_pending from customer",
)
def j6(t: Tables):
    pending = t.orders.filter("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey"))
    return joins.flag_members(t.customer.select("c_custkey"), pending, "c_custkey", "has_pending")


@query(
    "j7_fuzzy_join",
    """
    with l as (select p_partkey, translate(p_name || ' ' || p_brand, 'g', 'q') as name from part),
    r as (select distinct p_name || ' ' || p_brand as known from part),
    n as (select distinct name from l),
    s as (select name, known, 1 - levenshtein(name, known) / greatest(length(name), length(known)) as score from n, r),
    b as (select name, known, score, row_number() over (partition by name order by round(score, 12) desc, known) as rn from s where score >= 0.9 - 1e-12)
    select p_partkey, l.name, known, substr(md5(known), 1, 6) as code, round(score, 9) as score
    from l left join (select * from b where rn = 1) b using (name)
    """,
)
def j7(t: Tables):
    full = F.concat_ws(" ", "p_name", "p_brand")
    left = t.part.select("p_partkey", F.translate(full, "g", "q").alias("name"))
    right = t.part.select(full.alias("known")).distinct()
    right = right.withColumn("code", F.substring(F.md5(F.col("known").cast("binary")), 1, 6))
    return rounded(joins.fuzzy_join(left, right, "name", "known", 0.9), 9)


@query(
    "j7_fuzzy_join_half",
    """
    with l as (select distinct p_name || ' ' || p_brand as name from part),
    r as (select distinct left(name, length(name) // 2 + 1) as known from l),
    s as (select name, known, 1 - levenshtein(name, known) / greatest(length(name), length(known)) as score from l, r),
    b as (select name, known, score, row_number() over (partition by name order by round(score, 12) desc, known) as rn from s where score >= 0.5 - 1e-12)
    select l.name, known, round(score, 9) as score from l left join (select * from b where rn = 1) b using (name)
    """,
)
def j7_half(t: Tables):
    left = t.part.select(F.concat_ws(" ", "p_name", "p_brand").alias("name")).distinct()
    right = left.select(F.expr("substring(name, 1, length(name) div 2 + 1)").alias("known")).distinct()
    return rounded(joins.fuzzy_join(left, right, "name", "known", 0.5), 9)


@query(
    "j8_map_join",
    "select c_custkey, c_nationkey, n_name from customer left join nation on c_nationkey = n_nationkey",
)
def j8(t: Tables):
    # the mapping lists every nation once per customer, as a mapping taken from fact rows does
    mapping = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select("c_nationkey", "n_name")
    return joins.map_join(t.customer.select("c_custkey", "c_nationkey"), mapping, "c_nationkey")


@query(
    "j9_align_columns",
    """
    select coalesce(a.k, b.k, c.k) as key, a.v as everyone, b.v as pending, c.v as balance from
      (select o_custkey as k, round(sum(o_totalprice), 2) as v from orders group by 1) a
      full join (select o_custkey as k, round(sum(o_totalprice), 2) as v from orders where o_orderstatus = 'P' group by 1) b on a.k = b.k
      full join (select c_custkey as k, c_acctbal as v from customer) c on coalesce(a.k, b.k) = c.k
    """,
)
def j9(t: Tables):
    spent = rounded(t.orders.groupBy(F.col("o_custkey").alias("key")).agg(F.sum("o_totalprice").alias("v")), 2)
    pending = t.orders.filter("o_orderstatus = 'P'").groupBy(F.col("o_custkey").alias("key")).agg(F.sum("o_totalprice").alias("v"))
    balance = t.customer.select(F.col("c_custkey").alias("key"), F.col("c_acctbal").alias("v"))
    return joins.align_columns({"everyone": (spent, "v"), "pending": (rounded(pending, 2), "v"), "balance": (balance, "v")}, "key")
