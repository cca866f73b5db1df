"""Scalar functions over whole columns."""

from pyspark.sql import functions as F

from tabloom.functions import arrays, numeric, predicates, text, times
from tabloom.queries.registry import Tables, query, rounded


@query("x1_lower", "select p_partkey, lower(p_type) as v from part")
def x1(t: Tables):
    return t.part.select("p_partkey", text.lower(F.col("p_type")).alias("v"))


@query(
    "x2_replace_trim_slice_split_join",
    """
    select c_custkey, replace(c_name, '#', ' ') as replaced, trim('  ' || c_name || ' ') as trimmed, c_name[:-5] as cut,
      string_split(c_name, '#')[2] as second, c_mktsegment || '/' || c_name as joined from customer
    """,
)
def x2(t: Tables):
    name = F.col("c_name")
    return t.customer.select(
        "c_custkey",
        F.replace(name, F.lit("#"), F.lit(" ")).alias("replaced"),
        F.trim(F.concat(F.lit("  "), name, F.lit(" "))).alias("trimmed"),
        text.cut_tail(name, 4).alias("cut"),
        F.get(F.split(name, "#"), F.lit(1)).alias("second"),
        text.join_fields("/", F.col("c_mktsegment"), name).alias("joined"),
    )


@query(
    "x3_remove_chars",
    """select doc_id, md5(translate(translate(text, '.,"!?:;\\''`', ''), chr(9), ' ')) as digest from documents""",
)
def x3(t: Tables):
    return t.documents.select("doc_id", F.md5(text.remove_chars(F.col("text")).cast("binary")).alias("digest"))


@query("x4_contains", "select page_id, contains(html, 'class=') as v from pages")
def x4(t: Tables):
    return t.pages.select("page_id", predicates.has_text(F.col("html"), "class=").alias("v"))


@query(
    "x5_levenshtein",
    "select p_partkey, levenshtein(p_name, p_brand) as dist, round(1 - levenshtein(p_name, p_brand) / greatest(length(p_name), length(p_brand)), 9) as sim from part",
)
def x5(t: Tables):
    a, b = F.col("p_name"), F.col("p_brand")
    out = t.part.select("p_partkey", F.levenshtein(a, b).cast("long").alias("dist"), text.similarity(a, b).alias("sim"))
    return rounded(out, 9)


@query("x6_abs", "select c_custkey, round(abs(c_acctbal - 5000), 6) as v from customer")
def x6(t: Tables):
    return rounded(t.customer.select("c_custkey", numeric.absolute(F.col("c_acctbal") - 5000).alias("v")))


@query(
    "x7_log",
    """
    select event_id, round(case when value > 0 then ln(value) end, 9) as ln, round(case when value > -1 then ln(1 + value) end, 9) as log1p from events
    """,
)
def x7(t: Tables):
    v = F.col("value")
    return rounded(t.events.select("event_id", numeric.log(v).alias("ln"), numeric.log1p(v).alias("log1p")), 9)


@query("x8_round_even", "select l_orderkey, l_partkey, l_suppkey, l_linenumber, round_even(l_quantity / 2, 0) as v from lineitem")
def x8(t: Tables):
    return t.lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", numeric.round_even(F.col("l_quantity") / 2).alias("v"))


@query(
    "x9_weekday_month_year",
    "select event_id, (isodow(ts) - 1)::int as weekday, month(ts)::int as month, year(ts)::int as year, dayname(ts) as name from events",
)
def x9(t: Tables):
    ts = F.col("ts")
    return t.events.select(
        "event_id", times.weekday(ts).alias("weekday"), times.month(ts).alias("month"), times.year(ts).alias("year"),
        times.weekday_name(ts).alias("name"),
    )


@query(
    "x10_parse_timestamp",
    "select event_id, date_trunc('second', ts) as plain, date_trunc('second', ts) - interval 3 hour as shifted, null::timestamp as bad from events",
)
def x10(t: Tables):
    plain = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    return t.events.select(
        "event_id",
        times.parse(plain, "yyyy-MM-dd'T'HH:mm:ss").cast("timestamp_ntz").alias("plain"),
        times.parse(F.concat(plain, F.lit("+03:00"))).cast("timestamp_ntz").alias("shifted"),
        times.parse(F.col("event_type"), "yyyy").cast("timestamp_ntz").alias("bad"),
    )


@query(
    "x11_epoch_and_months",
    """
    select o_orderkey, epoch(o_orderdate)::bigint as seconds, (o_orderdate::date - interval 2 month)::date as back,
      (o_orderdate::date + interval 1 month)::date as ahead from orders
    """,
)
def x11(t: Tables):
    d = F.col("o_orderdate")
    return t.orders.select(
        "o_orderkey", times.epoch(d).alias("seconds"), times.shift_months(d.cast("date"), -2).alias("back"),
        times.shift_months(d.cast("date"), 1).alias("ahead"),
    )


@query(
    "x12_arrays",
    """
    select p_type, sum(len(string_split(p_name, ' ')))::bigint as words, string_agg(distinct p_brand, ',' order by p_brand) as brands
    from part group by p_type
    """,
)
def x12(t: Tables):
    parts = t.part.withColumn("w", F.split("p_name", " "))
    words = parts.groupBy("p_type").agg(F.sum(arrays.size(F.col("w")).cast("long")).alias("words"))
    # distinct first: a list holds each brand once, of which there are few
    brands = t.part.select("p_type", "p_brand").distinct().groupBy("p_type").agg(
        F.concat_ws(",", arrays.sorted_list(F.collect_list("p_brand"))).alias("brands")
    )
    return words.join(brands, "p_type")


@query("x12_explode", "select w, count(*) as n from (select unnest(string_split(p_name, ' ')) as w from part) group by w")
def x12_explode(t: Tables):
    return t.part.select(F.explode(F.split("p_name", " ")).alias("w")).groupBy("w").agg(F.count(F.lit(1)).alias("n"))


@query("x13_nested_fields", "select p_partkey, p_size as size, case when p_type = 'SMALL' then p_brand end as brand from part")
def x13(t: Tables):
    nested = t.part.select(
        "p_partkey",
        F.struct(F.struct(F.col("p_size").alias("size")).alias("info")).alias("doc"),
        F.array(F.struct(F.col("p_type").alias("kind"), F.col("p_brand").alias("brand"))).alias("items"),
    )
    return nested.select(
        "p_partkey", F.col("doc.info.size").alias("size"),
        arrays.first_match(F.col("items"), "kind", "SMALL")["brand"].alias("brand"),
    )


@query(
    "x14_conditional",
    """
    select doc_id, coalesce(quality, -1) as q, case when toxic = 1 then 'toxic' when quality = 1 then 'good' else '' end as kind
    from documents left join labels using (doc_id)
    """,
)
def x14(t: Tables):
    joined = t.documents.select("doc_id").join(t.labels, "doc_id", "left")
    kind = F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 1, "good").otherwise("")
    return joined.select("doc_id", arrays.if_null(F.col("quality"), -1).alias("q"), kind.alias("kind"))


@query("x15_availability_flag", "select o_orderkey, (o_orderstatus = 'O')::int as available from orders")
def x15(t: Tables):
    return t.orders.select("o_orderkey", predicates.flag_equal(F.col("o_orderstatus"), "O").alias("available"))
