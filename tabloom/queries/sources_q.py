"""Sources and sinks: write, read back, compare with the table itself."""

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import functions as F

from tabloom.operators.words import word_count
from tabloom.queries.registry import Tables, query
from tabloom.session import shared_dir
from tabloom.sources import (
    flatten, from_payload, names_by_status, nested_lookup, read_delimited, read_lines, read_many, read_parquet,
    read_table, write_csv, write_json, write_parquet, write_text,
)

CUSTOMER = "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
WORDS = """
select word, count(*) as num from (
  select unnest(regexp_split_to_array(translate(translate(lower(text), '.,"!?:;\\''`', ''), chr(9), ' '), '\\s+')) as word
  from documents) where word <> '' group by word
"""


@query("s1_read_csv", "select * from customer")
def s1(t: Tables):
    path = shared_dir(t.spark, "customer-csv")
    t.customer.write.csv(path, header=True)
    return read_table(t.spark, path, "csv", CUSTOMER)


@query("s2_read_delimited_decimal_comma", "select p_partkey, p_name, p_size, p_retailprice from part")
def s2(t: Tables):
    path = shared_dir(t.spark, "part-semicolon")
    price = F.replace(F.col("p_retailprice").cast("string"), F.lit("."), F.lit(","))
    t.part.select("p_partkey", "p_name", "p_size", price.alias("p_retailprice")).write.csv(path, header=True, sep=";")
    return read_delimited(t.spark, path, "p_partkey bigint, p_name string, p_size int, p_retailprice double")


@query(
    "s2_read_delimited_tab",
    "select s_suppkey, s_name, s_acctbal from supplier",
)
def s2_tab(t: Tables):
    path = shared_dir(t.spark, "supplier-tab")
    t.supplier.select("s_suppkey", "s_name", "s_acctbal").write.csv(path, header=True, sep="\t")
    return read_delimited(t.spark, path, "s_suppkey bigint, s_name string, s_acctbal double", sep="\t", decimal=".")


@query(
    "s3_read_lines",
    """
    select length(line) as chars, count(*) as lines from (
      select unnest(string_split(text, chr(10))) as line from documents) group by 1
    """,
)
def s3(t: Tables):
    path = shared_dir(t.spark, "documents-text")
    write_text(t.documents, path, ["text"])
    lines = read_lines(t.spark, path)
    return lines.groupBy(F.length("value").cast("long").alias("chars")).agg(F.count(F.lit(1)).alias("lines"))


@query("s4_read_parquet", "select o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority from orders")
def s4(t: Tables):
    return read_parquet(t.spark, f"{t.sf_dir}/orders.parquet")


def _with_preamble(lines: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield pd.DataFrame({"value": ["Exported table"] * lines + ["key,balance"]})
        yield from batches

    return run


@query("s5_read_many", "select s_suppkey as key, s_acctbal as balance from supplier union all select c_custkey, c_acctbal from customer")
def s5(t: Tables):
    groups = []
    for df, key, bal, skip in [(t.supplier, "s_suppkey", "s_acctbal", 0), (t.customer, "c_custkey", "c_acctbal", 2)]:
        path = shared_dir(t.spark, "offset-header")
        lines = df.repartition(3, key).select(F.concat_ws(",", F.col(key).cast("string"), F.col(bal).cast("string")).alias("value"))
        lines.mapInPandas(_with_preamble(skip), "value string").write.text(path)
        groups.append((path, skip))
    return read_many(t.spark, groups, "key bigint, balance double")


def _part_payload(t: Tables):
    record = F.array(
        F.struct(F.col("p_name").alias("name"), F.col("p_size").alias("n")),
        F.struct(F.col("p_brand").alias("name"), (F.col("p_size") * 2).alias("n")),
    )
    body = F.to_json(F.struct(F.struct(F.col("p_partkey").alias("page")).alias("info"), record.alias("results")))
    empty = F.to_json(F.struct(F.struct(F.col("p_partkey").alias("page")).alias("info")))
    return t.part.select("p_partkey", F.when(F.col("p_size") <= 40, body).otherwise(empty).alias("payload"))


@query(
    "s6_from_payload",
    """
    select p_partkey, p_name as name, p_size as n from part where p_size <= 40
    union all select p_partkey, p_brand, p_size * 2 from part where p_size <= 40
    """,
)
def s6(t: Tables):
    return from_payload(_part_payload(t), "payload", "$.results", "name string, n int", ["p_partkey"])


@query(
    "s6_from_payload_second_element",
    "select event_id, (props ->> '$.k')::int as k, event_type as kind from events",
)
def s6_second(t: Tables):
    rows = F.array(F.struct(F.get_json_object("props", "$.k").cast("int").alias("k"), F.col("event_type").alias("kind")))
    body = F.concat(F.lit('[{"page":1},'), F.to_json(rows), F.lit("]"))
    return from_payload(t.events.select("event_id", body.alias("payload")), "payload", "$[1]", "k int, kind string", ["event_id"])


@query("k1_write_csv", "select s_suppkey, s_name from supplier")
def k1(t: Tables):
    path = shared_dir(t.spark, "supplier-csv")
    write_csv(t.supplier, path, ["s_suppkey", "s_name"])
    return read_table(t.spark, path, "csv", "s_suppkey bigint, s_name string")


@query("k2_write_text", f"select word || chr(9) || num::varchar as value from ({WORDS})")
def k2(t: Tables):
    path = shared_dir(t.spark, "word-counts-text")
    write_text(word_count(t.dealt("documents"), "text"), path)
    return read_lines(t.spark, path)


@query("k3_write_parquet", f"select word, num from ({WORDS})")
def k3(t: Tables):
    path = shared_dir(t.spark, "word-counts")
    write_parquet(word_count(t.dealt("documents"), "text").orderBy(F.desc("num"), "word"), path)
    return read_parquet(t.spark, path)


@query("k4_write_json", "select event_id, ts, user_id, event_type, value, props from events")
def k4(t: Tables):
    path = shared_dir(t.spark, "events-json")
    write_json(t.events, path)
    return read_table(
        t.spark, path, "json", "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
        timestampNTZFormat="yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
    )


@query("h6_flatten", "select p_partkey as page, p_name as first_name, p_size as first_n from part where p_size <= 40")
def h6(t: Tables):
    parsed = _part_payload(t).select(
        F.from_json("payload", "info struct<page: bigint>, results array<struct<name: string, n: int>>").alias("p")
    ).filter("p.results is not null").select(F.col("p.info").alias("info"), F.col("p.results")[0].alias("head"))
    return flatten(parsed, {"page": "info.page", "first_name": "head.name", "first_n": "head.n"})


@query("h7_names_by_status", "select c_name from customer where c_mktsegment = 'MACHINERY'")
def h7(t: Tables):
    allowed = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
    return names_by_status(t.customer, "MACHINERY", allowed, "c_mktsegment", "c_name")


@query(
    "h8_nested_lookup",
    """
    select p_partkey, case when p_type = 'ECONOMY' and p_brand = 'Brand#7' then p_size::varchar end as id from part
    """,
)
def h8(t: Tables):
    areas = F.array(
        F.struct(F.lit("none").alias("name"), F.lit("0").alias("id")),
        F.struct(F.col("p_brand").alias("name"), F.col("p_size").cast("string").alias("id")),
    )
    payload = t.part.select("p_partkey", F.array(F.struct(F.col("p_type").alias("name"), areas.alias("areas"))).alias("tree"))
    return nested_lookup(payload, "tree", "ECONOMY", "Brand#7").select("p_partkey", "id")
