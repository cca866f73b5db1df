"""One query per operator over its whole table, with production parameters, and the SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path() -> str:
    """The public word-level vocabulary; a parameter of the operators."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@query("op3_bitplane_ids")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tabloom.llm.bitplane import encode_documents

    return encode_documents(table(spark, sf_dir, "documents"), tokenizer_path(), end_id=2)


@query("op4_simhash_bk")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tabloom.llm.simhash_bk import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"), radius=3, width=3, seed=42)


def _op8_sql() -> str:
    from tabloom.llm.decontaminate import ORACLE

    return ORACLE


@query("op8_ngram_decontamination", _op8_sql())
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tabloom.llm.decontaminate import report

    return report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), width=10)


#: Weights that repeat along the sources, share of all sizes, and the stop in copies.
MIX = ([3.0, 1.0, 2.0], 1.5, 2.0)


def _op7_sql() -> str:
    from tabloom.llm.pareto_mix import ORACLE

    return ORACLE


@query("op7_pareto_mix", _op7_sql())
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tabloom.llm.pareto_mix import plan_mix

    return plan_mix(table(spark, sf_dir, "documents"), *MIX)


@query("op1_deobfuscated_toxicity")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tabloom.llm.toxicity import toxicity

    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op6_byte_shards")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tabloom.llm.sharding import balanced_shards

    return balanced_shards(table(spark, sf_dir, "documents"), shards=8)


def _op2_sql() -> str:
    from tabloom.llm.warc import ORACLE

    return ORACLE


@query("op2_warc_members", _op2_sql())
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tabloom.llm.warc import archived

    return archived(table(spark, sf_dir, "pages"), least_bytes=0)


@query("op10_html_blocks")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tabloom.llm.html_labeller import extract

    return extract(table(spark, sf_dir, "pages"))


@query("op9_permutation_index")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from tabloom.llm.permutation_index import nearest

    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


@query("op5_bootstrapped_pii")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tabloom.llm.pii_bootstrap import personal_data

    return personal_data(table(spark, sf_dir, "documents"))


@query("op11_periodic_runs")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from tabloom.llm.periodic_runs import listing, longest, periodic_runs, with_repeated_tails

    found = periodic_runs(with_repeated_tails(table(spark, sf_dir, "documents")), least=6, exponent=4, collapsed="sha256")
    found = found.withColumn("best", longest(F.col("runs")))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(listing(F.col("runs")).cast("binary"), 256).alias("runs_sha256"), F.col("collapsed").alias("collapsed_sha256"),
    )


@query("op12_whitening")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tabloom.llm.whitening import whitened

    return whitened(table(spark, sf_dir, "embeddings"), components=8, scale=1024, offset=100_000)


def _op13_sql() -> str:
    from tabloom.llm.mtree import ORACLE

    return ORACLE


@query("op13_mtree", _op13_sql())
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from tabloom.llm.mtree import top_products

    return top_products(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20, scale=64)
