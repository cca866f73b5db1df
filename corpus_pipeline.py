"""A training-data pipeline: every stage's rows are written and reread as the next one's documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tabloom.llm.queries import MIX, table, tokenizer_path
from tabloom.plans.written import written


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose restored text scores below the threshold."""
    from tabloom.llm.toxicity import without_toxic

    return without_toxic(docs, table(spark, sf_dir, "labels"))


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of texts linked by SimHash (3-word shingles, 3 differing bits at most), the document with the smallest id."""
    from tabloom.llm.simhash_bk import near_duplicates, one_of_each

    return one_of_each(docs, near_duplicates(docs, radius=3, width=3, seed=42))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    from tabloom.llm.decontaminate import remove_documents

    return remove_documents(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it: left out, once or twice."""
    from tabloom.llm.pareto_mix import mixed

    return mixed(docs, *MIX)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Encode what is left into bit-plane files and read them back."""
    from tabloom.llm.bitplane import encode_documents

    return encode_documents(docs, tokenizer_path(), end_id=2)


STAGES = [
    ("toxicity", reject_toxic),
    ("near_duplicates", one_of_near_copies),
    ("decontamination", decontaminate),
    ("mix", mix_sources),
    ("token_ids", token_ids),
]

#: Scores, fingerprints and token ids are not expressible in SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
