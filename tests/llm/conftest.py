import pytest
from pyspark.sql import types as T

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()), T.StructField("part", T.IntegerType()),
    T.StructField("size", T.StringType()), T.StructField("score", T.StringType()),
])


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents from (doc_id, text) or (doc_id, text, source) rows, with further columns whose names operators use themselves."""

    def make(rows, parts=3):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "a", len(r[1] or ""), 7, "x", "y") for r in rows]
        return spark.createDataFrame(full, DOCS).repartition(parts)

    return make
