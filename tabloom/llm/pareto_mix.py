"""Mixing sources to target weights by Pareto order sampling. DataFrame functions only.

A source's target over its size is the number of copies its documents should
get on average. The whole part is certain: every document gets that many. The
rest is an inclusion probability p. Each document draws a uniform number u from
its id, and is ranked by its random odds over its inclusion odds,
(u / (1 - u)) / (p / (1 - p)); the smallest ranks are taken until their words
come nearest to what the source still lacks, so the sample has a fixed size.

No source is ever sorted as a whole. Ranks are mapped to (0, 1) and cut into
fine bins; bin sums give the bin in which a source's cut falls, only that bin's
rows are ordered, and the last taken rank is the source's threshold. Every
document's decision is then a function of its own row and its source's
threshold.

Cases: a null text has no words; a null source is a source of its own, ordered
last; a null document id draws one number for all such rows; ties in rank are
ordered by id and size, and rows that repeat id and size are decided alike (all
taken or all left), so that a decision needs nothing but the row; sources without words have target
zero; an empty table gives no rows; further columns are kept by ``mixed`` and
not read by ``plan_mix``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabloom.llm.measured import measured
from tabloom.plans.written import written

WORD = r"[^\x20\x09-\x0D]+"
BINS = 1 << 16
SEED = "mix"


def uniform(ident: Column, seed: str = SEED) -> Column:
    """A number in (0, 1) that depends on the id alone."""
    digits = F.substring(F.md5(F.concat(F.coalesce(ident.cast("string"), F.lit("")), F.lit(":" + seed)).cast("binary")), 1, 13)
    return (F.conv(digits, 16, 10).cast("double") + 0.5) / float(1 << 52)


def targets(sizes: DataFrame, weights: list[float], share: float, limit: float) -> DataFrame:
    """Targets of ``sizes(src, source_size)``: weights repeat along sources by code point, null last.

    A source's target stops at ``limit`` times its size; what it leaves is
    shared by weight among the rest, until none is above. That level is found
    in one pass over the sources ordered by limit over weight.
    """
    place = F.row_number().over(Window.orderBy(F.col("src").asc_nulls_last())) - 1
    w = F.element_at(F.array(*(F.lit(float(x)) for x in weights)), (place % len(weights) + 1).cast("int"))
    s = sizes.withColumn("w", w).withColumn("stop", F.col("source_size") * F.lit(float(limit)))
    by = Window.orderBy(F.col("stop") / F.col("w"), F.col("src").asc_nulls_last())
    before = by.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    s = s.withColumn("capped", F.coalesce(F.sum("stop").over(before), F.lit(0.0)))
    s = s.withColumn("open", F.sum("w").over(whole) - F.coalesce(F.sum("w").over(before), F.lit(0.0)))
    s = s.withColumn("total", F.sum("source_size").over(whole) * F.lit(float(share)))
    level = (F.col("total") - F.col("capped")) / F.col("open")
    s = s.withColumn("level", F.max(F.when(level * F.col("w") <= F.col("stop"), level)).over(whole))
    return s.select("src", "source_size", F.least("stop", F.coalesce(F.col("level") * F.col("w"), F.col("stop"))).alias("target"))


def _rank(u: Column, p: Column) -> Column:
    """Pareto rank mapped to (0, 1); one (never taken) where p is zero."""
    q = (u / (1 - u)) / (p / (1 - p))
    return F.when(p > 0, q / (1 + q)).otherwise(F.lit(1.0))


def _same(a: Column, b: Column) -> Column:
    return a.eqNullSafe(b)


def _narrow(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    size = F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long")
    return docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("src"), size.alias("size"))


def thresholds(
    rows: DataFrame, weights: list[float], share: float, limit: float, bins: int = BINS, seed: str = SEED
) -> DataFrame:
    """Per source: size, target, whole copies, inclusion probability, and the last rank taken.

    ``rows(doc_id, src, size)``. The result has one row per source.
    """
    sizes = rows.groupBy("src").agg(F.sum("size").alias("source_size"))
    t = targets(sizes, weights, share, limit)
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    t = t.withColumn("whole", F.floor(ratio).cast("long")).withColumn("p", ratio - F.col("whole"))
    t = written(t.withColumn("lack", F.col("target") - F.col("whole") * F.col("source_size")), "mix-targets")
    marked = _marked(rows, t.withColumnRenamed("src", "_src"), bins, seed)
    per_bin = marked.filter(F.col("p") > 0).groupBy("_src", "bin").agg(F.sum("size").alias("n"), F.max("lack").alias("lack"))
    upto = F.sum("n").over(Window.partitionBy("_src").orderBy("bin"))
    cut = per_bin.withColumn("upto", upto).filter(F.col("upto") >= F.col("lack"))
    cut = cut.groupBy("_src").agg(F.min(F.struct("bin", (F.col("upto") - F.col("n")).alias("base"))).alias("c"))
    cut = written(cut.select("_src", F.col("c.bin").alias("cut"), F.col("c.base").alias("base")), "mix-cuts")
    t = written(t.join(cut, _same(t["src"], cut["_src"]), "left").drop("_src"), "mix-targets")
    inside = _marked(rows, t.withColumnRenamed("src", "_src"), bins, seed).filter(F.col("bin") == F.col("cut"))
    # rows that repeat id and size share a rank and are decided together
    inside = inside.groupBy("_src", "rank", "ident", "size").agg(F.count(F.lit(1)).alias("rows"), F.max("base").alias("base"), F.max("lack").alias("lack"))
    inside = inside.withColumn("n", F.col("rows") * F.col("size"))
    upto = F.col("base") + F.sum("n").over(Window.partitionBy("_src").orderBy("rank", "ident", "size"))
    taken = inside.withColumn("mid", upto - F.col("n") / 2).filter(F.col("mid") < F.col("lack"))
    last = taken.groupBy("_src").agg(F.max(F.struct("rank", "ident", "size")).alias("last"))
    last = written(last, "mix-last")
    return t.join(last, _same(t["src"], last["_src"]), "left").drop("_src")


def _marked(rows: DataFrame, per_source: DataFrame, bins: int, seed: str) -> DataFrame:
    """Rows with their source's columns (a written table), their rank and its bin."""
    both = rows.join(measured(per_source), _same(F.col("src"), F.col("_src")))
    both = both.withColumn("rank", _rank(uniform(F.col("doc_id"), seed), F.col("p")))
    ident = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    return both.withColumn("ident", ident).withColumn("bin", F.floor(F.col("rank") * bins))


def _copies() -> Column:
    rank = F.struct("rank", "ident", "size")
    inside = (F.col("bin") == F.col("cut")) & F.coalesce(rank <= F.col("last"), F.lit(False))
    chosen = (F.col("p") > 0) & (F.col("cut").isNull() | (F.col("bin") < F.col("cut")) | inside)
    return F.col("whole") + F.when(chosen, 1).otherwise(0)


def plan_mix(
    docs: DataFrame, weights: list[float], share: float = 1.5, limit: float = 2.0, *, id_col: str = "doc_id",
    text_col: str = "text", source_col: str = "source", bins: int = BINS, seed: str = SEED,
) -> DataFrame:
    """Every document's size, its source's size and target, and the words the mix takes of it."""
    rows = written(_narrow(docs, id_col, text_col, source_col), "mix-rows")
    per_source = written(thresholds(rows, weights, share, limit, bins, seed), "mix-thresholds")
    out = _marked(rows, per_source.withColumnRenamed("src", "_src"), bins, seed)
    return out.select("doc_id", "size", "source_size", "target", (_copies() * F.col("size")).alias("taken"))


def mixed(
    docs: DataFrame, weights: list[float], share: float = 1.5, limit: float = 2.0, *, id_col: str = "doc_id",
    text_col: str = "text", source_col: str = "source", bins: int = BINS, seed: str = SEED,
) -> DataFrame:
    """The mix itself: each document's row as often as the mix takes it. Texts are not shuffled."""
    names = docs.columns
    rows = written(_narrow(docs, id_col, text_col, source_col), "mix-rows")
    per_source = written(thresholds(rows, weights, share, limit, bins, seed), "mix-thresholds")
    packed = docs.select(F.struct(*names).alias("row"), F.col(id_col).alias("doc_id"), F.col(source_col).alias("src"))
    size = F.coalesce(F.regexp_count(F.col(f"row.{text_col}"), F.lit(WORD)), F.lit(0)).cast("long")
    out = _marked(packed.withColumn("size", size), per_source.withColumnRenamed("src", "_src"), bins, seed)
    out = out.select("row", _copies().alias("copies")).filter(F.col("copies") > 0)
    once = out.select("row", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"))
    return once.select("row.*")


ORACLE = r"""
WITH r AS (SELECT doc_id, source AS src, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
        ((('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':mix'), 1, 13))::BIGINT)::DOUBLE + 0.5) / 4503599627370496.0 AS u
    FROM documents),
s0 AS (SELECT src, CAST(sum(size) AS BIGINT) AS source_size FROM r GROUP BY src),
s1 AS (SELECT src, source_size, CASE (row_number() OVER (ORDER BY src COLLATE "C" NULLS LAST) - 1) % 3 WHEN 0 THEN 3.0::DOUBLE WHEN 1 THEN 1.0 ELSE 2.0 END AS w FROM s0),
s2 AS (SELECT *, source_size * 2.0::DOUBLE AS stop FROM s1),
s3 AS (SELECT *, coalesce(sum(stop) OVER before, 0) AS capped, sum(w) OVER () - coalesce(sum(w) OVER before, 0) AS open, sum(source_size) OVER () * 1.5::DOUBLE AS total
    FROM s2 WINDOW before AS (ORDER BY stop / w, src COLLATE "C" NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
s4 AS (SELECT *, max(CASE WHEN (total - capped) / open * w <= stop THEN (total - capped) / open END) OVER () AS level FROM s3),
s5 AS (SELECT src, source_size, least(stop, coalesce(level * w, stop)) AS target FROM s4),
s6 AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS whole FROM s5),
s7 AS (SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END - whole AS p, target - whole * source_size AS lack FROM s6),
j AS (SELECT r.*, source_size, target, whole, p, lack FROM r JOIN s7 ON r.src IS NOT DISTINCT FROM s7.src),
q AS (SELECT *, CASE WHEN p > 0 THEN ((u / (1 - u)) / (p / (1 - p))) / (1 + (u / (1 - u)) / (p / (1 - p))) ELSE 1 END AS rnk, coalesce(CAST(doc_id AS VARCHAR), '') AS ident FROM j),
g AS (SELECT src, rnk, ident, size, sum(size) AS n FROM q GROUP BY ALL),
c AS (SELECT *, sum(n) OVER (PARTITION BY src ORDER BY rnk, ident COLLATE "C", size) - n / 2 AS mid FROM g)
SELECT q.doc_id, CAST(q.size AS BIGINT) AS size, q.source_size, q.target,
    CAST((q.whole + CASE WHEN q.p > 0 AND c.mid < q.lack THEN 1 ELSE 0 END) * q.size AS BIGINT) AS taken
FROM q JOIN c ON q.src IS NOT DISTINCT FROM c.src AND q.rnk = c.rnk AND q.ident = c.ident AND q.size = c.size
"""
