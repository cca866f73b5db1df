"""Benchmark decontamination by a hash set of normalised test n-grams. DataFrame functions only.

Test items and training texts are lower-cased (A-Z) and cut into words. Every
run of ``width`` words of an item is a window; an item of fewer words is one
window. Words are hashed once, and a window's hash is taken from its words' hashes.
Training windows of the lengths that occur are looked up in the set of test
window hashes; a window's words are put together only for what is found, and
joined with the test windows' words, so equality verifies every hit. A hash set measured to be
small is broadcast and the texts do not move; a larger one is joined by shuffle,
without the texts, and the texts with findings are read again.

Cases: a null text has no words and is clean; a null item text gives no window;
a null item id is written as the empty string; repeated items count once;
repeated rows of documents each get their own result; a null document id is
kept; empty tables give no hits or no rows; further columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloom.llm.files import free_name
from tabloom.llm.measured import measured
from tabloom.plans.written import written

#: Test windows whose hashes are broadcast: 8 bytes each.
MAX_KEYS = 1_000_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: A word of the raw text with what follows it up to the next word.
PIECE = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*"
BEFORE = r"^[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*"


def words(text: Column) -> Column:
    return F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), F.lit(WORD), F.lit(0))


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Documents with a key that repeated rows share: ``k`` (id) and ``h`` (hash of id and text)."""
    text, ident = F.col(text_col), F.col(id_col)
    return docs.select(
        ident.alias("doc_id"), F.coalesce(ident.cast("string"), F.lit("")).alias("k"), F.xxhash64(ident, text).alias("h"), words(text).alias("w")
    )


def test_windows(items: DataFrame, width: int = 10, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """``window`` (words joined by a blank), its number of words ``n``, and the sorted ids of its items."""
    w = items.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("item"), words(F.col(text_col)).alias("w"))
    w = w.filter(F.size("w") > 0).withColumn("n", F.least(F.size("w"), F.lit(width)))
    starts = F.sequence(F.lit(1), F.size("w") - F.col("n") + 1)
    each = w.select("item", "n", F.explode(F.transform(starts, lambda i: F.array_join(F.slice("w", i, F.col("n")), " "))).alias("window"))
    return each.groupBy("window", "n").agg(F.collect_set("item").alias("items"))


def _hashed(w: Column, i: Column, n: Column | int) -> Column:
    """Hash of n words from place i on (0-based), from the hashes of the words."""
    return F.xxhash64(F.slice(w, i + 1, n))


def _word_hashes(w: Column) -> Column:
    return F.transform(w, lambda x: F.xxhash64(x))


NONE = "array<struct<at:int,n:int,g:bigint>>"


def seen(docs: DataFrame, tests: DataFrame, id_col: str, text_col: str, with_rows: bool) -> DataFrame:
    """A written table of the windows found by hash: ``k, h, at, n, window``; with ``with_rows`` also a row per document (at -1) with ``doc_id`` and ``n_words``."""
    lengths = sorted(r["n"] for r in tests.select("n").distinct().collect())  # at most ``width`` rows
    keys = written(tests.select(_hashed(_word_hashes(F.split("window", " ")), F.lit(0), F.col("n")).alias("g")).distinct(), "test-hashes")
    small = measured(keys, MAX_KEYS) is not keys
    every = _keyed(docs, id_col, text_col).withColumn("hw", _word_hashes(F.col("w")))

    def windows(n: int) -> Column:
        starts = F.sequence(F.lit(0), F.size("hw") - n)
        return F.when(F.size("hw") >= n, F.transform(starts, lambda i: F.struct(i.alias("at"), F.lit(n).alias("n"), _hashed(F.col("hw"), i, n).alias("g"))))

    empty = F.array().cast(NONE)
    parts = [F.coalesce(windows(n).cast(NONE), empty) for n in lengths]
    here = F.array(F.struct(F.lit(-1).alias("at"), F.lit(0).alias("n"), F.lit(None).cast("long").alias("g"))).cast(NONE)
    window = F.array_join(F.slice("w", F.greatest(F.col("at"), F.lit(0)) + 1, F.col("n")), " ")
    out = ["k", "h", "at", "n", F.when(F.col("at") >= 0, window).alias("window"), F.when(F.col("at") < 0, F.col("doc_id")).alias("doc_id"), F.when(F.col("at") < 0, F.size("w").cast("long")).alias("n_words")]
    # the outer form: of a plain explode the optimizer infers a filter on the array's size, and makes the windows twice
    if small:
        each = every.withColumn("x", F.concat(*([here] if with_rows else []), *parts, empty)).select("doc_id", "k", "h", "w", F.explode_outer("x").alias("x")).select("doc_id", "k", "h", "w", "x.*")
        found = each.join(F.broadcast(keys.withColumn("hit", F.lit(True))), "g", "left").filter(F.col("hit") | (F.col("at") < 0))
        return written(found.select(*out), "test-seen")
    each = every.withColumn("x", F.concat(*parts, empty)).select("k", "h", F.explode_outer("x").alias("x")).select("k", "h", "x.*")
    places = each.join(keys, "g").groupBy("k", "h").agg(F.collect_set(F.struct("at", "n")).alias("x"))
    again = _keyed(docs, id_col, text_col).dropDuplicates(["k", "h"]).join(places, ["k", "h"]).select("doc_id", "k", "h", "w", F.inline("x"))
    rows = _keyed(docs, id_col, text_col).withColumns({"at": F.lit(-1), "n": F.lit(0)}).select(*again.columns)
    return written((again.unionByName(rows) if with_rows else again).select(*out), "test-seen")


def _spans(found: DataFrame, tests: DataFrame) -> DataFrame:
    """Per document with hits: key, ``spans`` (first word, word after the last; sorted) and ``items``."""
    both = found.filter("at >= 0").select("k", "h", "at", "n", "window").join(measured(tests).select("window", "items"), "window")
    span = F.struct(F.col("at").alias("at"), (F.col("at") + F.col("n")).alias("end"))
    return both.groupBy("k", "h").agg(
        F.array_sort(F.collect_set(span)).alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items")
    )


def hits(docs: DataFrame, items: DataFrame, width: int = 10, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document with hits: key, ``spans`` (first word, word after the last; sorted) and ``items``."""
    tests = written(test_windows(items, width), "test-windows")
    return _spans(seen(docs, tests, id_col, text_col, with_rows=False), tests)


def covered(spans: Column) -> Column:
    """Number of words inside the union of sorted spans."""
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("upto"))

    def add(acc, s):
        new = F.greatest(F.lit(0), s["end"] - F.greatest(acc["upto"], s["at"]))
        return F.struct((acc["n"] + new).alias("n"), F.greatest(acc["upto"], s["end"]).alias("upto"))

    return F.aggregate(spans, start, add, lambda acc: acc["n"])


def report(docs: DataFrame, items: DataFrame, width: int = 10, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: words, hit words, test items, checksum of the item ids, verdict."""
    tests = written(test_windows(items, width), "test-windows")
    rows = seen(docs, tests, id_col, text_col, with_rows=True)
    found = _spans(rows, tests)
    both = rows.filter("at < 0").select("doc_id", "k", "h", "n_words").join(found, ["k", "h"], "left")
    n_hit = F.coalesce(covered(F.col("spans")), F.lit(0).cast("long"))
    return both.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
        F.sha2(F.coalesce(F.array_join("items", ","), F.lit("")).cast("binary"), 256).alias("items_sha256"), F.col("spans").isNotNull().alias("contaminated"),
    )


def remove_documents(docs: DataFrame, items: DataFrame, width: int = 10, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Documents without hits, all columns as they were."""
    k, h = free_name(docs, "_k"), free_name(docs, "_h")
    found = hits(docs, items, width, id_col, text_col).select(F.col("k").alias(k), F.col("h").alias(h))
    bad = measured(written(found, "test-hits"))
    key = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    return docs.join(bad, (key == F.col(k)) & (F.xxhash64(F.col(id_col), F.col(text_col)) == F.col(h)), "left_anti")


def remove_spans(docs: DataFrame, items: DataFrame, width: int = 10, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All documents; hit words, with the separators after them, are cut out of the text."""
    k, h, spans = (free_name(docs, name) for name in ("_k", "_h", "_spans"))
    bad = hits(docs, items, width, id_col, text_col).select(F.col("k").alias(k), F.col("h").alias(h), F.col("spans").alias(spans))
    key = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    both = docs.join(bad, (key == F.col(k)) & (F.xxhash64(F.col(id_col), F.col(text_col)) == F.col(h)), "left")
    pieces = F.regexp_extract_all(F.col(text_col), F.lit(PIECE), F.lit(0))
    kept = F.filter(pieces, lambda p, i: ~F.exists(spans, lambda s: (i >= s["at"]) & (i < s["end"])))
    cut = F.concat(F.regexp_extract(F.col(text_col), BEFORE, 0), F.array_join(kept, ""))
    return both.withColumn(text_col, F.when(F.col(spans).isNull(), F.col(text_col)).otherwise(cut)).select(*docs.columns)


ORACLE = r"""
WITH w AS (SELECT rowid_ AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM (SELECT row_number() OVER () AS rowid_, doc_id, text FROM documents)),
b AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (SELECT DISTINCT item, least(len(w), 10) AS n, array_to_string(w[i : i + least(len(w), 10) - 1], ' ') AS win
    FROM (SELECT item, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM b WHERE len(w) > 0)),
lens AS (SELECT DISTINCT n FROM bw),
dw AS (SELECT r, n, i, array_to_string(w[i : i + n - 1], ' ') AS win
    FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM w, lens WHERE len(w) >= n)),
h AS (SELECT r, i, dw.n AS n, item FROM dw JOIN bw ON dw.win = bw.win AND dw.n = bw.n),
p AS (SELECT r, count(DISTINCT pos) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS pos FROM (SELECT DISTINCT r, i, n FROM h)) GROUP BY r),
t AS (SELECT r, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item COLLATE "C")) AS s FROM (SELECT DISTINCT r, item FROM h) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
    coalesce(s, sha256('')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM w LEFT JOIN p USING (r) LEFT JOIN t USING (r)
"""
