"""Hand-computed answers for nulls, ties, rounding, gaps and fan-out."""

import pytest
from pyspark.sql import functions as F

from tabloom.functions import numeric, text
from tabloom.operators import aggregate, filters, joins, missing, profile, ranking, repair, sets, shape, stats, words
from tabloom.plans import exact_quantiles


def column(df, name):
    return [r[name] for r in df.collect()]


def numbers(spark, values, name="x"):
    return spark.createDataFrame([(i, None if v is None else float(v)) for i, v in enumerate(values)], f"i int, {name} double")


def test_not_in_keeps_null(spark):
    df = spark.createDataFrame([("a",), (None,), ("b",), ("c",)], "x string")
    assert filters.keep_not_in(df, "x", ["a"]).count() == 3
    assert filters.keep_not_in(df, "x", ["a"] + [f"v{i}" for i in range(300)]).count() == 3
    assert filters.keep_in(df, "x", ["a", "b"]).count() == 2


def test_half_even_and_truncation(spark):
    df = numbers(spark, [0.5, 1.5, 2.5, -2.7])
    assert column(df.select(numeric.round_even(F.col("x")).alias("r")), "r")[:3] == [0, 2, 2]
    assert column(df.select(numeric.truncate(F.col("x")).alias("r")), "r")[3] == -2
    assert column(shape.convert(df, {"x": "int"}), "x")[3] == -2


def test_median_and_skewness(spark):
    df = numbers(spark, [1, 2, 2.5, 10, None])
    assert exact_quantiles(df, "x", [0.5]).first().quantiles == [2.25]
    assert stats.sample_skewness(df, ["x"]).first().skewness == pytest.approx(1.861795, abs=1e-5)


@pytest.mark.parametrize(
    "given,want",
    [
        ([10, None, None, None, 20], [10, 10, 10, 15, 20]),
        ([None, None, 4], [None, 4, 4]),
        ([4, None, None], [4, 4, 4]),
    ],
)
@pytest.mark.parametrize("hot_rows", [0, 10**9])
def test_fill_neighbours(spark, given, want, hot_rows):
    df = numbers(spark, given).withColumn("k", F.lit(1))
    out = missing.fill_neighbours(df, ["k"], "i", "i", ["x"], hot_rows).orderBy("i")
    assert column(out, "x") == want


@pytest.mark.parametrize("keys", [[], ["k"]])
def test_interpolate(spark, keys):
    df = numbers(spark, [None, 2, None, None, 8, None]).withColumn("k", F.lit(1))
    assert column(missing.interpolate_linear(df, keys, "i", "i", ["x"]).orderBy("i"), "x") == [None, 2, 4, 6, 8, 8]


def test_fill_never_changes_given_cells(spark):
    df = numbers(spark, [5, None, 7, None, None, 1]).withColumn("k", F.col("i") % 2)
    for out in (
        missing.fill_median(df, "x"),
        missing.fill_group_median(df, "x", "k"),
        missing.fill_neighbours(df, ["k"], "i", "i", ["x"]),
    ):
        got = {r.i: r.x for r in out.collect()}
        assert (got[0], got[2], got[5]) == (5, 7, 1)


def test_group_median_with_null_key(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", None), (None, None), ("b", None)], "k string, x double")
    got = sorted((r.k or "", r.x is None) for r in missing.fill_group_median(df, "x", "k").collect())
    assert got == [("", True), ("a", False), ("a", False), ("b", True)]


def test_bucket_edges(spark):
    df = spark.createDataFrame([(30000,), (30001,), (-1,)], "x int")
    edges = [(0, 30000), (30001, 50000), (50001, None)]
    assert column(repair.bucketize(df, "x", edges, ["E", "D", "C"], "b"), "b") == ["E", "D", None]


def test_first_rule_wins_and_missing_text(spark):
    df = spark.createDataFrame([("car and house",), ("boat",), (None,)], "x string")
    out = repair.categorize_contains(df, "x", [("car", "auto"), ("house", "home")], "c", "none")
    assert column(out, "c") == ["auto", None, "none"]


def test_drop_at_maximum(spark):
    assert column(filters.drop_at_max(numbers(spark, [1, 5, 5, None]), "x"), "x") == [1]


def test_flag_token(spark):
    df = spark.createDataFrame([("absent",), ("12",), (None,)], "x string")
    assert [tuple(r) for r in shape.flag_token(df, "x", "absent", "f").collect()] == [(0, 1), (12, 0), (0, 0)]


def test_dense_counts(spark):
    df = spark.createDataFrame([(0,), (0,), (4,), (3,)], "x int")
    assert sorted(map(tuple, aggregate.dense_counts(df, "x", 0, 4, 2).collect())) == [(0, 2), (2, 0), (4, 1)]


def test_rating_tie_range(spark):
    got = {r.x: (r.place_first, r.place_last) for r in ranking.rating(numbers(spark, [9, 8, 8, 7]), "x").collect()}
    assert got == {9: (1, 1), 8: (2, 3), 7: (4, 4)}


def test_score_with_one_side_missing(spark):
    df = spark.createDataFrame([(1, "p", 2), (2, "p", 1), (2, "n", 2)], "u int, s string, v int")
    out = stats.balance_score(df, ["u"], F.col("s") == "p", F.col("s") == "n", "v")
    assert {r.u: r.score for r in out.collect()} == {1: None, 2: -1}


def test_running_share(spark):
    out = ranking.pareto_segment(numbers(spark, [50, 30, 15, 5]), "x", "i", 0.8)
    assert sorted(column(out, "x")) == [30, 50]
    report = ranking.pareto_report(numbers(spark, [50, 30, 15, 5]), "x", "i", 0.8).first()
    assert (report.rows, report.row_share, report.value_share) == (2, 0.5, 0.8)


def test_words(spark):
    df = spark.createDataFrame([(" a  b ",), ("A,\tb!",)], "t string")
    assert sorted(map(tuple, words.word_count(df, "t").collect())) == [("a", 2), ("b", 2)]
    assert column(words.word_count(df, "t", ["B"]), "word") == ["a"]


@pytest.mark.parametrize("list_size", [2, 100])
def test_frequency_index_lists_every_word_once(spark, list_size):
    counts = spark.createDataFrame([(f"w{i:02}", 1 if i < 30 else i) for i in range(40)], "word string, num long")
    rows = words.frequency_index(counts, list_size).collect()
    listed = sorted(w for r in rows for w in r.words)
    assert listed == [f"w{i:02}" for i in range(40)]
    assert all(r.word_count == (30 if r.num == 1 else 1) and r.words == sorted(r.words) for r in rows)
    ones = sorted((r.part, r.words) for r in rows if r.num == 1)
    assert [p for p, _ in ones] == list(range(len(ones))) and [w for _, ws in ones for w in ws] == [f"w{i:02}" for i in range(30)]


def test_keyed_mean(spark):
    df = spark.createDataFrame([("apple", 2), ("banana", 3), ("apple", 4), ("cherry", 1)], "k string, v int")
    want = {"apple": 3.0, "banana": 3.0, "cherry": 1.0}
    assert {r.k: r["mean"] for r in aggregate.keyed_mean(df, "k", "v").collect()} == want
    parts = aggregate.keyed_mean_parts(df, "k", "v")
    assert {r.k: r["mean"] for r in aggregate.merge_keyed_means(parts, "k").collect()} == want


def test_map_join_refuses_two_values_for_a_key(spark):
    left = spark.createDataFrame([(1,), (1,), (2,)], "k int")
    good = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b")], "k int, v string")
    assert joins.map_join(left, good, "k").count() == 3
    bad = spark.createDataFrame([(1, "a"), (1, "c")], "k int, v string")
    with pytest.raises(Exception, match="not unique"):
        joins.map_join(left, bad, "k").collect()
    assert joins.map_join(left, bad, "k", strict=False).count() == 3


def test_corrections(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "k int, v string")
    fixes = spark.createDataFrame([(1, "x", False), (2, None, True)], "k int, new_value string, set_null boolean")
    assert sorted((r.k, r.v) for r in repair.apply_corrections(df, fixes, "k", "v").collect() if r.v) == [(1, "x")]
    twice = fixes.unionByName(spark.createDataFrame([(1, "y", False)], fixes.schema))
    with pytest.raises(Exception, match="more than one"):
        repair.apply_corrections(df, twice, "k", "v").collect()


def test_shares_sum_to_one_and_funnel_falls(spark):
    df = numbers(spark, [1, 2, 3, 4]).withColumn("k", F.col("i") % 3)
    shares = aggregate.normalized_share(df, "k", "x", {"all": None, "big": F.col("x") > 2})
    total = shares.agg(F.sum("all"), F.sum("big")).first()
    assert total[0] == pytest.approx(1) and total[1] == pytest.approx(1)
    steps = column(aggregate.funnel(df, {"a": F.lit(True), "b": F.col("x") > 1, "c": F.col("x") > 3}), "n")
    assert steps == sorted(steps, reverse=True) == [4, 3, 1]


def test_overlap_parts_sum_to_the_union(spark):
    a, b = spark.range(0, 10).toDF("k"), spark.range(6, 20).toDF("k").union(spark.range(6, 8).toDF("k"))
    r = joins.overlap_report(a, b, "k").first()
    assert (r.both, r.left_only, r.right_only) == (4, 6, 10)
    t = sets.set_turnover(a, b, "k").first()
    assert (t.stayed, t.left, t.new) == (4, 6, 10)


def test_full_join_keeps_null_and_unmatched_keys(spark):
    a = spark.createDataFrame([(1, "a"), (None, "b"), (2, "c")], "k int, v string")
    b = spark.createDataFrame([(1, "x"), (3, "y"), (None, "z")], "k int, v string")
    got = sorted(map(tuple, joins.full_join(a, b, ["k"]).collect()), key=str)
    assert got == sorted([(1, "a", "x"), (None, "b", None), (2, "c", None), (3, None, "y"), (None, None, "z")], key=str)


def test_ratio_by_zero_is_null(spark):
    df = spark.createDataFrame([(1.0, 0.0)], "a double, b double")
    assert df.select(numeric.ratio(F.col("a"), F.col("b")).alias("r")).first().r is None


def test_log_of_zero_is_null(spark):
    assert column(numbers(spark, [0.0]).select(numeric.log(F.col("x")).alias("r")), "r") == [None]


def test_similarity(spark):
    df = spark.createDataFrame([("abcd", "abce"), ("", "")], "a string, b string")
    assert column(df.select(text.similarity(F.col("a"), F.col("b")).alias("r")), "r") == [0.75, 1.0]


def test_histogram_last_bin_closed(spark):
    got = column(profile.histogram(numbers(spark, [0, 5, 10, 11, None]), "x", 2, 0, 10).orderBy("bin"), "n")
    assert got == [1, 2]


def test_quotes_wide(spark):
    df = spark.createDataFrame([("A", "d1", 1.0), ("A", "d2", 2.0), ("B", "d2", 3.0), ("C", "d9", 4.0)], "i string, d string, c double")
    got = sorted(tuple(r) for r in aggregate.quotes_wide(df, "i", "d", "c", ["d1", "d2"]).collect())
    assert got == [("A", 1.0, 2.0), ("B", 0.0, 3.0)]


def test_order_of_rows_and_partitions_does_not_matter(spark):
    df = numbers(spark, [float(i * 7 % 50) for i in range(200)]).withColumn("k", F.col("i") % 5)
    for op in (
        lambda d: ranking.cumulative_share(d, "x", "i"),
        lambda d: ranking.rating(d, "x"),
        lambda d: missing.fill_group_median(d, "x", "k"),
        lambda d: profile.describe(d, "x", ["k"]),
    ):
        show = lambda d: sorted(str(tuple(round(v, 9) if isinstance(v, float) else v for v in r)) for r in d.collect())
        assert show(op(df)) == show(op(df.repartition(7, "x").orderBy(F.desc("i"))))
