"""The same answers on both sides of every limit, and for keys that are null, text or hot."""

import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tabloom.models import attribution, classify, features
from tabloom.operators import filters, joins, ranking
from tabloom.plans.blocks import running_total
from tabloom.plans.neighbours import with_neighbours
from tabloom.plans.sizing import attach
from tabloom.sources import read_many, write_parquet


@pytest.mark.parametrize("n", [3, 300])
def test_a_null_in_a_list_matches_nothing(spark, n):
    df = spark.createDataFrame([(1,), (2,), (None,), (999,)], "x int")
    values = [None, *range(1, n)]
    assert [r.x for r in filters.keep_in(df, "x", values).orderBy("x").collect()] == [1, 2]
    assert {r.x for r in filters.keep_not_in(df, "x", values).collect()} == {None, 999}


def test_preambles_go_however_files_are_packed(spark, tmp_path):
    want = []
    for f in range(6):
        rows = [f"{f * 1000 + k},{k}" for k in range(50)]
        (tmp_path / f"part{f}.csv").write_text("\n".join(["title", "note", "a,b", *rows]) + "\n")
        want += [f * 1000 + k for k in range(50)]
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        for size, cost in ((old["spark.sql.files.maxPartitionBytes"], "4194304"), ("100", "0"), ("64", "0")):
            frame = read_many(spark, [(f"{tmp_path}/*.csv", 2)], "a bigint, b bigint")
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            spark.conf.set("spark.sql.files.openCostInBytes", cost)
            assert sorted(r.a for r in frame.collect()) == want
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_permutation_gives_and_takes_every_row_once(spark):
    rows = spark.range(500).select(F.col("id").alias("k"), F.array(F.col("id").cast("double")).alias("_x"))
    got = attribution.paired_rows(rows, "k", 7).collect()
    assert sorted(r._d[0] for r in got) == [float(k) for k in range(500)] and len({r.k for r in got}) == 500
    assert sum(r._d[0] == r.k for r in got) < 20


def test_attribution_averages_over_every_background_row(spark):
    df = spark.createDataFrame([(k, float(k % 7), float(k * k % 11), k % 2) for k in range(160)], "id int, a double, b double, label int")
    data = features.build_pipeline([], {}, ["a", "b"], None).fit(df).transform(df)
    model, base = classify.logistic(penalty=0.1).fit(data), data.filter("id < 130")
    phi = attribution.attribution(model, data.filter("id > 150"), "id", 2, base, n_perm=2)
    total = {r.id: r.t for r in phi.groupBy("id").agg(F.sum("phi").alias("t")).collect()}
    start = classify.score(model, base, ["id"]).agg(F.avg("score")).first()[0]
    for r in classify.score(model, data.filter("id > 150"), ["id"]).collect():
        assert total[r.id] == pytest.approx(r.score - start, abs=1e-9)


def test_several_rows_where_one_is_meant(spark):
    one = spark.createDataFrame([(1, 2.0), (1, 3.0)], "k int, v double")
    with pytest.raises(Exception, match="several rows"):
        joins.align_columns({"a": (one, "v")}, "k").collect()
    assert joins.align_columns({"a": (one.limit(1), "v"), "b": (one.limit(1), "v")}, "k").count() == 1
    with pytest.raises(Exception, match="several rows"):
        attach(spark.range(3), one).collect()


def test_hot_null_key_is_cut_into_blocks(spark):
    rows = [(None if k % 4 else "a", k, k, float(k) if k % 3 else None) for k in range(4000)]
    df = spark.createDataFrame(rows, "k string, i int, t int, v double")
    got = with_neighbours(df, ["k"], "i", "t", "v", hot_rows=500, n_blocks=4)
    plain = with_neighbours(df, ["k"], "i", "t", "v", hot_rows=10**9)
    assert sorted(map(str, got.select(sorted(got.columns)).collect())) == sorted(map(str, plain.select(sorted(got.columns)).collect()))
    keys = df.filter("k is null").count()
    from tabloom.plans.neighbours import _split_hot

    blocks = _split_hot(df, ["k"], "i", "t", 500, 4)[0].filter("k is null").groupBy("_block").count().collect()
    assert len(blocks) == 4 and max(b["count"] for b in blocks) < keys / 2


def test_running_share_over_text_keys(spark):
    df = spark.createDataFrame([(f"cust{k:05d}", float(k % 5)) for k in range(300)], "id string, v double")
    got = running_total(df, F.col("v"), F.col("id"), {"s": F.col("v")}, n_blocks=7).orderBy("v", "id").collect()
    total = 0.0
    for r in got:
        total += r.v
        assert r.s == pytest.approx(total)
    assert ranking.pareto_segment(df, "v", "id", 0.8).count() > 0


def test_writers_do_not_overwrite_unasked(spark, tmp_path):
    write_parquet(spark.range(3), str(tmp_path / "t"))
    with pytest.raises(Exception, match="(?i)exists"):
        write_parquet(spark.range(3), str(tmp_path / "t"))
    write_parquet(spark.range(4), str(tmp_path / "t"), mode="overwrite")
    assert spark.read.parquet(str(tmp_path / "t")).count() == 4


@pytest.mark.parametrize("threshold", [0.6, 0.5, 0.4, 0.2])
def test_fuzzy_join_is_complete_at_low_thresholds(spark, threshold):
    rng = random.Random(int(threshold * 10))
    some = lambda n: {"".join(rng.choices("abcde", k=rng.randrange(1, 9))) for _ in range(n)}
    left, right = some(60) | {"abcd", "shared prefix 17"}, some(60) | {"ab", "abcde", "shared prefix 29"}
    a = spark.createDataFrame([(x,) for x in sorted(left)], "name string")
    b = spark.createDataFrame([(x,) for x in sorted(right)], "known string")

    def edits(x, y):
        row = list(range(len(y) + 1))
        for i, c in enumerate(x, 1):
            last, row[0] = row[0], i
            for j, d in enumerate(y, 1):
                last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (c != d))
        return row[-1]

    got = {r.name: (r.known, r.score) for r in joins.fuzzy_join(a, b, "name", "known", threshold).collect()}
    for x in left:
        scored = [(1 - edits(x, y) / max(len(x), len(y)), y) for y in right]
        best = max(s for s, _ in scored)
        known, score = got[x]
        if best < threshold - 1e-9:
            assert known is None
        else:
            assert score == pytest.approx(best) and known == min(y for s, y in scored if abs(s - best) < 1e-9)


@pytest.mark.parametrize("n", [40, 1500])
def test_labels_of_any_number_get_ids(spark, n):
    df = spark.createDataFrame([(k, f"level{k % n:05d}" if k % 7 else None) for k in range(2 * n)], "k int, kind string")
    out, names = features.encode_labels(df, "kind")
    assert out.columns == ["k", "kind", "label"] and names == sorted(names)
    assert all(r.label is None if r.kind is None else names[r.label] == r.kind for r in out.collect())


def _orders(kind, n=4000):
    """(id, order, tie): text days with one shared prefix, text ties with a shared prefix, nulls in both."""
    out = []
    for k in range(n):
        day = f"2024-03-{1 + k * 7 % 29:02d}" if kind != "hot" else "2024-03-05"
        tie = k * 31 % n if kind == "days" else f"user-{k * 31 % n:06d}"
        if kind == "nulls":
            day, tie = (None if k % 3 == 0 else day), (None if k == 7 else tie)
        out.append((k, day, tie, float(k % 13) if k % 4 else None))
    return out


def _plain_order(rows):
    return sorted(rows, key=lambda r: (r[1] is not None, r[1] or "", r[2] is not None, r[2] if r[2] is not None else 0))


@pytest.mark.parametrize("kind", ["days", "hot", "nulls"])
@pytest.mark.parametrize("n_blocks", [1, 4, 23])
def test_running_total_over_text_and_null_orders(spark, kind, n_blocks):
    rows = _orders(kind)
    df = spark.createDataFrame(rows, f"id int, day string, tie {'int' if kind == 'days' else 'string'}, v double").repartition(5)
    out = running_total(df, F.col("day"), F.col("tie"), {"place": F.lit(1)}, n_blocks=n_blocks)
    assert {r.id: r.place for r in out.collect()} == {r[0]: n for n, r in enumerate(_plain_order(rows), 1)}


@pytest.mark.parametrize("kind", ["days", "hot", "nulls"])
@pytest.mark.parametrize("keys, hot_rows", [([], 10**9), (["k"], 100), (["k"], 10**9)])
def test_neighbours_over_text_and_null_orders(spark, kind, keys, hot_rows):
    rows = _plain_order(_orders(kind))
    df = spark.createDataFrame(rows, f"id int, day string, tie {'int' if kind == 'days' else 'string'}, v double").withColumn("k", F.lit(1)).repartition(5)
    got = {r.id: r for r in with_neighbours(df, keys, "day", "tie", "v", hot_rows, n_blocks=6).collect()}
    before, ahead = None, [None] * len(rows)
    for n in range(len(rows) - 2, -1, -1):
        ahead[n] = rows[n + 1][3] if rows[n + 1][3] is not None else ahead[n + 1]
    for n, (ident, _, _, v) in enumerate(rows):
        r = got[ident]
        assert (r._pos, r._prev, r._next) == (n + 1, before, ahead[n])
        assert (r._lag, r._lead) == (rows[n - 1][3] if n else None, rows[n + 1][3] if n + 1 < len(rows) else None)
        before = before if v is None else v


def test_no_block_grows_with_a_hot_order_value(spark):
    from tabloom.plans.blocks import with_blocks

    for rows in (_orders("hot"), [(k, None, f"user-{k:06d}", None) for k in range(4000)], [(k, "x" * 3000, f"user-{k:06d}", None) for k in range(4000)]):
        df = spark.createDataFrame(rows, "id int, day string, tie string, v double")
        counts = [r["count"] for r in with_blocks(df, F.col("day"), F.col("tie"), n_blocks=8).groupBy("_block").count().collect()]
        assert sum(counts) == 4000
        assert max(counts) < 4000 / 3 or len(rows[0][1] or "") > 300  # a text longer than a limit is cut by its beginning


def test_no_row_of_a_running_share_is_lost(spark):
    df = spark.createDataFrame([(None if k % 10 == 0 else k, 1.0) for k in range(2000)], "k int, v double")
    out = ranking.cumulative_share(df, "v", "k")
    assert out.count() == 2000 and sorted(r.share for r in out.collect()) == pytest.approx([(k + 1) / 2000 for k in range(2000)])


def test_orders_of_every_kind(spark):
    rows = spark.range(500).selectExpr(
        "id", "timestamp_seconds(id % 60) AS ts", "date_add(date'2024-01-01', int(id % 40)) AS day", "cast(id % 50 AS decimal(30, 4)) AS d",
        "double(id % 45) AS f", "id % 2 = 0 AS b", "cast(timestamp_seconds(id % 60) AS timestamp_ntz) AS ntz", "cast(cast(id AS string) AS binary) AS raw")
    for col in ("ts", "day", "d", "f", "b", "ntz", "raw"):
        got = running_total(rows, F.col(col), F.col("id"), {"place": F.lit(1)}, n_blocks=7).orderBy("place").select("place", "id").collect()
        want = rows.orderBy(col, "id").select("id").collect()
        assert [r.place for r in got] == list(range(1, 501)) and [r.id for r in got] == [r.id for r in want], col


def test_names_of_one_prefix_give_few_candidates(spark):
    """A thousand names on both sides that differ in their last digits only."""
    def names(form, col, change=lambda x: x):
        return spark.createDataFrame([(change(form.format(k)),) for k in range(1000)], f"{col} string")

    for form, share, change in (("Customer#{:09d}", 0.1, lambda x: x.replace("m", "n")), ("Customer No. #{:011d}", 0.1, lambda x: x.replace("m", "n").replace("C", "K"))):
        left, right = names(form, "_l", change), names(form, "_r")
        near = joins.one_edit_matches(left, right, share).count() if "No" not in form else 0
        far = joins.further_matches(left, right, share).count()
        assert near + far <= 40_000 < 1000 * 1000 / 20, (form, near, far)
        got = joins.fuzzy_join(left.select(F.col("_l").alias("name")), right.select(F.col("_r").alias("known")), "name", "known", 1 - share).collect()
        assert len(got) == 1000 and all(r.known == change(r.known).replace(change(r.known), r.known) and change(r.known) == r.name for r in got)


def test_fuzzy_join_over_prefixed_names_against_all_pairs(spark):
    rng = random.Random(9)
    for prefix, threshold in (("Customer No. ", 0.9), ("shared beginning of all ", 0.9), ("common ", 0.8)):
        word = lambda: prefix + "".join(rng.choices("abc1", k=rng.randrange(5, 9)))  # noqa: E731, B023
        left, right = {word() for _ in range(120)}, {word() for _ in range(150)}
        a, b = spark.createDataFrame([(x,) for x in sorted(left)], "name string"), spark.createDataFrame([(x,) for x in sorted(right)], "known string")
        both = a.crossJoin(b).withColumn("s", 1 - F.levenshtein("name", "known") / F.greatest(F.length("name"), F.length("known")))
        want = {}
        for r in both.filter(F.col("s") >= threshold - 1e-12).collect():
            best = want.get(r.name)
            if best is None or (-round(r.s, 12), r.known) < best:
                want[r.name] = (-round(r.s, 12), r.known)
        got = {r.name: r.known for r in joins.fuzzy_join(a, b, "name", "known", threshold).collect()}
        assert got == {x: want[x][1] if x in want else None for x in left}


def test_least_squares_with_any_number_of_levels(spark):
    """Three rows per level, a hundred thousand levels, whose effects are known; and features that depend on each other."""
    from tabloom.operators import stats

    n = 100_000
    df = spark.range(3 * n).selectExpr(f"id % {n} AS g", f"double(id div {n}) AS a", "double((id * 7) % 11) AS b")
    df = df.withColumn("y", 2 * F.col("a") - 0.5 * F.col("b") + F.col("g") % 13)
    fit = stats.ols(df, "y", ["a", "b"], "g")
    assert fit.weights["a"] == pytest.approx(2) and fit.weights["b"] == pytest.approx(-0.5)
    assert fit.coefficients.count() == n + 2 and fit.summary.first().r2 == pytest.approx(1)
    worst = fit.coefficients.filter("term like 'g@_%' escape '@'").select(F.max(F.abs(F.col("coef") - F.substring("term", 3, 9).cast("long") % 13))).first()[0]
    assert worst < 1e-6
    assert stats.residuals(fit, df).agg(F.max(F.abs("resid"))).first()[0] < 1e-6
    twice = stats.ols(df.withColumn("c", 2 * F.col("a")), "y", ["a", "b", "c"], "g")
    assert twice.weights["a"] + 2 * twice.weights["c"] == pytest.approx(2)
    with pytest.raises(ValueError):
        stats.ols(df.filter("a > 99"), "y", ["a"])


def test_many_levels_become_sparse_slots_without_a_collect(spark, monkeypatch):
    n = 3000
    df = spark.createDataFrame([(k, f"v{k % n:05d}" if k % 50 else None, "ab"[k % 2], float(k)) for k in range(2 * n)], "k int, kind string, few string, x double")
    monkeypatch.setattr(features.Levels, "_read", lambda self: pytest.fail("the levels were collected"))
    pipe = features.build_pipeline(["kind", "few"], {"few2": ["a", "b"]}, ["x"], None, "none").fit(df.withColumn("few2", F.col("few")))
    assert isinstance(pipe.stages[0].names["kind"], features.Levels) and pipe.stages[0].names["few"] == ["a", "b"]
    out = pipe.transform(df.withColumn("few2", F.col("few")).union(spark.createDataFrame([(-1, "new", "b", 1.0, "b")], "k int, kind string, few string, x double, few2 string")))
    known = sorted({f"v{k % n:05d}" for k in range(2 * n) if k % 50})
    usual = known[0]  # all levels occur twice, the smallest is the mode
    for r in out.select("k", "kind", "few", "x", "features").collect():
        v = r.features
        size = len(known) - 1
        assert v.size == size + 1 + 1 + 1
        hot = {int(i): float(v[int(i)]) for i in v.toArray().nonzero()[0]}
        level = r.kind if r.kind is not None else usual
        want = {known.index(level) - 1: 1.0} if level in known[1:] else {}
        if r.few == "b":
            want |= {size: 1.0, size + 1: 1.0}
        if r.x:
            want[size + 2] = r.x
        assert hot == want


def test_labels_are_numbered_and_decoded_without_a_collect(spark, monkeypatch):
    df = spark.range(20_000).selectExpr("id", "cast((id * 7919) % 20000 AS string) AS kind")
    monkeypatch.setattr(features.Levels, "_read", lambda self: pytest.fail("the levels were collected"))
    coded, names = features.encode_labels(df, "kind")
    back = features.decode_labels(coded, "label", names, "again")
    assert back.filter("again != kind").count() == 0 and len(names) == 20_000
    assert coded.agg(F.countDistinct("label"), F.min("label"), F.max("label")).first()[:] == (20_000, 0, 19_999)


class Jobs:
    """Counts the jobs that Spark starts inside the block."""

    def __init__(self, spark):
        self.sc = spark.sparkContext

    def __enter__(self):
        self.group = f"counted-{id(self)}-{random.random()}"
        self.sc.setJobGroup(self.group, "counted")
        return self

    def __exit__(self, *_):
        self.n = len(self.sc.statusTracker().getJobIdsForGroup(self.group))
        self.sc.setLocalProperty("spark.jobGroup.id", None)


def test_rank_correlation_ranks_each_column_once(spark):
    from tabloom.operators import stats

    rng = np.random.default_rng(3)
    pdf = pd.DataFrame(rng.integers(0, 40, (900, 5)).astype(float), columns=list("abcde"))
    pdf["e"] += pdf["a"]
    df = spark.createDataFrame(pdf).repartition(4)
    with Jobs(spark) as jobs:
        got = {(r.a, r.b): r.r for r in stats.correlation_matrix(df, list("abcde"), "spearman").collect()}
    assert jobs.n < 25, jobs.n  # a few per column; one ranking per pair took hundreds
    want = pdf.corr(method="spearman")
    assert len(got) == 25 and all(got[x, y] == pytest.approx(want.loc[x, y]) for x in "abcde" for y in "abcde")
    gaps = pdf.mask(rng.random(pdf.shape) < 0.2)
    gaps["a"], gaps["b"] = pdf["a"], 7.0
    df = spark.createDataFrame(gaps).replace(float("nan"), None)
    got = {(r.a, r.b): r.r for r in stats.correlation_matrix(df, list("abcd"), "spearman").collect()}
    want = gaps.corr(method="spearman")
    for x in "abcd":
        for y in "abcd":
            assert got[x, y] is None if "b" in (x, y) else got[x, y] == pytest.approx(want.loc[x, y]), (x, y)
    assert stats.spearman(df.filter("a < 0"), "a", "c").first().r is None


@pytest.mark.parametrize("margin, read", [(2.0, 20_000), (0.0, 20_000), (-40.0, 5), (2.0, 3)])
@pytest.mark.parametrize("keys", [[], ["k"]])
def test_a_missed_bracket_is_widened(spark, monkeypatch, margin, read, keys):
    """Brackets that do not hold their rank, and brackets too full to be read, still end at the exact value."""
    from tabloom.plans import quantiles as Q

    monkeypatch.setattr(Q, "MARGIN", margin)
    monkeypatch.setattr(Q, "READ_VALUES", read)
    rng = np.random.default_rng(1)
    pdf = pd.DataFrame({"k": rng.integers(0, 3, 4000), "v": np.where(rng.random(4000) < 0.3, 2.5, rng.normal(size=4000).round(3))})
    df, qs = spark.createDataFrame(pdf), [0.0, 0.1, 0.5, 0.77, 0.999, 1.0]
    got = Q.exact_quantiles(df, "v", qs, keys, accuracy=50, hot_rows=100).collect()
    for r in got:
        own = pdf[pdf.k == r.k] if keys else pdf
        assert r.n == len(own) and r.quantiles == pytest.approx(own.v.quantile(qs).tolist())
    assert len(got) == (3 if keys else 1)
    for r in Q.kth_smallest(df, "v", 0.3, keys, accuracy=50, hot_rows=100).collect():
        own = sorted((pdf[pdf.k == r.k] if keys else pdf).v)
        assert r.kth == own[r["rank"] - 1]


def test_many_columns_are_profiled_in_a_few_passes(spark):
    from tabloom.operators import profile

    rng = np.random.default_rng(2)
    pdf = pd.DataFrame({f"c{i}": rng.normal(i, 1 + i, 3000) for i in range(8)})
    pdf.loc[rng.random(3000) < 0.3, "c3"] = np.nan
    pdf["empty"] = np.nan
    df = spark.createDataFrame(pdf).replace(float("nan"), None).withColumn("empty", F.lit(None).cast("double"))
    with Jobs(spark) as jobs:
        got = {r.column: r for r in profile.summary_table(df).collect()}
    assert jobs.n <= 7, jobs.n  # three passes: adaptive execution runs each as a map and a result job
    for c in pdf.columns[:8]:
        r = got[c]
        assert [r.min, r.p50, r.p90, r.p95, r.max, r.mean] == pytest.approx([*pdf[c].quantile([0, 0.5, 0.9, 0.95, 1]), pdf[c].mean()])
        assert r.complete == pytest.approx(pdf[c].notna().mean())
    assert got["empty"][:] [1:] == (0.0, None, None, None, None, None, None)


def test_intermediate_tables_can_be_dropped(spark):
    import os

    from tabloom.plans.written import written
    from tabloom.session import drop_written

    path = written(spark.range(5), "dropped").inputFiles()[0].removeprefix("file:")
    assert os.path.exists(path) and drop_written(spark) > 0 and not os.path.exists(path) and drop_written(spark) == 0


@pytest.mark.parametrize("limit", [3, 50_000])
def test_dense_counts_on_both_sides_of_the_limit(spark, monkeypatch, limit):
    from tabloom.operators import aggregate

    monkeypatch.setattr(aggregate, "MAX_ROWS", limit)
    df = spark.createDataFrame([(2,), (2,), (4,), (99,), (None,)], "x int")
    assert sorted(map(tuple, aggregate.dense_counts(df, "x", 0, 8, 2).collect())) == [(0, 0), (2, 2), (4, 1), (6, 0), (8, 0)]


def test_fuzzy_join_broadcasts_only_what_was_measured(spark):
    """One left name gives hundreds of rows, which Spark takes for a few bytes: they are never the broadcast side."""
    left = spark.createDataFrame([("shared beginning xyz",)], "_l string")
    right = spark.createDataFrame([(f"shared beginning {i:03d}",) for i in range(300)], "_r string")
    plan = joins.further_matches(left, right, 0.5)._jdf.queryExecution().executedPlan().toString()
    assert "BuildLeft" not in plan and "BuildRight" in plan
