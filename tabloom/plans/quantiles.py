"""Exact order statistics, also for tables and groups too large for one task.

Whole columns (no keys): one wide aggregate sketches all columns at once; the sketch gives an open
bracket around each wanted rank, a second one counts what lies before, on and in the brackets of all
columns. A rank outside its bracket moves to the range beside it, a bracket that still holds many
values is sketched again, and at last the few values left in the brackets are counted one by one.
Each round narrows a bracket by about accuracy / 4, so a handful of passes serve any number of rows and
columns, and what reaches the driver is bounded.

Groups: an ordinary group is sorted in one window partition. A group with more than
``hot_rows`` values (there are at most rows / hot_rows of them) is never
gathered: one mergeable quantile sketch per group gives a narrow bracket around
each wanted rank, values inside a bracket are counted by value, those outside
only by cell, so almost everything is combined before the shuffle. The wanted
values are read from the running count of what is left, about 4n/accuracy of the
group's n values per wanted quantile; none is guessed. If a bracket misses its rank, all brackets are
widened and the pass is repeated.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from tabloom.plans.sizing import pinned_if_small
from tabloom.plans.written import written

ACCURACY = 10_000
HOT_ROWS = 250_000
#: Half the width of a bracket, in steps of the sketch, and values that are read one by one.
MARGIN, READ_VALUES = 2.0, 20_000


def _join(df: DataFrame, table: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join by key; without keys the table is one row."""
    return df.join(table, keys, how) if keys else df.crossJoin(F.broadcast(table))


def _sorted(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Ordinary groups: every value at its place."""
    place = F.row_number().over(Window.partitionBy(*keys).orderBy("_v")).cast("long")
    v = F.col("_v")
    return rows.select(*keys, v.alias("_fine"), v.alias("_lo"), v.alias("_hi"), place.alias("_end")).withColumn(
        "_start", F.col("_end") - 1
    )


def _bracketed(rows: DataFrame, keys: list[str], qs: Sequence[float], accuracy: int, margin: float) -> DataFrame:
    """Hot groups: runs of counted values, single ones inside the brackets, whole cells outside."""
    points = sorted({min(1.0, max(0.0, q + m)) for q in qs for m in (-margin, margin)})
    sketch = rows.groupBy(*keys).agg(F.percentile_approx("_v", points, F.lit(accuracy)).alias("_ends"))
    sketch, _ = pinned_if_small(sketch)
    ends = [F.col("_ends")[i] for i in range(len(points))]
    above = reduce(lambda a, b: a + b, [(F.col("_v") > e).cast("int") for e in ends])
    reached = reduce(lambda a, b: a + b, [(F.col("_v") >= e).cast("int") for e in ends])
    # cell 2i+1 holds values equal to end i, cell 2i+2 those strictly between ends i and i+1
    inside = [
        2 * i + 2
        for i, (a, b) in enumerate(zip(points, points[1:]))
        if any(abs((a + b) / 2 - q) <= margin for q in qs)
    ]
    celled = _join(rows, sketch, keys).withColumn("_cell", above + reached)
    celled = celled.withColumn("_fine", F.when(F.col("_cell").isin(*inside), F.col("_v")))
    counted = celled.groupBy(*keys, "_cell", "_fine").agg(
        F.count("_v").alias("_c"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi")
    )
    upto = Window.partitionBy(*keys).orderBy("_cell", "_fine").rowsBetween(Window.unboundedPreceding, 0)
    ends_at = F.sum("_c").over(upto)
    return counted.select(*keys, "_fine", "_lo", "_hi", ends_at.alias("_end"), (ends_at - F.col("_c")).alias("_start"))


def _value_at(rank: Column) -> Column:
    """Value at a 0-based rank, read from the one counted row that spans it; null if that row is a whole cell."""
    found = (
        F.when(F.col("_fine").isNotNull(), F.col("_fine"))
        .when((F.col("_lo") == F.col("_hi")) | (rank == F.col("_start")), F.col("_lo"))
        .when(rank == F.col("_end") - 1, F.col("_hi"))
    )
    return F.max(F.when((F.col("_start") <= rank) & (rank < F.col("_end")), found))


def _values_at(
    df: DataFrame, value: str, keys: list[str], qs: Sequence[float], ranks: list[Column], accuracy: int, hot_rows: int
) -> DataFrame:
    """Per group its size ``n`` and the values at the ranks, as _r0, _r1 …

    Ranks are expressions over the group's size ``_n``. Keys go by names of their own here,
    as the caller's may be those of columns that the steps add.
    """
    named = {f"_key{i}": k for i, k in enumerate(keys)}
    rows = (df.dropna(subset=keys) if keys else df).select(*(F.col(k).alias(a) for a, k in named.items()), F.col(value).cast("double").alias("_v"))
    keys = list(named)
    sizes, table = pinned_if_small(rows.groupBy(*keys).agg(F.count("_v").alias("_n")))
    rows = rows.filter(F.col("_v").isNotNull())
    hot = sizes.filter(F.col("_n") > hot_rows).select(*keys)
    if table is None:
        # too many groups to pin, but the hot ones among them are few
        hot, hot_table = pinned_if_small(hot)
        some_hot, all_hot = hot_table is None or hot_table.num_rows > 0, False
    else:
        counts = table.column("_n").to_pylist()
        some_hot, all_hot = max(counts, default=0) > hot_rows, min(counts, default=0) > hot_rows
    def read(running: DataFrame) -> DataFrame:
        return _join(running, sizes, keys).groupBy(*keys).agg(*[_value_at(r).alias(f"_r{i}") for i, r in enumerate(ranks)])

    parts = [] if all_hot else [read(_sorted(rows.join(hot, keys, "left_anti") if some_hot else rows, keys))]
    margin = MARGIN / accuracy
    while some_hot:
        chosen = rows if all_hot else rows.join(hot, keys, "left_semi")
        found = written(read(_bracketed(chosen, keys, qs, accuracy, margin)), "quantiles")
        missed = reduce(lambda a, b: a | b, [F.col(f"_r{i}").isNull() & (r >= 0) for i, r in enumerate(ranks)])
        if margin >= 1 or _join(found, sizes, keys).filter(missed).isEmpty():
            parts.append(found)
            break
        margin = max(8 * margin, 1.0 / accuracy)
    return _join(sizes.withColumnRenamed("_n", "n"), reduce(DataFrame.unionByName, parts), keys, "left").withColumnsRenamed(named)


def selected(
    df: DataFrame, cols: Sequence[str], qs: Sequence[float], ranks: Callable[[int], list[int]], accuracy: int = ACCURACY, aggs: Sequence[Column] = ()
) -> tuple[dict[str, tuple[int, list[float | None]]], Row]:
    """Per column its number of values and the values at ``ranks(n)`` (0-based; one below 0 has none), and a row of ``aggs`` from the same first pass.

    ``qs`` says about where the ranks lie.
    """
    cols, v = list(cols), {c: F.col(f"`{c}`").cast("double") for c in cols}
    margin = MARGIN / accuracy
    points = sorted({min(1.0, max(0.0, q + m)) for q in qs for m in (-margin, margin)})
    firsts = []
    for i, c in enumerate(cols):
        firsts += [F.count(v[c]).alias(f"n{i}"), F.min(v[c]).alias(f"lo{i}"), F.max(v[c]).alias(f"hi{i}"), F.percentile_approx(v[c], points, F.lit(accuracy)).alias(f"p{i}")]
    first = df.agg(*firsts, *aggs).first()
    size = {c: first[f"n{i}"] for i, c in enumerate(cols)}
    known: dict[tuple[str, int], float] = {}
    todo: dict[tuple[str, int], tuple[float, float]] = {}
    for i, c in enumerate(cols):
        low, high = first[f"lo{i}"], first[f"hi{i}"]
        for r in {r for r in ranks(size[c]) if 0 <= r < size[c]}:
            if r == 0 or low == high:
                known[c, r] = low
            elif r == size[c] - 1:
                known[c, r] = high
            else:
                at = r / (size[c] - 1)
                near = min(qs, key=lambda q: abs(q - at))
                side = lambda m: first[f"p{i}"][points.index(min(1.0, max(0.0, near + m)))]  # noqa: E731, B023
                todo[c, r] = (side(-margin), side(margin))

    def counts(ranges: list[tuple[str, float, float]]) -> list[tuple[int, int, int, int]]:
        """Values below the lower end, up to it, below the upper end, up to it."""
        sums = [F.count_if(x).alias(f"c{4 * k + j}") for k, (c, a, b) in enumerate(ranges) for j, x in enumerate((v[c] < a, v[c] <= a, v[c] < b, v[c] <= b))]
        row = df.agg(*sums).first()
        return [tuple(row[4 * k : 4 * k + 4]) for k in range(len(ranges))]

    ready: dict[tuple[str, int], tuple[float, float, int]] = {}
    while todo:
        ranges = sorted({(c, a, b) for (c, _), (a, b) in todo.items()}, key=str)
        seen, narrow = dict(zip(ranges, counts(ranges))), {}
        for (c, r), (a, b) in list(todo.items()):
            below, upto, before, within = seen[c, a, b]
            i = cols.index(c)
            if upto <= r < before:
                if before - upto <= READ_VALUES:
                    ready[c, r] = (a, b, upto)
                    del todo[c, r]
                else:
                    narrow[c, r] = (a, b, (r - upto) / (before - upto))
            elif below <= r < upto:
                known[c, r] = a
                del todo[c, r]
            elif before <= r < within:
                known[c, r] = b
                del todo[c, r]
            else:  # missed: the range beside it
                todo[c, r] = (first[f"lo{i}"], a) if r < below else (b, first[f"hi{i}"])
        if narrow:
            tighter = [
                F.percentile_approx(F.when((v[c] > a) & (v[c] < b), v[c]), [min(1.0, max(0.0, at + m)) for m in (-2.0 / accuracy, 2.0 / accuracy)], F.lit(accuracy)).alias(f"t{k}")
                for k, ((c, _), (a, b, at)) in enumerate(narrow.items())
            ]
            row = df.agg(*tighter).first()
            for k, key in enumerate(narrow):
                todo[key] = tuple(row[f"t{k}"])
    if ready:
        ranges = sorted({(c, a, b, n) for (c, _), (a, b, n) in ready.items()}, key=str)
        inside = [(v[c] > a) & (v[c] < b) for c, a, b, _ in ranges]
        cells = F.array(*(F.when(x, F.struct(F.lit(k).alias("k"), v[c].alias("v"))) for k, ((c, *_), x) in enumerate(zip(ranges, inside))))
        few = df.filter(reduce(lambda x, y: x | y, inside)).select(F.explode(F.array_compact(cells)).alias("x"))
        counted = few.groupBy("x.k", "x.v").agg(F.count(F.lit(1)).alias("n")).collect()  # at most READ_VALUES per range
        for k, (c, a, b, start) in enumerate(ranges):
            place, wanted = start, sorted(r for (x, r), y in ready.items() if x == c and y == (a, b, start))
            for row in sorted((x for x in counted if x["k"] == k), key=lambda x: x["v"]):
                for r in wanted:
                    if place <= r < place + row["n"]:
                        known[c, r] = row["v"]
                place += row["n"]
    return {c: (size[c], [known.get((c, r)) for r in ranks(size[c])]) for c in cols}, first


def wide_quantiles(df: DataFrame, cols: Sequence[str], qs: Sequence[float], accuracy: int = ACCURACY, aggs: Sequence[Column] = ()) -> tuple[dict[str, tuple[int, list]], Row]:
    """Per column its number of values and exact linear-interpolation quantiles (null without values), and a row of ``aggs``; all columns together."""
    qs = [float(q) for q in qs]
    ranks = lambda n: [f((n - 1) * q) for q in qs for f in (math.floor, math.ceil)]
    found, row = selected(df, cols, qs, ranks, accuracy, aggs)
    out = {}
    for c, (n, values) in found.items():
        between = lambda i, q: values[2 * i] + (values[2 * i + 1] - values[2 * i]) * ((n - 1) * q - math.floor((n - 1) * q))  # noqa: E731, B023
        out[c] = (n, [between(i, q) if n else None for i, q in enumerate(qs)])
    return out, row


def exact_quantiles(
    df: DataFrame,
    value: str,
    qs: Sequence[float],
    keys: Sequence[str] = (),
    accuracy: int = ACCURACY,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Exact linear-interpolation quantiles: keys, ``n`` and ``quantiles``.

    Null values are skipped, null keys form no group. A group without values
    has n = 0 and null quantiles; without keys there is always one row.
    ``accuracy`` and ``hot_rows`` choose the way, never the result.
    """
    keys, qs = list(keys), [float(q) for q in qs]
    if not keys:
        n, values = wide_quantiles(df, [value], qs, accuracy)[0][value]
        return df.sparkSession.createDataFrame([(n, values)], "n long, quantiles array<double>")
    at = [(F.col("_n") - 1) * F.lit(q) for q in qs]
    ranks = [r for a in at for r in (F.floor(a), F.ceil(a))]
    found = _values_at(df, value, keys, qs, ranks, accuracy, hot_rows)

    def between(i: int, q: float) -> Column:
        pos = (F.col("n") - 1) * F.lit(q)
        low, high = F.col(f"_r{2 * i}"), F.col(f"_r{2 * i + 1}")
        return F.when(F.col("n") > 0, low + (high - low) * (pos - F.floor(pos)))

    return found.select(*keys, "n", F.array(*[between(i, q) for i, q in enumerate(qs)]).alias("quantiles"))


def kth_smallest(
    df: DataFrame,
    value: str,
    share: float,
    keys: Sequence[str] = (),
    accuracy: int = ACCURACY,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Per group, the k-th smallest value for k = round(share * n): keys, ``n``, ``rank`` (k), ``kth``.

    ``kth`` is null where k = 0. Values are compared as doubles, so whole numbers
    must stay below 2^53.
    """
    keys = list(keys)
    if not keys:
        rank = lambda n: [math.floor(n * float(share) + 0.5) - 1]
        n, values = selected(df, [value], [float(share)], rank, accuracy)[0][value]
        return df.sparkSession.createDataFrame([(n, rank(n)[0] + 1, values[0])], "n long, rank long, kth double")

    def rank_of(n: str) -> Column:
        return F.floor(F.col(n) * F.lit(float(share)) + 0.5).cast("long")

    found = _values_at(df, value, keys, [share], [rank_of("_n") - 1], accuracy, hot_rows)
    return found.select(*keys, "n", rank_of("n").alias("rank"), F.col("_r0").alias("kth"))
