"""Joins. Sides are broadcast by measured size; hot keys are left to adaptive splitting."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloom.plans.sizing import attach, pinned_if_small
from tabloom.plans.written import written


def inner_join(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    return left.join(right, list(on), "inner")


def left_join(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    return left.join(right, list(on), "left")


def full_join(
    left: DataFrame, right: DataFrame, on: Sequence[str], suffixes: tuple[str, str] = ("_x", "_y")
) -> DataFrame:
    """All rows of both sides; names held by both get a suffix.

    Built as left join plus the unmatched right rows: adaptive execution can
    split hot keys of a left and of an anti join, but not of a full one.
    """
    on = list(on)
    clash = [c for c in left.columns if c in right.columns and c not in on]
    a = left.withColumnsRenamed({c: c + suffixes[0] for c in clash})
    b = right.withColumnsRenamed({c: c + suffixes[1] for c in clash})
    lonely = b.join(left.select(*on).distinct(), on, "left_anti")
    return a.join(b, on, "left").unionByName(lonely, allowMissingColumns=True)


def join_suffixed(
    left: DataFrame, right: DataFrame, key: str, rsuffix: str, lsuffix: str = "", how: str = "inner"
) -> DataFrame:
    """Join on a key; a suffix goes only to names that both sides hold."""
    clash = [c for c in right.columns if c in left.columns and c != key]
    a = left.withColumnsRenamed({c: c + lsuffix for c in clash})
    return a.join(right.withColumnsRenamed({c: c + rsuffix for c in clash}), key, how)


def overlap_report(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Distinct keys in both tables, only in the first, only in the second."""
    keys = a.select(key, F.lit(1).alias("_a"), F.lit(0).alias("_b")).unionByName(
        b.select(key, F.lit(0).alias("_a"), F.lit(1).alias("_b"))
    )
    # one grouping of the stacked keys; hot keys are combined before the shuffle
    seen = keys.dropna(subset=[key]).groupBy(key).agg(F.max("_a").alias("a"), F.max("_b").alias("b"))
    return seen.agg(
        F.count_if((F.col("a") == 1) & (F.col("b") == 1)).alias("both"),
        F.count_if((F.col("a") == 1) & (F.col("b") == 0)).alias("left_only"),
        F.count_if((F.col("a") == 0) & (F.col("b") == 1)).alias("right_only"),
    )


def flag_members(df: DataFrame, keys: DataFrame, on: str, name: str) -> DataFrame:
    """Add a flag: does the row's key occur in the other table?"""
    members = keys.select(on).dropna().distinct().withColumn("_hit", F.lit(True))
    return attach(df, members, [on]).withColumn(name, F.coalesce("_hit", F.lit(False))).drop("_hit")


def map_join(df: DataFrame, mapping: DataFrame, on: str, strict: bool = True) -> DataFrame:
    """Left join to a mapping that must not multiply rows.

    Exact repeats in the mapping are dropped first. A key that still maps to two
    different rows raises an error when ``strict``; otherwise the smallest row
    is taken.
    """
    rest = [c for c in mapping.columns if c != on]
    grouped = mapping.distinct().groupBy(on).agg(F.min(F.struct(*rest)).alias("_m"), F.count(F.lit(1)).alias("_n"))
    if strict:
        fail = F.raise_error(F.concat(F.lit("mapping is not unique for "), F.col(on).cast("string")))
        grouped = grouped.withColumn("_m", F.when(F.col("_n") == 1, F.col("_m")).otherwise(fail))
    return attach(df, grouped.select(on, *[F.col("_m")[c].alias(c) for c in rest]), [on])


def align_columns(frames: Mapping[str, tuple[DataFrame, str]], key: str) -> DataFrame:
    """Put one column of each frame side by side by key: name → (frame, column).

    Keys missing from a frame give null there. A frame with several rows for a
    key raises an error. The frames are stacked and grouped once instead of
    joined one by one.
    """
    kinds = {name: df.schema[c].dataType for name, (df, c) in frames.items()}
    stacked = [
        df.select(key, F.lit(name).alias("_of"), *[(F.col(c) if n == name else F.lit(None)).cast(k).alias(n) for n, k in kinds.items()])
        for name, (df, c) in frames.items()
    ]
    fail = F.raise_error(F.concat(F.lit("several rows for "), F.coalesce(F.col(key).cast("string"), F.lit("null"))))
    once = lambda n: F.when(F.count_if(F.col("_of") == n) <= 1, F.max(n)).otherwise(fail)
    return reduce(DataFrame.unionByName, stacked).groupBy(key).agg(*[once(n).alias(n) for n in kinds])


def fuzzy_join(
    left: DataFrame, right: DataFrame, lcol: str, rcol: str, threshold: float = 0.9, score: str = "score"
) -> DataFrame:
    """Left join to the most similar name, if its similarity reaches the threshold.

    Similarity is 1 − Levenshtein ÷ longer length; equal scores go to the
    smallest name. Candidates come from equality joins only, and are searched by
    rising number of edits: first equal names, then names one edit apart, which
    share a text with one letter left out (no other name of three letters or more
    can be as similar, so what is found ends the search). For more edits t, names
    share, unchanged, at least one of any t + 1 pieces of the right name, shifted
    by at most t (the pigeonhole filter of partition-based similarity joins). One
    piece more than needed is cut, so that the most frequent piece of a name can
    be left out. Where two edits are allowed and a name's other pieces are
    frequent too, as those of a long common prefix are, texts with two letters
    left out are looked up instead. A name no longer than the edits it allows,
    possible at thresholds of a half and less, need not keep any piece; such
    pairs share letters.
    """
    if not 0 < threshold <= 1:
        raise ValueError("the threshold is above 0 and at most 1")
    names_l = left.select(F.col(lcol).alias("_l")).dropna().distinct()
    names_r = right.select(F.col(rcol).alias("_r")).dropna().distinct()
    exact = names_l.join(names_r, F.col("_l") == F.col("_r"), "inner").withColumn("_s", F.lit(1.0))
    rest = names_l.join(names_r, F.col("_l") == F.col("_r"), "left_anti")
    near = _scored(one_edit_matches(rest, names_r, 1.0 - threshold), threshold)
    ended = near.filter((F.length("_l") >= 3) & (F.levenshtein("_l", "_r") == 1)).select("_l")
    pairs = further_matches(rest.join(ended, "_l", "left_anti"), names_r, 1.0 - threshold)
    scored = near.unionByName(_scored(pairs, threshold))
    # the best candidate is an aggregate: map-side combine keeps one per name and task
    best = scored.groupBy("_l").agg(F.min(F.struct((-F.col("_s")).alias("s"), "_r")).alias("_b"))
    best = best.select("_l", F.col("_b._r").alias("_r"), (-F.col("_b.s")).alias("_s"))
    found = exact.unionByName(best).select(F.col("_l").alias(lcol), F.col("_r").alias("_match"), F.col("_s").alias(score))
    matched = attach(left, found, [lcol])
    if rcol in left.columns:
        raise ValueError(f"rename {rcol}: both sides hold it")
    # the right table is keyed by name here; several rows of one name all join
    out = matched.join(pinned_if_small(right)[0], F.col("_match") == F.col(rcol), "left")
    return out.drop("_match")


#: A key that more right names share is frequent.
HOT_NAMES = 64


def _scored(pairs: DataFrame, threshold: float) -> DataFrame:
    longer = F.greatest(F.length("_l"), F.length("_r"))
    return pairs.withColumn("_s", 1 - F.levenshtein("_l", "_r") / longer).filter(F.col("_s") >= threshold - 1e-12)


def _meet(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Join of rows that names were cut into.

    Spark guesses the size of such rows from the table they come from, some
    thousand times too small, and may broadcast either side. Here the right side
    is broadcast if it was measured to be small, and else both are shuffled.
    """
    small, table = pinned_if_small(right)
    return (left.hint("merge") if table is None else left).join(small, list(on), how)


def _shortened(name: Column, letters: int) -> Column:
    """The text with up to ``letters`` letters left out, each result once."""
    texts = F.array(name)
    for _ in range(letters):
        fewer = F.transform(texts, lambda x: F.transform(F.sequence(F.lit(1), F.length(x)), lambda i: F.concat(F.substring(x, 1, i - 1), x.substr(i + 1, F.length(x)))))
        texts = F.array_distinct(F.concat(texts, F.flatten(F.filter(fewer, lambda x: F.size(x) > 0))))
    return texts


def _deletion_matches(names_l: DataFrame, names_r: DataFrame, share: float, letters: int) -> DataFrame:
    """Pairs that share a text with up to ``letters`` letters left out: among them all that far apart in edits."""
    l = names_l.select("_l", F.explode_outer(_shortened(F.col("_l"), letters)).alias("_text"))  # noqa: E741
    r = names_r.select("_r", F.explode_outer(_shortened(F.col("_r"), letters)).alias("_text"))
    longer = F.greatest(F.length("_l"), F.length("_r"))
    allowed = (F.abs(F.length("_l") - F.length("_r")) <= letters) & (_edits(longer, share) >= letters)
    return _meet(l, r, ["_text"]).filter(allowed).select("_l", "_r").distinct()


def one_edit_matches(names_l: DataFrame, names_r: DataFrame, share: float) -> DataFrame:
    """Distinct pairs (_l, _r) that hold all names one edit apart."""
    return _deletion_matches(names_l, names_r, share, 1)


def further_matches(names_l: DataFrame, names_r: DataFrame, share: float) -> DataFrame:
    """Distinct pairs (_l, _r) that hold all pairs within the edits allowed, where these are two or more."""
    pairs = _piece_matches(names_l, names_r, share)
    return pairs.unionByName(_letter_matches(names_l, names_r, share)).distinct() if share >= 0.5 else pairs


def _edits(length, share: float):
    return F.floor(length * F.lit(share) + 1e-9).cast("int")


def _piece(total, n, i):
    """Start (1-based) and length of piece i of n of a text of this length."""
    start = F.floor(total * i / n).cast("int")
    return start + 1, F.floor(total * (i + 1) / n).cast("int") - start


def _letters(c):
    """A text's letters, each with how often it has occurred so far: a multiset as a set."""
    chars = F.filter(F.split(c, ""), lambda x: x != "")
    seen = lambda x, i: F.size(F.filter(F.slice(chars, 1, i + 1), lambda y: y == x)).cast("string")
    return F.transform(chars, lambda x, i: F.concat(x, F.lit("\n"), seen(x, i)))


def _letter_matches(names_l: DataFrame, names_r: DataFrame, share: float) -> DataFrame:
    """Candidate pairs whose right name is no longer than the edits allowed.

    Within t edits of the longer length n, texts have n − t letters in common.
    Letters are put in order of rarity; then two such texts meet in a letter
    among all but their last n − t − 1 ones, and only those letters are joined.
    """
    right = names_r.select("_r", F.explode(_letters(F.col("_r"))).alias("_c"))
    rare = right.groupBy("_c").agg(F.count(F.lit(1)).alias("_f"))

    def ordered(names, letters, name):
        rows = letters.join(rare, "_c", "left").groupBy(name)
        return rows.agg(F.sort_array(F.collect_list(F.struct(F.coalesce("_f", F.lit(0)).alias("_f"), "_c"))).alias("_o"))

    by_r = ordered(names_r, right, "_r").select("_r", F.length("_r").alias("_n"), F.posexplode("_o").alias("_pr", "_x"))
    by_l = ordered(names_l, names_l.select("_l", F.explode(_letters(F.col("_l"))).alias("_c")), "_l")
    size = F.length("_l")
    lengths = F.sequence(F.ceil(size * F.lit(1.0 - share) - 1e-9).cast("int"), F.floor(size / F.lit(1.0 - share) + 1e-9).cast("int"))
    spans = by_l.select("_l", "_o", F.explode(lengths).alias("_n")).withColumn("_most", F.greatest(size, F.col("_n")))
    spans = spans.withColumn("_t", _edits(F.col("_most"), share)).filter(F.col("_n") <= F.col("_t"))
    spans = spans.withColumn("_m", F.greatest(F.lit(1), F.col("_most") - F.col("_t")))
    probe = spans.select("_l", "_n", "_m", F.posexplode("_o").alias("_pl", "_x")).filter(F.col("_pl") <= F.length("_l") - F.col("_m"))
    probe = probe.select("_l", "_n", "_m", F.col("_x._c").alias("_c"))
    index = by_r.select("_r", "_n", "_pr", F.col("_x._c").alias("_c"))
    met = _meet(probe, index, ["_n", "_c"]).filter(F.col("_pr") <= F.col("_n") - F.col("_m"))
    return met.select("_l", "_r").distinct()


def _piece_matches(names_l: DataFrame, names_r: DataFrame, share: float) -> DataFrame:
    """Distinct candidate pairs (_l, _r), complete where two edits or more are allowed and the right name is longer than that."""
    n_len = F.length("_r")
    # number of pieces for edits t: t + 2, one of them spare, if the text is long enough
    pieces = F.least(F.col("_t") + 2, F.greatest(n_len, F.col("_t") + 1))
    # partners may be longer than the right name, which allows more edits: keep one set per t
    longest = F.floor(n_len / F.lit(1.0 - share) + 1e-9).cast("int")
    sets = names_r.select(
        "_r", F.explode(F.sequence(_edits(n_len, share), _edits(longest, share))).alias("_t")
    ).filter((F.col("_t") > 1) & (n_len > F.col("_t")))
    cut = sets.select("_r", "_t", pieces.alias("_p")).select(
        "_r", "_t", "_p", F.explode(F.sequence(F.lit(0), F.col("_p") - 1)).alias("_i")
    )
    at, size = _piece(F.length("_r"), F.col("_p"), F.col("_i"))
    key = ["_t", "_p", "_n", "_i", "_text"]
    right = cut.select(
        "_r", "_t", "_p", F.length("_r").alias("_n"), "_i", F.substring(F.col("_r"), at, size).alias("_text")
    )
    freq = right.groupBy(*key).agg(F.count(F.lit(1)).alias("_f"))
    # rank the pieces of one name by frequency and keep t + 1; a name has a handful of pieces
    ranked = right.hint("merge").join(freq, key).groupBy("_r", "_t").agg(
        F.slice(F.sort_array(F.collect_list(F.struct("_f", "_i", "_p", "_n", "_text"))), 1, F.first("_t") + 1).alias("_k")
    )
    # names allowed two edits whose kept pieces are frequent go another way
    hot = (F.col("_t") == 2) & F.exists("_k", lambda x: x["_f"] > HOT_NAMES)
    ranked = ranked.withColumn("_hot", hot)
    kept = ranked.select("_r", "_t", "_hot", F.explode("_k").alias("_k")).select("_r", "_t", "_hot", "_k._p", "_k._n", "_k._i", "_k._text")
    kept = written(kept, "fuzzy-pieces")

    l_len = F.length("_l")
    # a number of its own: a name gives thousands of rows below, which adaptive coalescing cannot see
    spark = names_l.sparkSession
    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    spans = names_l.repartition(tasks, F.xxhash64("_l")).select(
        "_l",
        F.explode(
            F.sequence(
                F.ceil(l_len * F.lit(1.0 - share) - 1e-9).cast("int"),
                F.floor(l_len / F.lit(1.0 - share) + 1e-9).cast("int"),
            )
        ).alias("_n"),
    )
    spans = spans.withColumn("_t", _edits(F.greatest(l_len, F.col("_n")), share)).filter(
        (F.col("_t") > 1) & (F.abs(l_len - F.col("_n")) <= F.col("_t")) & (F.col("_n") > F.col("_t"))
    )
    spans = spans.withColumn("_p", F.least(F.col("_t") + 2, F.greatest(F.col("_n"), F.col("_t") + 1)))
    spots = spans.select("*", F.explode(F.sequence(F.lit(0), F.col("_p") - 1)).alias("_i")).select(
        "*", F.explode(F.sequence(-F.col("_t"), F.col("_t"))).alias("_d")
    )
    at, size = _piece(F.col("_n"), F.col("_p"), F.col("_i"))
    probe = spots.withColumn("_at", at + F.col("_d")).withColumn("_size", size).filter(
        (F.col("_at") >= 1) & (F.col("_at") + F.col("_size") - 1 <= l_len)
    ).select("_l", "_t", "_p", "_n", "_i", F.substring(F.col("_l"), F.col("_at"), F.col("_size")).alias("_text"))
    pairs = _meet(probe, kept.filter("NOT _hot"), key).select("_l", "_r")
    hot_names = kept.filter("_hot").select("_r").distinct()
    # left names that hold one of those frequent pieces
    hot_keys = kept.filter("_hot").select(*key).distinct()
    there = _meet(probe, hot_keys, key, "left_semi").select("_l").distinct()
    return pairs.unionByName(_deletion_matches(there, hot_names, share, 2)).distinct()
