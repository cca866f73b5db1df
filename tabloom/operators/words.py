"""Word counts and the frequency index."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.functions.text import words
from tabloom.plans.blocks import running_total
from tabloom.plans.sizing import attach, pinned_if_small, value_table
from tabloom.plans.written import written


def word_count(df: DataFrame, col: str, stop_words: DataFrame | Sequence[str] | None = None) -> DataFrame:
    """Lower-cased, punctuation-free words and how often each occurs.

    Words are counted before stop words go: the anti join then sees one row per
    distinct word instead of one per occurrence. A stop list given as a table
    is broadcast only if it is small.
    """
    # the outer form: of a plain explode the optimizer infers a filter on the array's size, and cuts the text twice
    found = df.select(F.explode_outer(words(F.col(col))).alias("word")).filter(F.col("word") != "")
    counts = found.groupBy("word").agg(F.count(F.lit(1)).alias("num"))
    if stop_words is None:
        return counts
    if not isinstance(stop_words, DataFrame):
        stop_words = value_table(df.sparkSession, "word", stop_words, "string")
    stop, _ = pinned_if_small(stop_words.select(F.lower(stop_words.columns[0]).alias("word")).distinct())
    return counts.join(stop, "word", "left_anti")


def frequency_index(counts: DataFrame, list_size: int = 10_000) -> DataFrame:
    """Count → sorted word list, as ``num, part, words, word_count``.

    ``word_count`` is the number of words with that count. A list is cut into
    ranges of ``list_size`` words in sorted order, numbered from 0: the parts of a
    count, one after the other, are its list. The words that occur once can be a
    third of a vocabulary, so places come from one order over (count, word), cut
    into blocks, and no task holds more than a block or a part.
    """
    counts = written(counts.select("num", "word"), "word-counts")  # read several times: the words, not the texts
    placed = running_total(counts, F.col("num"), F.col("word"), {"place": F.lit(1)})
    sizes = counts.groupBy("num").agg(F.count("word").alias("word_count"))
    # what lies before a count is the running size of the smaller ones: a row per count
    upto = running_total(sizes, F.col("num"), F.col("num"), {"upto": F.col("word_count")})
    known = upto.select("num", "word_count", (F.col("upto") - F.col("word_count")).alias("before"))
    part = F.expr(f"(place - before - 1) div {int(list_size)}").alias("part")
    dealt = attach(placed, known, ["num"], "inner").select("num", part, "word", "word_count")
    return dealt.groupBy("num", "part").agg(
        F.sort_array(F.collect_list("word")).alias("words"), F.max("word_count").alias("word_count")
    )
