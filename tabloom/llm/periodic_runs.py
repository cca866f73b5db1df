"""Runs of periodically repeated words, found in tiles per octave of the period.

A run is a longest stretch of words with smallest period q (words q apart are
equal) whose length is at least ``least`` and ``exponent`` times q. Periods are
searched by octaves: those from S = 2^k to 2 S - 1 together. A run of such a
period covers a boundary (a multiple of S) from which at least 2 S words agree
with the words q further on. So of every octave only the boundaries count whose
next 2 S words recur at a distance within the octave; block hashes, doubled from
octave to octave, find them in a time that follows the words of the octave.

1. Documents are exploded into overlapping tiles per octave: the words around the
   boundaries that count, S before and 5 S behind them. Documents without such a
   boundary have no run and are done. Tiles, and the texts of the other documents,
   are a written table.
2. Tiles are dealt out over all tasks, whichever document they come from, and solved
   independently. At each boundary two Z-functions (of the words behind it, and of the
   words before it read backwards) tell how far the words agree with the words q
   further on; hashes decide nothing here. A period whose root is itself a power
   belongs to a shorter period and is left out.
3. What a boundary sees is an interval fragment, cut S before and 3 S behind it.
   Fragments are shuffled by document and period and stitched where they overlap.

Memory per task: ``PIECE`` words or the longest text, whichever is more, and one tile.

Cases: null, empty and blank texts have no words, no runs and an empty collapsed
text; a null id is kept; rows that repeat an id or a text are documents of their
own; an empty table gives no rows; further columns are not read, whatever their
names; of ties (runs of equal exponent) the caller decides, all runs are listed by
start, then period; texts of any length are searched whole.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabloom.llm.files import mapped
from tabloom.plans.written import written

#: Words per batch of documents, and words that a tile of a low octave spans.
PIECE, TILE = 1 << 20, 4096
#: Fixed odd multipliers of the block hashes.
MIX_A, MIX_B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)

# ------------------------------------------------------------------ boundaries


def _mixed(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    h = left * MIX_A + right
    h ^= h >> np.uint64(29)
    h *= MIX_B
    h ^= h >> np.uint64(32)
    return h


def boundaries(ids: list[np.ndarray], exponent: int):
    """(octave, document, places) whose next 2 S words recur within the octave; ``ids`` are longest first.

    Documents stand in one array with a value of its own behind each of them, so
    equal blocks never lie in two documents.
    """
    sizes = np.array([len(x) for x in ids], np.int64)
    starts = np.concatenate([[0], np.cumsum(sizes + 1)])
    line = np.zeros(int(starts[-1]), np.uint64)
    for k, x in enumerate(ids):
        line[starts[k] : starts[k] + len(x)] = x
    line[starts[1:] - 1] = np.uint64(1 << 40) + np.arange(len(ids), dtype=np.uint64)
    block, octave = _mixed(line, np.zeros_like(line)), 0
    while True:
        step = 1 << octave
        live = int(np.searchsorted(-sizes, -exponent * step, side="right"))  # documents long enough for the octave
        if not live:
            return
        block = block[: starts[live]]
        block = _mixed(block[:-step], block[step:])  # now blocks of 2 S words
        n = -(-len(block) // step)
        padded = np.zeros((n + 1) * step, np.uint64)
        padded[: len(block)] = block
        seen = (padded[step:].reshape(n, step) == padded[: n * step : step, None]).any(axis=1)
        places = np.flatnonzero(seen).astype(np.int64) * step
        if len(places):
            doc = np.searchsorted(starts, places, side="right") - 1
            for d in np.unique(doc).tolist():
                own = places[doc == d] - starts[d]
                yield octave, d, own[own < sizes[d]]
        octave += 1


def tiles(ids: np.ndarray, octave: int, places: np.ndarray):
    """(first word, its ids, places in them): each tile is as wide as a low octave's, or eight steps."""
    step = 1 << octave
    span = max(TILE, 8 * step)
    for t in np.unique(places // span).tolist():
        own = places[places // span == t]
        first, last = max(0, int(own[0]) - step), min(len(ids), int(own[-1]) + 5 * step)
        yield first, ids[first:last], own - first


# ----------------------------------------------------------------------- tiles


def z_function(s: list[int]) -> list[int]:
    """For each place, how many items agree with the beginning of ``s``."""
    n = len(s)
    z = [0] * n
    if n:
        z[0] = n
    left = right = 0
    for i in range(1, n):
        k = z[i - left] if i < right else 0
        if i + k >= right:
            k = max(0, right - i)
            while i + k < n and s[k] == s[i + k]:
                k += 1
            left, right = i, i + k
        z[i] = k
    return z


def _primes(q: int) -> list[int]:
    found, p = [], 2
    while p * p <= q:
        if q % p == 0:
            found.append(p)
            while q % p == 0:
                q //= p
        p += 1
    return [*found, q] if q > 1 else found


def solve(ids: list[int], places: list[int], octave: int, first: int, least: int, exponent: int) -> list[tuple[int, int, int]]:
    """(period, from, to) of the stretches whose words agree with those a period on; words are numbered from ``first`` on.

    Overlapping fragments are joined already, and a stretch seen whole but too
    short for a run is left out.
    """
    step, found = 1 << octave, {}
    for m in places:
        ahead = z_function(ids[m : m + 5 * step])
        far = [q for q in range(step, min(2 * step, len(ahead))) if ahead[q] >= 2 * step]
        if not far:
            continue
        low, high = max(0, m - step), min(len(ids), m + 2 * step)
        back = None
        for q in far:
            if any(ahead[q // p] >= q - q // p for p in _primes(q)):
                continue
            if back is None:
                before = ids[low:m][::-1]
                back = z_function([*before, -1, *ids[low:high][::-1]])[len(before) + 1 :]
            behind = min(back[high - m - q], step) if high - m - q < len(back) else 0
            reach = min(ahead[q], 3 * step)
            whole = (behind < step or first + m == behind, reach < 3 * step)
            found.setdefault(q, []).append((m - behind, m + reach, *whole))
    out = []
    for q, seen in found.items():
        held = None
        for a, b, left, right in [*sorted(seen), (None,) * 4]:
            if held and a is not None and a <= held[1]:
                if b > held[1]:
                    held[1], held[3] = b, right
                continue
            if held and not (held[2] and held[3] and held[1] - held[0] + q < max(least, exponent * q)):
                out.append((q, first + held[0], first + held[1]))
            held = [a, b, left, right]
    return out


# ----------------------------------------------------------------------- Spark


def _words(text: str | None) -> list[bytes]:
    return (text or "").encode().split()


def _kept(words: list[bytes], runs, as_digest: bool):
    """The text without what repeats the first period of a run."""
    if runs:
        keep = np.ones(len(words), bool)
        for r in runs:
            keep[r["start"] + r["period"] : r["start"] + r["length"]] = False
        words = [words[k] for k in np.flatnonzero(keep).tolist()]
    text = b" ".join(words)
    return hashlib.sha256(text).hexdigest() if as_digest else text.decode()


def _exploded(docs: DataFrame, exponent: int, as_digest: bool) -> DataFrame:
    """Rows of three kinds: 0 a document that is done, 1 a document that has tiles, 2 a tile."""

    def run(batches):
        part, number = TaskContext.get().partitionId(), 0

        def made(held):
            nonlocal number
            held = sorted(held, key=lambda h: -len(h[2]))
            ids, at = [], {}
            for _, _, words in held:
                at.clear()
                ids.append(np.fromiter((at.setdefault(w, len(at)) for w in words), np.int32, len(words)))
            kinds, keys, who, octaves, firsts, parts, places, texts = ([] for _ in range(8))

            def add(kind, key, ident, octave, first, ids, own, text):
                for column, value in zip((kinds, keys, who, octaves, firsts, parts, places, texts), (kind, key, ident, octave, first, ids, own, text)):
                    column.append(value)

            tiled = set()
            for octave, d, own in boundaries(ids, exponent):
                tiled.add(d)
                for first, piece, local in tiles(ids[d], octave, own):
                    add(2, number + d, None, octave, first, piece.tobytes(), local.astype(np.int32).tobytes(), None)
            for d, (ident, text, words) in enumerate(held):
                done = d not in tiled
                add(0 if done else 1, None if done else number + d, ident, None, None, None, None, _kept(words, (), as_digest) if done else text)
            number += len(held)
            shift = part << 40
            return pa.RecordBatch.from_arrays(
                [pa.array(kinds, pa.int32()), pa.array([None if k is None else k + shift for k in keys], pa.int64()), pa.array(who, id_type), pa.array(octaves, pa.int32()),
                 pa.array(firsts, pa.int64()), pa.array(parts, pa.binary()), pa.array(places, pa.binary()), pa.array(texts, pa.string())],
                names=["kind", "key", "doc_id", "octave", "first", "ids", "places", "text"])

        held, size, id_type = [], 0, None
        for batch in batches:
            id_type = batch.schema.field(0).type
            who, texts = batch.column(0), batch.column(1)
            for k in range(len(batch)):
                text = texts[k].as_py()
                words = _words(text)
                held.append((who[k].as_py(), text, words))
                size += len(words) + 1
                if size >= PIECE:
                    yield made(held)
                    held, size = [], 0
        if held:
            yield made(held)

    kind = docs.schema["doc_id"].dataType.simpleString()
    return mapped(docs, run, f"kind int, key long, doc_id {kind}, octave int, first long, ids binary, places binary, text string")


def _solved(tiles: DataFrame, least: int, exponent: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            out = [[], [], [], []]
            for key, octave, first, ids, places in zip(*(batch.column(c).to_pylist() for c in ("key", "octave", "first", "ids", "places"))):
                for row in solve(np.frombuffer(ids, np.int32).tolist(), np.frombuffer(places, np.int32).tolist(), octave, first, least, exponent):
                    for column, value in zip(out, (key, *row)):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], names=["key", "period", "a", "b"])

    return mapped(tiles, run, "key long, period long, a long, b long")


def stitched(fragments: DataFrame, least: int, exponent: int) -> DataFrame:
    """Runs (key, start, length, period): unions of overlapping fragments of a document and period that are long enough."""
    own = Window.partitionBy("key", "period").orderBy("a", "b")
    upto = F.max("b").over(own.rowsBetween(Window.unboundedPreceding, -1))
    opened = fragments.withColumn("new", F.when(F.col("a") <= upto, 0).otherwise(1))
    pieces = opened.withColumn("part", F.sum("new").over(own.rowsBetween(Window.unboundedPreceding, 0)))
    whole = pieces.groupBy("key", "period", "part").agg(F.min("a").alias("start"), F.max("b").alias("b"))
    length = F.col("b") - F.col("start") + F.col("period")
    runs = whole.select("key", "start", length.alias("length"), "period")
    return runs.filter(F.col("length") >= F.greatest(F.lit(least), exponent * F.col("period")))


def periodic_runs(docs: DataFrame, least: int = 6, exponent: int = 4, id_col: str = "doc_id", text_col: str = "text", collapsed: str = "text") -> DataFrame:
    """Per document its ``runs`` (structs of start, length, period; by start, then period) and its ``collapsed`` text.

    The collapsed text lacks the words of a run behind the run's first period; words are
    joined by one blank. With ``collapsed="sha256"`` that text's digest stands in its place.
    """
    if exponent < 4:
        raise ValueError("a boundary is sure to lie in a run only from the fourth repetition on")
    as_digest = collapsed == "sha256"
    id_type = docs.schema[id_col].dataType.simpleString()
    narrow = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    rows = written(_exploded(narrow, exponent, as_digest), "run-tiles")
    tiles = rows.filter("kind = 2").select("key", "octave", "first", "ids", "places").repartition("key", "octave", "first")
    runs = stitched(_solved(tiles, least, exponent), least, exponent)
    listed = runs.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("start", "period", "length"))).alias("runs"))
    open_docs = rows.filter("kind = 1").select("key", "doc_id", "text").join(listed, "key", "left").select("doc_id", "text", "runs")
    kind = "array<struct<start:bigint,length:bigint,period:bigint>>"

    def run(batches):
        for batch in batches:
            runs = batch.column(2).to_pylist()
            texts = [_kept(_words(batch.column(1)[k].as_py()), r, as_digest) for k, r in enumerate(runs)]
            listed = [[{c: r[c] for c in ("start", "length", "period")} for r in own or ()] for own in runs]
            struct = pa.struct([(c, pa.int64()) for c in ("start", "length", "period")])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(listed, pa.list_(struct)), pa.array(texts, pa.string())], names=["doc_id", "runs", "collapsed"])

    found = mapped(open_docs, run, f"doc_id {id_type}, runs {kind}, collapsed string")
    none = rows.filter("kind = 0").select("doc_id", F.array().cast(kind).alias("runs"), F.col("text").alias("collapsed"))
    return found.unionByName(none)


# ----------------------------------------------------------------- expressions


def longest(runs: Column) -> Column:
    """The run with the greatest length per period, compared exactly; of equals the first. Null if there is none."""
    better = lambda a, b: b["length"] * a["period"] > a["length"] * b["period"]
    return F.aggregate(runs, F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>"), lambda a, b: F.when(a.isNull() | better(a, b), b).otherwise(a))


def listing(runs: Column) -> Column:
    """A line ``start,length,period`` for each run."""
    return F.array_join(F.transform(runs, lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")


def with_repeated_tails(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and ``text``; of every tenth document, by the checksum of its id, the text from some word on repeats its first words there."""
    h = F.crc32(F.col(id_col).cast("string").cast("binary"))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), h.alias("h"))
    split = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    rows = rows.withColumn("w", F.when(F.col("h") % 10 == 0, split)).withColumn("g", F.expr("h div 10")).withColumn("n", F.size("w").cast("long"))
    rows = rows.withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
    rows = rows.withColumn("p", 1 + F.expr("(n - a) div (3 + g % 8)"))
    place = lambda i: F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p"))
    new = F.transform(F.sequence(F.lit(0).cast("long"), F.col("n") - 1), lambda i: F.get("w", place(i).cast("int")))
    return rows.select("doc_id", F.when(F.col("a").isNotNull(), F.array_join(new, " ")).otherwise(F.col("text")).alias("text"))
