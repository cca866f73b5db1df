"""Personal data by rules, and by bootstrapped contextual patterns. DataFrame functions only.

Seeds are what the base rules find: e-mail addresses, IPv4 addresses, card
numbers and phone numbers. The two words before a seed are its lexical pattern.
Patterns and the instances seen behind them form a graph:

* a pattern's confidence is the mean score of the occurrences behind it, over all
  its occurrences in all texts, whatever stands there;
* an instance's score is 1 for a seed and otherwise the confidence of its best
  pattern, if it has the shape of an identifier.

A word that stands in a base span counts as that seed, so seeds may hold blanks.
Behind a pattern stands the run of up to ``RUN`` words that has a shape of the
kinds of seeds which induced the pattern: numbers in several groups behind cards,
phones and addresses of machines, spelled addresses (``jane [at] mail``,
``jane[at]mail``) behind e-mail addresses, and one word with a digit behind any.

Both are iterated ``rounds`` times with Spark joins and groupings. A pattern that
ends above ``confidence`` and was induced by at least ``support`` different seeds
discovers the identifiers behind it that no rule found. They are spans of kind
``id``; base spans stay as they are, and the counts are of base spans.

A pattern is looked up in the texts if at least ``support`` different seeds induced
it, whatever the size of the corpus. The table of patterns is broadcast if it is
measured to be small and joined by shuffle otherwise.

The rules' expressions are written so that Java's matcher neither recurses nor
tries a run of characters from each of its places: what must be a maximal run
starts where no run goes on, and loops are possessive. Tests compare them with
the plain expressions on random texts.

Cases: null and empty texts have no spans; repeated rows get equal results;
equal ids with different texts are kept apart; an empty table gives no rows;
further columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloom.llm.measured import measured
from tabloom.plans.written import written

#: Kinds in the order of the result, each with a cheap test and its expression.
EMAIL = (r"@", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = (r"[0-9]\.[0-9]", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = (r"[0-9](?:[\x20-]?[0-9]){11}", r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){11,18}+(?![\x20-]?[0-9])")
PHONE = (r"\+[0-9]", r"\+[0-9][\x20().0-9-]+[0-9]")
KINDS = ["email", "ip", "card", "phone"]
SPACE = r"[\x20\x09-\x0D]"
#: How far back a seed's two words are looked for, and what an identifier looks like.
REACH = 200
SHAPE = r"^[\x21-\x7E]*[0-9][\x21-\x7E]*$"
#: Words of an identifier at most; groups of a number; an address in which marks or "at" and "dot" are spelled.
RUN = 6
NUMBER = r"^[+(]{0,2}[0-9][0-9().x-]*+(?: [(]?[0-9][0-9().x-]*+)++"
SPELLED = r"(?i)^[a-z0-9._%+-]++ (?:at|@|[\[({<]at[\])}>]) [a-z0-9.-]*[a-z0-9](?: (?:dot|[\[({<]dot[\])}>]) [a-z0-9-]*[a-z0-9])*+"
MARKED = r"^[\x21-\x7E]*[A-Za-z0-9][@%+\[\](){}<>*#=~_]++[\x21-\x7E]*[A-Za-z0-9]"
AROUND = r"[\"'()\[\]{}<>,;:.!?|]"
#: What a word must hold to have a shape by itself, and the word that may stand behind the first one of a spelled address.
SIGN = r"[0-9@%+\[\](){}<>*#=~_]"
AT = f"^{AROUND}*+(?:at|@){AROUND}*+$"
#: Bits of the test whether a pair of words may be a pattern.
BITS = 1 << 18


def _matches(text: Column, rule: tuple[str, str], kind: str) -> Column:
    """All matches of an expression, leftmost first: start and end in code points, and the string."""
    quick, pattern = rule
    between, found = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pairs = F.zip_with(F.slice(between, 1, F.size(found)), found, lambda b, m: F.struct(F.length(b).alias("gap"), m.alias("m")))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int,m:string>>").alias("out"))

    def place(acc, p):
        a = acc["at"] + p["gap"]
        b = a + F.length(p["m"])
        return F.struct(b.alias("at"), F.concat(acc["out"], F.array(F.struct(a.alias("start"), b.alias("end"), p["m"].alias("m")))).alias("out"))

    placed = F.aggregate(pairs, start, place, lambda acc: acc["out"])
    return F.when(text.rlike(quick), placed).otherwise(F.array().cast("array<struct<start:int,end:int,m:string>>"))


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _luhn(m: Column) -> Column:
    """Whether the digits pass the check sum."""
    turned = F.split(F.reverse(_digits(m)), "")
    values = F.transform(F.filter(turned, lambda d: d != ""), lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(d.cast("int") * 2 - F.when(d.cast("int") > 4, 9).otherwise(0)))
    return F.aggregate(values, F.lit(0), lambda a, x: a + x) % 10 == 0


def _bytes_of_ip(m: Column) -> Column:
    """Whether all parts are at most 255, however many zeros they begin with."""

    def small(p):
        bare = F.regexp_replace(p, "^0+", "")
        return (F.length(bare) <= 3) & (F.coalesce(F.substring(bare, 1, 3).try_cast("int"), F.lit(0)) <= 255)

    return F.forall(F.split(m, r"\."), small)


def base_spans(text: Column) -> Column:
    """Spans of the base rules, sorted by start and then by kind as listed."""

    def kept(rule, kind, test):
        good = F.filter(_matches(text, rule, kind), lambda x: test(x["m"]))
        return F.transform(good, lambda x: F.struct(x["start"].alias("start"), F.lit(KINDS.index(kind)).alias("order"), x["end"].alias("end"), F.lit(kind).alias("kind"), x["m"].alias("m")))

    every = F.concat(
        kept(EMAIL, "email", lambda m: F.lit(True)), kept(IP, "ip", _bytes_of_ip), kept(CARD, "card", _luhn),
        kept(PHONE, "phone", lambda m: F.length(_digits(m)).between(9, 15)),
    )
    return F.array_sort(every)


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def _bare(token: Column) -> Column:
    """A token without punctuation around it."""
    return F.regexp_replace(token, f"^{AROUND}++|{AROUND}++$", "")


def seeds(spans: DataFrame) -> DataFrame:
    """``pattern`` (two words before), ``instance`` and ``kind`` of every base span that has two words before it."""
    each = spans.select(F.explode("seen").alias("x")).select("x.pattern", "x.instance", "x.kind")
    return each.filter(F.col("pattern") != "")


def _context(text: Column, start: Column) -> Column:
    """The two words before a place, lower-cased and joined by a blank; empty if there are not two within reach."""
    low = F.greatest(start - REACH, F.lit(0))
    before = F.substring(text, low + 1, start - low)
    two = F.regexp_extract(before, r"(?:^|[\x20\x09-\x0D])([^\x20\x09-\x0D]++)[\x20\x09-\x0D]+([^\x20\x09-\x0D]++)[\x20\x09-\x0D]+$", 0)
    return F.lower(F.array_join(F.filter(F.split(two, SPACE + "+"), lambda w: w != ""), " "))


def _words_of(text: Column, base: Column) -> Column:
    """Numbers of the words that begin in base spans; a span within a word counts if only punctuation stands before it there."""
    start = F.struct(F.lit(0).alias("at"), F.lit(0).alias("n"), F.array().cast("array<int>").alias("out"))

    def place(acc, x):
        between = F.substring(text, acc["at"] + 1, x["start"] - acc["at"])
        n = acc["n"] + F.size(F.split(between, SPACE + "+")) - 1
        whole = F.substring(text, F.greatest(x["start"] - REACH, F.lit(0)) + 1, F.least(x["start"], F.lit(REACH))).rlike(f"(?:^|{SPACE}){AROUND}*+$")
        last = n + F.size(F.split(x["m"], SPACE + "+")) - 1
        first = F.when(whole, n).otherwise(n + 1)
        numbers = F.when(first <= last, F.sequence(first, last)).otherwise(F.array().cast("array<int>"))
        return F.struct(x["start"].alias("at"), n.alias("n"), F.concat(acc["out"], numbers).alias("out"))

    return F.aggregate(base, start, place, lambda acc: F.array_distinct(acc["out"]))


def _run(w: Column, i: Column) -> Column:
    """The word, or the words from it on where a number or a spelled address may go on behind a blank."""
    word, after = F.get(w, i), F.lower(F.get(w, i + 1))
    number = F.substring(word, 1, 1).between("0", "9") | F.substring(word, 1, 1).isin("+", "(")
    spelled = _bare(after).isin("at", "@") | after.rlike(r"^[{<]at[}>]$")
    return F.when((number & after.rlike("^[(]?[0-9]")) | F.coalesce(spelled, F.lit(False)), F.array_join(F.slice(w, i + 1, RUN), " ")).otherwise(word)


def _shape(run: Column, numeric: Column, mail: Column) -> Column:
    """The identifier at the start of a run, without punctuation around it; empty if there is none."""
    word = F.get(F.split(run, " "), F.lit(0))
    lead = F.regexp_replace(run, r"^[\"'\[\]{}<>,;:.!?|]++", "")
    number = F.regexp_replace(F.regexp_extract(lead, NUMBER, 0), f"{AROUND}++$", "")
    spelled = F.regexp_extract(F.regexp_replace(run, f"^{AROUND}++", ""), SPELLED, 0)
    one = _bare(word)
    single = (F.length(one) >= 6) & (one.rlike(SHAPE) | (mail & one.rlike(MARKED)))
    return F.when(numeric & (F.length(number) >= 6), number).when(mail & (F.length(spelled) >= 6), spelled).when(single, one).otherwise(F.lit(""))


def _lowered(text: Column) -> Column:
    """The words of a text, lower-cased."""
    return F.split(F.lower(text), SPACE + "+")


def occurrences(docs: DataFrame, patterns: DataFrame) -> DataFrame:
    """Places in all texts where a pattern stands before a word that can score: document key, word number, run, and whether a base span is there.

    ``docs(k, h, text, own)`` holds with each text the numbers of its words in base spans,
    so that a place is one row from its word on. A word can score if it is in a base span,
    has the shape of an identifier behind some pattern, or may be a seed that is shorter than that
    (an address; numbers of seeds have six characters). The others score 0 and are only
    counted, by ``totals``.
    """
    known = measured(patterns)
    words = docs.select("k", "h", "own", F.split(F.col("text"), SPACE + "+").alias("w"), _lowered(F.col("text")).alias("low"))
    at_next = lambda i: F.coalesce(F.get("low", i + 1).rlike(AT), F.lit(False))
    numbers = F.filter(F.sequence(F.lit(2), F.size("w") - 1), lambda i: F.get("w", i).rlike(SIGN) | at_next(i) | F.array_contains("own", i))
    places = F.transform(numbers, lambda i: F.struct(
        F.concat_ws(" ", F.get("low", i - 2), F.get("low", i - 1)).alias("pattern"), i.alias("at"), _run(F.col("w"), i).alias("run"), F.array_contains("own", i).alias("own")))
    # the outer form: of a plain explode the optimizer infers a filter on the array's size, and makes the places twice
    each = words.select("k", "h", F.explode_outer(F.when(F.size("w") > 2, places)).alias("x")).select("k", "h", "x.pattern", "x.at", "x.run", "x.own")
    first = _bare(F.get(F.split("run", " "), F.lit(0)))
    able = F.col("own") | (_shape(F.col("run"), F.lit(True), F.lit(True)) != "") | first.contains("@")
    found = each.filter((F.col("run") != "") & able).join(known, "pattern")
    found = found.withColumn("shape", _shape(F.col("run"), F.col("numeric"), F.col("mail")))
    bare = F.when(F.col("shape") != "", F.col("shape")).otherwise(first)
    return found.select("k", "h", "at", "pattern", "own", "shape", bare.alias("instance"))


def totals(docs: DataFrame, patterns: DataFrame) -> DataFrame:
    """``n``, the places in all texts where a pattern stands before any word.

    Pairs of words are counted before they meet the patterns, so that the join's rows
    are patterns, not places. Pairs whose hash no pattern has are left out of the counting.
    """
    low = F.col("low")
    n = F.size(low) - F.when(F.get(low, F.size(low) - 1) == "", 3).otherwise(2)
    words = docs.select(_lowered(F.col("text")).alias("low")).select("low", F.greatest(n, F.lit(0)).alias("n"))
    pairs = F.zip_with(F.slice("low", 1, F.col("n")), F.slice("low", 2, F.col("n")), lambda a, b: F.concat_ws(" ", a, b))
    each = words.select(F.explode_outer(pairs).alias("pattern")).filter(_may_be_in(patterns, "pattern"))
    counted = each.groupBy("pattern").agg(F.count(F.lit(1)).alias("n"))
    # an inner join of one row per pattern: a semi join is moved below the counting by the optimizer, and meets every place
    return counted.join(measured(patterns.select("pattern")), "pattern")


def _may_be_in(table: DataFrame, name: str) -> Column:
    """False only for values that the table does not hold: a test of one hash against ``BITS`` bits, at any number of rows."""
    place = F.pmod(F.xxhash64(F.col(name)), F.lit(BITS))
    block, bit = F.floor(place / 64).cast("int"), (place % 64).cast("int")
    set_bits = table.select(block.alias("block"), F.call_function("shiftleft", F.lit(1).cast("long"), bit).alias("bits"))
    held = {r["block"]: r["bits"] for r in set_bits.groupBy("block").agg(F.bit_or("bits").alias("bits")).collect()}
    blocks = F.split(F.lit(",".join(str(held.get(i, 0)) for i in range(BITS // 64))), ",").cast("array<bigint>")
    return F.getbit(F.get(blocks, block), bit) == 1


def confident(seen: DataFrame, seeded: DataFrame, rounds: int, confidence: float, counts: DataFrame | None = None) -> DataFrame:
    """Patterns above the confidence after some rounds of scoring patterns by instances and instances by patterns.

    ``counts(pattern, n)`` gives the places of each pattern if ``seen`` leaves out places that score 0.

    Most edges never change what a round finds and are folded into counts per
    pattern: a seed scores 1, an instance without the shape of an identifier 0, and one
    behind a single pattern that pattern's confidence. The rounds join only
    the identifiers that stand behind several patterns.
    """
    edges = seen.select("pattern", "instance", "own", (F.col("shape") != "").alias("shaped"))
    edges = written(edges.groupBy("pattern", "instance", "own", "shaped").agg(F.count(F.lit(1)).alias("n")), "pii-edges")
    known = written(seeded.select("instance").distinct(), "pii-known")
    total = lambda df, name: df.groupBy("pattern").agg(F.sum("n").alias(name))
    others = edges.filter(~F.col("own"))
    open_edges = written(others.filter("shaped").join(known, "instance", "left_anti").select("pattern", "instance", "n"), "pii-open")
    # every pattern an open instance stands behind counts for its best one
    behind = edges.select("pattern", "instance").distinct().join(open_edges.select("instance").distinct(), "instance", "left_semi")
    behind = written(behind, "pii-behind")
    several = written(behind.groupBy("instance").agg(F.count(F.lit(1)).alias("k")).filter("k > 1").select("instance"), "pii-several")
    shared = written(behind.join(several, "instance", "left_semi"), "pii-shared")
    moving = written(open_edges.join(several, "instance", "left_semi"), "pii-moving")
    parts = edges.groupBy("pattern").agg(F.sum("n").alias("all"), F.sum(F.when(F.col("own"), F.col("n")).otherwise(0)).alias("own"))
    if counts is not None:
        parts = parts.drop("all").join(counts.select("pattern", F.col("n").alias("all")), "pattern")
    parts = parts.join(total(others.join(known, "instance", "left_semi"), "seeds"), "pattern", "left")
    parts = parts.join(total(open_edges.join(several, "instance", "left_anti"), "single"), "pattern", "left").na.fill(0)
    parts = written(parts, "pii-parts")
    fixed = F.col("own") + F.col("seeds")
    now = written(parts.select("pattern", (fixed / F.col("all")).alias("confidence")), "pii-confidence")
    for _ in range(rounds):
        best = shared.join(now, "pattern").groupBy("instance").agg(F.max("confidence").alias("best"))
        gain = moving.join(best, "instance").groupBy("pattern").agg(F.sum(F.col("n") * F.col("best")).alias("gain"))
        both = parts.join(now, "pattern").join(gain, "pattern", "left")
        mean = (fixed + F.col("single") * F.col("confidence") + F.coalesce("gain", F.lit(0.0))) / F.col("all")
        now = written(both.select("pattern", mean.alias("confidence")), "pii-confidence")
    return now.filter(F.col("confidence") >= confidence)


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("k"), F.xxhash64(F.col(id_col), text).alias("h"), text.alias("text"))


def personal_data(
    docs: DataFrame, *, support: int = 5, confidence: float = 0.8, rounds: int = 3,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Per document: counts and checksum of base spans, and all spans."""
    rows = _keyed(docs, id_col, text_col)
    own = F.transform("base", lambda x: F.struct(_context(F.col("text"), x["start"]).alias("pattern"), _bare(x["m"]).alias("instance"), x["kind"].alias("kind")))
    bare = F.transform("base", lambda x: F.struct(x["start"].alias("start"), x["order"].alias("order"), x["end"].alias("end"), x["kind"].alias("kind")))
    spans = rows.withColumn("base", base_spans(F.col("text"))).select("doc_id", "k", "h", bare.alias("base"), own.alias("seen"), _words_of(F.col("text"), F.col("base")).alias("own"), "text")
    spans = written(spans, "pii-base")

    seeded = written(seeds(spans), "pii-seeds")
    mail = F.col("kind") == "email"
    each = seeded.groupBy("pattern", "instance").agg(F.max(mail).alias("mail"), F.max(~mail).alias("numeric"))
    induced = each.groupBy("pattern").agg(F.count(F.lit(1)).alias("seeds"), F.max("mail").alias("mail"), F.max("numeric").alias("numeric"))
    patterns = induced.filter(F.col("seeds") >= support).drop("seeds")
    patterns = written(patterns, "pii-patterns")
    extra = "array<struct<start:int,order:int,end:int,kind:string>>"
    if patterns.isEmpty():
        added = None
    else:
        seen = written(occurrences(spans, patterns), "pii-occurrences")
        good = confident(seen, seeded, rounds, confidence, totals(spans, patterns))
        new = seen.filter((F.col("shape") != "") & ~F.col("own")).join(good.select("pattern"), "pattern", "left_semi")
        size = F.size(F.split("shape", " "))
        new = new.groupBy("k", "h").agg(F.collect_set(F.struct("at", size.alias("words"), "shape")).alias("at"))
        # only texts with a discovery are read again, to turn word numbers into places
        again = rows.join(measured(written(new, "pii-new")), ["k", "h"]).dropDuplicates(["k", "h"])
        added = again.select("k", "h", _places(F.col("text"), F.col("at")).cast(extra).alias("added"))
    spans = spans.drop("text")
    both = spans.join(added, ["k", "h"], "left") if added is not None else spans.withColumn("added", F.lit(None).cast(extra))
    free = F.filter(F.coalesce("added", F.array().cast(extra)), lambda a: ~F.exists("base", lambda b: (a["start"] < b["end"]) & (b["start"] < a["end"])))
    both = both.withColumn("all", F.array_sort(F.concat("base", free)))
    count = lambda kind: F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return both.select("doc_id", *map(count, KINDS), F.sha2(_joined(F.col("base")).cast("binary"), 256).alias("base_sha256"), _joined(F.col("all")).alias("spans"))


def _found(word: Column, part: Column) -> Column:
    """Code points of a word before a part of it."""
    return F.instr(word, part) - 1


def _places(text: Column, numbers: Column) -> Column:
    """Spans (kind ``id``) of the runs that begin at these words, without the punctuation around them; a later run within an earlier one is left out."""
    words = F.split(text, SPACE + "+")
    gaps = F.regexp_extract_all(text, F.lit(SPACE + "+"), F.lit(0))

    def offset(i):
        return F.aggregate(F.slice(words, 1, i), F.lit(0), lambda a, x: a + F.length(x)) + F.aggregate(F.slice(gaps, 1, i), F.lit(0), lambda a, x: a + F.length(x))

    def span(x):
        first, end = F.get(words, x["at"]), x["at"] + x["words"] - 1
        parts = F.split(x["shape"], " ")
        left = offset(x["at"]) + _found(first, F.get(parts, F.lit(0)))
        right = offset(end) + _found(F.get(words, end), F.get(parts, x["words"] - 1)) + F.length(F.get(parts, x["words"] - 1))
        return F.struct(left.alias("start"), F.lit(len(KINDS)).alias("order"), right.alias("end"), F.lit("id").alias("kind"))

    within = lambda x, y: (y["at"] < x["at"]) & (x["at"] < y["at"] + y["words"])
    return F.transform(F.filter(numbers, lambda x: ~F.exists(numbers, lambda y: within(x, y) | ((y["at"] == x["at"]) & (y["words"] > x["words"])))), span)
