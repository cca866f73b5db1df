"""Base spans against the plain expressions, and discovery on texts with a known pattern."""

import hashlib
import random
import re

from tabloom.llm.pii_bootstrap import personal_data

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    values = [int(d) for d in reversed(digits)]
    return sum(v if i % 2 == 0 else (2 * v - 9 if v > 4 else 2 * v) for i, v in enumerate(values)) % 10 == 0


def passes(kind, m):
    digits = re.sub("[^0-9]", "", m)
    if kind == "ip":
        return all(int(p) <= 255 for p in m.split("."))
    if kind == "card":
        return 12 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 9 <= len(digits) <= 15


def plain(text):
    out = []
    for order, (kind, rule) in enumerate(PLAIN.items()):
        out += [(m.start(), order, kind, m.end()) for m in re.finditer(rule, text or "") if passes(kind, m.group())]
    return [f"{kind}:{a}:{b}" for a, _, kind, b in sorted(out)]


def check(docs, texts):
    for r in docs.collect():
        spans = plain(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(",".join(spans).encode()).hexdigest(), (texts[r.doc_id][:200], spans, r.spans)
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s.startswith(k + ":") for s in spans) for k in PLAIN]
        assert set(filter(None, spans)) <= set(r.spans.split(","))


def test_base_spans_match_the_plain_expressions(spark, docs_of):
    rng = random.Random(5)
    bits = ["a@b.co", "x.y+z@mail.example.org", "@", ".", "..", "1.2.3.4", "256.1.1.1", "0010.2.3.255", "4111 1111 1111 1111", "5500-0000-0000-0004", "12",
            "3", " ", "  ", "-", "--", "+1 (456) 555-2186", "+49", "é", "😀", "_", "%", "(", ")", "word", "\n", "a", "0", "4111111111111111", "b.c", ":", "+"]
    texts = {k: "".join(rng.choice(bits) for _ in range(rng.randrange(1, 40))) for k in range(1500)}
    texts |= {2000: None, 2001: "", 2002: "1" * 30_000, 2003: "1 " * 30_000, 2004: "a." * 20_000 + "@", 2005: "a@" + "b." * 20_000 + "c", 2006: "x" * 50_000, 2007: "+1" * 9_000,
              2008: "1." * 20_000, 2009: "q@r.s " * 500}
    got = personal_data(docs_of(list(texts.items())))
    assert got.columns == ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"] and got.count() == len(texts)
    check(got, texts)


def test_patterns_discover_what_no_rule_finds(spark, docs_of):
    texts = {k: f"Hello there, write to me: user{k}@mail.example.com please" for k in range(12)}
    texts |= {50: "Hello there, write to me: user[at]51 please", 51: "nothing like that user[at]51 stands here", 52: "  write  to me:  (k77-qq2), and to me: soon"}
    texts |= {100 + k: f"it was on the {20 + k}.5 of the month on the day" for k in range(30)}
    got = {r.doc_id: r.spans for r in personal_data(docs_of(list(texts.items())), confidence=0.7).collect()}
    a = texts[50].index("user[at]51")
    assert got[50] == f"id:{a}:{a + 10}" and got[51] == "" and got[101] == ""
    a = texts[52].index("k77-qq2")
    assert got[52] == f"id:{a}:{a + 7}"
    check(personal_data(docs_of(list(texts.items())), confidence=0.7), texts)


def test_repeated_rows_and_empty_table(spark, docs_of):
    rows = [(1, "me a@b.co"), (1, "me a@b.co"), (1, "none"), (None, "c@d.ee"), (None, None)]
    got = sorted((str(r.doc_id), r.n_email) for r in personal_data(docs_of(rows)).collect())
    assert got == [("1", 0), ("1", 1), ("1", 1), ("None", 0), ("None", 1)]
    assert personal_data(docs_of([])).count() == 0


def test_a_pattern_is_found_however_many_others_there_are(spark, docs_of):
    texts = {k: f"please write to user{k}@mail.example.com" for k in range(9)} | {10: "please write to user[at]51 now"}
    others = {1000 + k: f"a{k} b{k} c{k}@d.org" for k in range(9000)}
    for docs in (texts, texts | others):
        got = {r.doc_id: r.spans for r in personal_data(docs_of(list(docs.items()))).filter("doc_id < 100").collect()}
        assert got[10] == "id:16:26"


def test_seeds_with_blanks_and_shapes_by_kind(spark, docs_of):
    texts = {k: f"please call me +1 (555) 123-4{k:03d} soon" for k in range(12)} | {50: "please call me 555 123 4567, soon", 51: "please call me later-on soon"}
    texts |= {100 + k: f"mail it to user{k}@mail.example.com soon" for k in range(20)}
    texts |= {150: "mail it to jane[at]mail soon", 151: "mail it to (jane [at] mail [dot] com) soon", 152: "mail it to well-known people"}
    texts |= {200 + k: f"the card number 4111 1111 1111 1111, or card number 5500-0000-0000-000{k % 7}" for k in range(12)}
    got = {r.doc_id: r.spans for r in personal_data(docs_of(list(texts.items()))).collect()}

    def at(k, found):
        a = texts[k].index(found)
        return f"id:{a}:{a + len(found)}"

    assert got[50] == at(50, "555 123 4567") and got[51] == ""
    assert got[150] == at(150, "jane[at]mail") and got[152] == ""
    check(personal_data(docs_of(list(texts.items()))), texts)
    assert got[151] == at(151, "jane [at] mail [dot] com")


def test_scoring_rounds_equal_a_plain_loop(spark):
    """A random graph of patterns and instances, scored as the docstring says, edge by edge."""
    import random

    from tabloom.llm.pii_bootstrap import confident

    rng = random.Random(3)
    for support in (4, 40):
        seen = []
        for k in range(700):
            shaped, own = rng.random() < 0.6, rng.random() < 0.2
            instance = f"{'id' if shaped else 'w'}{rng.randrange(support * 6)}"
            seen.append((str(k), k, k, f"p{rng.randrange(9)}", own, instance if shaped else "", instance))
        seeded = [("p0", f"id{i}", "card") for i in range(0, support * 6, 5)]
        edges = [(p, i, own, s != "") for _, _, _, p, own, s, i in seen]
        known = {i for _, i, _ in seeded}
        score = [1.0 if own or i in known else 0.0 for _, i, own, _ in edges]

        def confidence():
            out = {}
            for (p, *_), s in zip(edges, score):  # noqa: B023
                out.setdefault(p, []).append(s)
            return {p: sum(v) / len(v) for p, v in out.items()}

        for _ in range(3):
            now = confidence()
            best = {}
            for p, i, *_ in edges:
                best[i] = max(best.get(i, 0.0), now[p])
            score = [1.0 if own or i in known else best[i] if shaped else 0.0 for _, i, own, shaped in edges]
        got = confident(
            spark.createDataFrame(seen, "k string, h long, at int, pattern string, own boolean, shape string, instance string"),
            spark.createDataFrame(seeded, "pattern string, instance string, kind string"), 3, 0.0)
        want = confidence()
        found = {r.pattern: r.confidence for r in got.collect()}
        assert set(found) == set(want) and all(abs(found[p] - want[p]) < 1e-12 for p in want)


def test_places_that_score_nothing_are_counted_before_they_meet_the_patterns(spark):
    """Only words that can score become rows, every place counts, and the join is above the counting."""
    from tabloom.llm.pii_bootstrap import occurrences, totals

    texts = ["write to me" + " write  to\tyou" * 300 + " Write TO user[at]51 write to a7-7b7c, write to jane at mail write to", "write to ", "write to", "", " write to x",
             "\u039f\u0394\u039f\u03a3 to x77-77 \u03bf\u03b4\u03bf\u03c2 TO y"]
    docs = spark.createDataFrame([(str(i), i, t, [3] if i == 4 else []) for i, t in enumerate(texts)], "k string, h long, text string, own array<int>")
    patterns = spark.createDataFrame([("write to", True, True), ("\u03bf\u03b4\u03bf\u03c2 to", True, False), ("nowhere to", True, True)], "pattern string, mail boolean, numeric boolean")

    def plain(pattern):
        words = [[w for w in re.split("[\x20\x09-\x0D]+", t) if w] for t in texts]
        return sum(" ".join(w[i - 2 : i]).lower() == pattern for w in words for i in range(2, len(w)))

    counted = totals(docs, patterns)
    assert {r.pattern: r.n for r in counted.collect()} == {p: plain(p) for p in ("write to", "\u03bf\u03b4\u03bf\u03c2 to")}
    plan = counted._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join") < plan.index("Aggregate")
    seen = sorted((r.k, r.instance, r.own) for r in occurrences(docs, patterns).collect())
    assert seen == [("0", "a7-7b7c", False), ("0", "jane at mail", False), ("0", "user[at]51", False), ("4", "x", True), ("5", "x77-77", False)]
