"""Windows, hits and cuts against plain Python."""

import hashlib
import random
import re

import pytest

from tabloom.llm import decontaminate as D

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def plain(docs, items, width=10):
    windows = {}
    for item, text in items:
        w = words(text)
        n = min(width, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[i : i + n]), set()).add("" if item is None else str(item))
    for doc_id, text in docs:
        w, hit, found = words(text), set(), set()
        for n in {len(x) for x in windows}:
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in windows:
                    hit |= set(range(i, i + n))
                    found |= windows[tuple(w[i : i + n])]
        yield doc_id, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)


def cases():
    rng = random.Random(4)
    vocab = ["alpha", "Beta", "gamma", "É", "é", "delta9", "x"]
    items = [(k, " ".join(rng.choices(vocab, k=rng.choice([2, 3, 9, 10, 11, 25])))) for k in range(30)]
    items += [(100, "one two"), (101, None), (102, "..."), (None, "null id item words"), (103, items[5][1]), (5, items[5][1]), (11, "one two")]
    docs = [(k, ", ".join(rng.choices(vocab, k=rng.choice([0, 1, 9, 12, 60])))) for k in range(150)]
    docs += [(200 + k, f"pre; {t} -- {t} post") for k, (_, t) in enumerate(items) if t] + [(500, None), (501, ""), (None, "say one-two!"), (7, docs[7][1]), (502, "ONE\nTWO three"), (503, "pad " * 30_000 + "one two")]
    return docs, items


@pytest.mark.parametrize("broadcast", [True, False])
def test_report_matches_plain_python(spark, docs_of, monkeypatch, broadcast):
    if not broadcast:
        monkeypatch.setattr(D, "measured", lambda df, *_: df)
    docs, items = cases()
    bench = spark.createDataFrame([(i, t, 1, "w") for i, t in items], "item_id long, text string, n int, window string")
    got = D.report(docs_of(docs), bench)
    assert got.columns == ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(plain(docs, items), key=str)


def test_removal_of_documents_and_spans(spark, docs_of):
    docs, items = cases()
    bench = spark.createDataFrame(items, "item_id long, text string")
    frame = docs_of(docs)
    clean = sorted((d, t) for (d, t), r in zip(docs, plain(docs, items)) if not r[5] and d is not None)
    out = D.remove_documents(frame, bench)
    assert sorted((r.doc_id, r.text) for r in out.filter("text is not null").collect()) == [x for x in clean if x[1] is not None] and out.columns == frame.columns
    assert out.filter("text is null").count() == 1
    cut = D.remove_spans(frame, bench)
    assert cut.count() == len(docs) and cut.columns == frame.columns
    by_id = {r.doc_id: r.text for r in cut.collect()}
    assert by_id[502] == "three" and by_id[501] == "" and by_id[500] is None and by_id[None] == "say "
    small = spark.createDataFrame([(1, "mid1 mid2")], "item_id long, text string")
    assert D.remove_spans(docs_of([(1, "  a, MID1 - mid2; b mid1 c")]), small).first().text == "  a, b mid1 c"


def test_empty_tables(spark, docs_of):
    none = spark.createDataFrame([], "item_id long, text string")
    assert D.report(docs_of([]), none).count() == 0
    assert [r.contaminated for r in D.report(docs_of([(1, "a b")]), none).collect()] == [False]


def test_columns_of_the_same_names(spark):
    small = spark.createDataFrame([(1, "mid1 mid2")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "a mid1 mid2 b", "k", 5, [1]), (2, "clean", "x", 6, [2])], "doc_id long, text string, _k string, _h int, _spans array<int>")
    out = D.remove_documents(docs, small)
    assert out.columns == docs.columns and [tuple(r) for r in out.collect()] == [(2, "clean", "x", 6, [2])]
    assert sorted((r.text, r["_k"], r["_h"]) for r in D.remove_spans(docs, small).collect()) == [("a b", "k", 5), ("clean", "x", 6)]
