"""Runs against a plain search of all periods and stretches, and the query against the whole contract done plainly."""

import hashlib
import random
import zlib

import pytest
from tabloom.llm import periodic_runs as P
from tabloom.llm.queries import QUERIES


def plain(words, least=6, exponent=4):
    """Every longest stretch of every period, smallest period first; equal stretches belong to the smallest."""
    found = {}
    for q in range(1, len(words) // exponent + 1):
        i = 0
        while i + q < len(words):
            if words[i] != words[i + q]:
                i += 1
                continue
            a = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            if i - a + q >= max(least, exponent * q):
                found.setdefault((a, i - a + q), q)
    return sorted((a, q, n) for (a, n), q in found.items())


def plain_kept(words, runs):
    gone = {i for a, q, n in runs for i in range(a + q, a + n)}
    return b" ".join(w for i, w in enumerate(words) if i not in gone)


def texts(seed=0):
    rng = random.Random(seed)
    out = ["", None, " \t\n ", "one", "a a a a a", "a a a a a a", "a b " * 3, "a b " * 4, "a b a b a b a b a", "x " * 700, "p q r " * 900 + "s"]
    for _ in range(150):  # random words of few kinds, with powers of random roots in them
        words = []
        while len(words) < rng.choice([5, 40, 300]):
            root = [rng.choice("abc") for _ in range(rng.choice([1, 1, 2, 3, 4, 5, 7, 8, 13, 16, 31]))]
            words += root * rng.choice([1, 1, 1, 2, 4, 5]) + root[: rng.randrange(len(root) + 1)]
        out.append(rng.choice([" ", "\n", "\t "]).join(words))
    word = lambda: f"w{rng.randrange(10**6)}"
    for period, times in ((1500, 5), (4096, 4), (2047, 6), (3000, 3)):  # periods above a tile's width
        root = [word() for _ in range(period)]
        out.append(" ".join([word() for _ in range(777)] + root * times + root[:5] + [word() for _ in range(99)]))
    out.append(" ".join((["k"] * 9 + ["l"] * 7 + ["m", "n"] * 4) * 60 + ["k"]))  # runs inside runs
    return out


@pytest.mark.parametrize("tile, piece", [(P.TILE, P.PIECE), (16, 2000)])
def test_runs_and_collapsed_text_equal_the_plain_search(spark, docs_of, monkeypatch, tile, piece):
    monkeypatch.setattr(P, "TILE", tile)
    monkeypatch.setattr(P, "PIECE", piece)
    rows = list(enumerate(texts()))
    got = {r.doc_id: r for r in P.periodic_runs(docs_of(rows)).collect()}
    assert len(got) == len(rows)
    seen = 0
    for d, text in rows:
        words = (text or "").encode().split()
        runs = plain(words)
        assert [(r.start, r.period, r.length) for r in got[d].runs] == runs, (d, text[:200])
        assert got[d].collapsed.encode() == plain_kept(words, runs)
        seen += len(runs)
    assert seen > 300


def test_tiles_are_cut_and_stitched():
    """In the driver: every fragment of a long run lies in a tile of its own, and they chain without a gap."""
    import numpy as np

    ids = np.array(list(range(9)) * 3000 + [77], np.int32)
    pieces = []
    for octave, _, places in P.boundaries([ids], 4):
        for first, part, own in P.tiles(ids, octave, places):
            assert len(part) <= max(P.TILE, 8 << octave) + (6 << octave)
            pieces += P.solve(part.tolist(), own.tolist(), octave, first, 6, 4)
    assert {q for q, _, _ in pieces} == {9} and len(pieces) > 5
    pieces.sort(key=lambda x: x[1])
    assert pieces[0][1] == 0 and max(b for _, _, b in pieces) == 9 * 2999
    assert all(b >= c for (_, _, b), (_, c, _) in zip(pieces, pieces[1:]))


def test_z_function_and_other_limits(spark, docs_of):
    assert P.z_function([]) == [] and P.z_function(list("aabaab")) == [6, 1, 0, 3, 1, 0]
    rows = [(1, "a b c " * 5), (2, "d " * 12)]
    got = {r.doc_id: r for r in P.periodic_runs(docs_of(rows), least=16, exponent=5).collect()}
    assert [tuple(r) for r in got[1].runs] == [] and got[2].runs == []
    with pytest.raises(ValueError):
        P.periodic_runs(docs_of(rows), exponent=3)


def test_repeated_rows_null_ids_clashing_names_and_empty_tables(spark, docs_of):
    text = "start " + "go on " * 6 + "end"
    rows = [(1, text), (1, text), (1, "other " * 7), (None, text), (None, None)]
    got = P.periodic_runs(docs_of(rows).selectExpr("doc_id", "text", "size AS key", "part AS kind", "score AS runs", "lang AS ids"))
    assert got.columns == ["doc_id", "runs", "collapsed"]
    assert sorted(((r.doc_id, [tuple(x) for x in r.runs], r.collapsed) for r in got.collect()), key=str) == sorted(
        [(1, [(1, 12, 2)], "start go on end")] * 2 + [(1, [(0, 7, 1)], "other"), (None, [(1, 12, 2)], "start go on end"), (None, [], "")], key=str)
    assert P.periodic_runs(docs_of([])).count() == 0
    names = P.periodic_runs(docs_of(rows).selectExpr("cast(doc_id AS string) AS name", "text AS body"), id_col="name", text_col="body")
    assert {r.doc_id for r in names.collect()} == {"1", None}


def contract(doc_id, text):
    words = (text or "").encode().split()
    n = len(words)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = plain(words)
    best = None
    for a, q, m in runs:
        if best is None or m * best[2] > best[1] * q:
            best = (a, m, q)
    lines = "".join(f"{a},{m},{q}\n" for a, q, m in runs)
    four = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (doc_id, len(runs), *four, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(plain_kept(words, runs)).hexdigest())


def test_query_equals_the_contract_done_plainly(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").limit(150)
    extra = [(10**7 + k, t, ) for k, t in enumerate(texts(1)[:60])] + [(None, "b " * 9), (10**8, None)]
    docs.unionByName(spark.createDataFrame(extra, "doc_id long, text string")).write.parquet(str(tmp_path / "documents.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    found = QUERIES["op11_periodic_runs"](spark, str(tmp_path))
    assert found.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    want = sorted((contract(r.doc_id, r.text) for r in docs.collect()), key=str)
    assert sorted(map(tuple, found.collect()), key=str) == want
    assert sum(r[1] > 0 for r in want) > 20
