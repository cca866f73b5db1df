"""The mix against water-filling and sampling in plain Python."""

import hashlib
import random
from collections import Counter

from tabloom.llm.pareto_mix import mixed, plan_mix

WEIGHTS = [3.0, 1.0, 2.0]


def size_of(text):
    return len((text or "").encode().split())


def plain_targets(sizes):
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    w = {s: WEIGHTS[k % 3] for k, s in enumerate(names)}
    total, capped = 1.5 * sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in capped]
        level = (total - sum(capped.values())) / sum(w[s] for s in free) if free else 0
        over = [s for s in free if level * w[s] > 2 * sizes[s]]
        if not over:
            return {s: capped.get(s, level * w[s]) for s in names}
        capped |= {s: 2.0 * sizes[s] for s in over}


def rows_of(seed=3):
    rng = random.Random(seed)
    rows = [(k, "w " * rng.choice([0, 1, 5, 40, 200]), rng.choice("aaaabcdé")) for k in range(900)]
    return rows + [(2000 + k, "x y", None) for k in range(20)] + [(3000, None, "a"), (None, "n n", "b"), (5, "again and again", "a"), (5, "again and again", "a"), (4000, "", "zero")]


def test_targets_and_taken_words(spark, docs_of):
    rows = rows_of()
    sizes = Counter()
    for _, t, s in rows:
        sizes[s] += size_of(t)
    want = plain_targets(sizes)
    made = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, source string, target string").repartition(4)
    got = plan_mix(made, WEIGHTS).collect()
    assert len(got) == len(rows)
    taken, by_target = Counter(), {}
    source = {(r[0], size_of(r[1])): r[2] for r in rows}
    for r in got:
        s = source[(r.doc_id, r.size)]
        assert r.source_size == sizes[s] and abs(r.target - want[s]) < 1e-6 and r.taken in (0, r.size, 2 * r.size)
        taken[s] += r.taken
        by_target[s] = r.target
    for s in sizes:
        assert abs(taken[s] - by_target[s]) <= 200, s
    again = plan_mix(made.repartition(7), WEIGHTS).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))
    for bins in (1, 16):
        assert sorted(map(str, plan_mix(made, WEIGHTS, bins=bins).collect())) == sorted(map(str, got))


def test_ranks_choose_the_smallest_odds(spark, docs_of):
    made = spark.createDataFrame([(k, "w " * 10, "a" if k % 2 else "b") for k in range(400)], "doc_id long, text string, source string")
    got = {r.doc_id: r.taken // 10 for r in plan_mix(made, WEIGHTS).collect()}
    u = {k: (int(hashlib.md5(f"{k}:mix".encode()).hexdigest()[:13], 16) + 0.5) / 2**52 for k in got}
    for odd in (0, 1):
        most = max(got[k] for k in got if k % 2 == odd)
        ranked = sorted((k for k in got if k % 2 == odd), key=lambda k: u[k])
        assert [got[k] for k in ranked] == sorted((got[k] for k in ranked), reverse=True) and most <= 2


def test_rows_of_the_mix(spark, docs_of):
    rows = rows_of(8)
    docs = docs_of([(d, t, s) for d, t, s in rows if s])
    plan = Counter()
    for r in plan_mix(docs, WEIGHTS).collect():
        plan[(r.doc_id, r.size)] += r.taken
    out = mixed(docs, WEIGHTS)
    assert out.columns == docs.columns
    seen = Counter()
    for r in out.collect():
        seen[(r.doc_id, size_of(r.text))] += size_of(r.text)
    assert +seen == +plan
    assert mixed(docs_of([]), WEIGHTS).count() == 0 and plan_mix(docs_of([]), WEIGHTS).count() == 0
