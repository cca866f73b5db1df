"""Fingerprints, BK-trees and components against brute force."""

import random

import pytest
import xxhash

from tabloom.llm.simhash_bk import BKTree, fingerprint, linked, near_duplicates, one_of_each


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    values = [xxhash.xxh64(s, seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(v >> b & 1 for v in values) > len(values))


def plain_components(rows):
    fps = [plain_fingerprint(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 3:
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return sorted(((d, f"{f:016x}", least.get(find(i))) for i, (d, f) in enumerate(zip([r[0] for r in rows], fps))), key=str)


def corpus(seed=1):
    rng = random.Random(seed)
    vocab = [f"w{k}" for k in range(300)]
    rows = []
    for base in range(20):
        words = rng.choices(vocab, k=rng.choice([5, 60, 400]))
        for _ in range(rng.choice([1, 3, 12])):
            near = list(words)
            for _ in range(rng.choice([0, 0, 1, 2])):
                near[rng.randrange(len(near))] = rng.choice(vocab)
            rows.append((len(rows), " ".join(near)))
    return rows


def test_fingerprint_cases():
    for text in (None, "", " \t\n", "One", "a B", "a b c", "Ünï A\x0bz q É é", "x " * 70_000):
        assert fingerprint(text) == plain_fingerprint(text)
    assert fingerprint("THE cat sat") == fingerprint("the CAT\tsat") != fingerprint("thé cat sat")


def test_tree_finds_all_within_radius():
    rng = random.Random(3)
    values = [rng.getrandbits(64) for _ in range(200)]
    values += [v ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for v in values[:80]]
    tree = BKTree()
    for v in values:
        tree.add(v)
    for radius in (0, 2, 3):
        for v in values[:60]:
            assert sorted(tree.within(v, radius)) == [k for k, u in enumerate(values) if (u ^ v).bit_count() <= radius]
    assert linked([5], [4], 3) and not linked([0], [15], 3) and linked([0, 1, 3, 1 << 40], None, 1) != []


@pytest.mark.parametrize("tree_rows", [2048, 3])
def test_components_match_brute_force(spark, docs_of, tree_rows):
    rows = corpus() + [(900, None), (901, ""), (902, "  "), (None, "lonely words here now"), (None, None), (5, corpus()[5][1])]
    got = near_duplicates(docs_of(rows), tree_rows=tree_rows)
    assert got.columns == ["doc_id", "fingerprint", "component_id"]
    assert sorted(map(tuple, got.collect()), key=str) == plain_components(rows)


def test_chain_is_one_component(spark, docs_of, monkeypatch):
    """Fingerprints three bits apart in a row: linked end to end though the ends are far apart."""
    from tabloom.llm import simhash_bk

    edges = spark.createDataFrame([(k, k + 1) for k in range(40)] + [(-5, 7), (100, 101)], "u long, v long")
    got = {r.u: r.label for r in simhash_bk.components(edges).collect()}
    assert {got[k] for k in range(41)} == {-5} and got[101] == got[100] == 100


def test_one_row_of_each_group_stays(spark, docs_of):
    rows = [(1, "a b c d"), (2, "a b c d"), (3, "quite another text"), (3, "quite another text"), (4, None), (None, "")]
    docs = docs_of(rows)
    kept = one_of_each(docs, near_duplicates(docs))
    assert sorted(r.doc_id for r in kept.collect()) == [1, 3, 4] and kept.columns == docs.columns


def test_empty_table(spark, docs_of):
    assert near_duplicates(docs_of([])).count() == 0
