"""Decoding by exhaustive search over paths, and held-out accuracy on disguised words."""

import collections
import itertools
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest

from tabloom.llm import toxicity as X


def model_of(text):
    raw = X.narrow(text)
    return X.Language(X.costs(X.trigram_counts(raw, np.array([len(raw)])).reshape(64, 64, 64).astype(float)), X.rare_words(X.short_counts(raw)))


def path_cost(letters, paid, cost):
    x = y = 0
    for c in letters + " ":
        z = X.code_of(c)
        if z or y:
            paid += cost[x][y][z]
            x, y = y, z
    return paid


def test_viterbi_finds_the_cheapest_path():
    cost = model_of("you are an idiot and a stupid loser, this is what the moron said to the clown " * 3).cost
    rng = random.Random(0)
    for _ in range(150):
        segment = "".join(rng.choice("ioast01$.-dd!l5 /аі") for _ in range(rng.randrange(2, 7)))
        options = list(X.lattice(segment))
        best = min(path_cost("".join(o[0] for o in path), sum(o[1] for o in path), cost) for path in itertools.product(*options))
        got = X.viterbi(segment, cost)
        ways = [sum(o[1] for o in path) for path in itertools.product(*options) if " ".join("".join(o[0] for o in path).split()) == got]
        assert min(path_cost("".join(o[0] for o in path), sum(o[1] for o in path), cost)
                   for path in itertools.product(*options) if " ".join("".join(o[0] for o in path).split()) == got) == pytest.approx(best) and ways


def spellings(word, rng):
    """A word in each disguise."""
    at = [0, *sorted(rng.sample(range(1, len(word)), max(1, len(word) // 2 - 1))), len(word)]
    while max(b - a for a, b in zip(at, at[1:])) > 3:
        at = [0, *sorted(rng.sample(range(1, len(word)), max(len(word) // 3, len(word) // 2 - 1))), len(word)]
    cut = rng.randrange(1, len(word) - 1)
    return {
        "plain": word, "single": " ".join(word), "leet": word.translate(LEET), "repeats": word[0] + word[1] * 4 + word[2:],
        "hyphen": f"{word[:cut]}-{word[cut:]}", "dot": f"{word[:cut]}.{word[cut:]}", "pieces": " ".join(word[a:b] for a, b in zip(at, at[1:])),
        "spaced hyphens": " - ".join(word), "slashes": "/".join(word), "two blanks": "  ".join(word), "tabs": "\t".join(word),
        "look-alikes": word.translate(ALIKE), "accents": word.translate(ACCENTS), "commas": ", ".join(word), "wide": word.translate(WIDE),
        "invisible": "\u200b".join(word),
    }


LEET = str.maketrans("oieast", "013457")
ALIKE, ACCENTS = str.maketrans("oieasc", "оіеаѕс"), str.maketrans("oieau", "öîéàú")
WIDE = {k: k + 0xFEE0 for k in range(97, 123)}


def test_disguises_are_found_and_read():
    language = model_of("the idiot and the stupid moron was a worthless loser of an idiot with the trash " * 5)
    for word in ("idiot", "stupid", "worthless"):
        for form, hidden in spellings(word, random.Random(1)).items():
            text = f"with the {hidden} was of"
            read = X.shown(X.narrow(text)) + " " + " ".join(r[2] for r in X.restored(text, language))
            assert word in read.split(), (form, hidden, read)
    for hidden in ("!d!ot", "i_d_1_0_t", "I-D-I-O-T", "i ..  d -- i / o , t"):
        assert "idiot" in " ".join(r[2] for r in X.restored(f"the {hidden} was", language)).split(), hidden
    assert X.restored("the plain text, with no marks! at all.", model_of("the plain text with no marks at all " * 3)) == []
    assert X.restored("", language) == [] and X.restored("a", language) == []


def test_frequent_words_around_a_disguise_are_left_out_of_a_second_reading():
    language = model_of("the idiot and the stupid moron was a worthless loser of an idiot with the trash " * 5)
    read = [r[2] for r in X.restored("said the s t u p i d was of", language)]
    assert "stupid" in read and len(read) == 3
    assert [r[2] for r in X.restored("s tu p id", language)] == ["stupid"]


def test_other_scripts_keep_their_letters():
    language = model_of("он сказал что сосна стоит у реки и рос там мох the tree stands at the river " * 20)
    assert X.restored("он сказал что рос мох", language) == []
    assert [r[2] for r in X.restored("сосна сосо", language)] == ["сосна", "сосо"]
    assert X.shown(X.narrow("Ёлка ÇA ﬁn 東京 हिन्दी")) == "елка ca fn 東京 हिन्दी"


def test_long_stretches_are_read_in_parts():
    language = model_of("the idiot and the stupid moron " * 5)
    whole, X.FLUSH, kept = X.viterbi("i-d-i-o-t/" * 300, language.cost), 50, X.FLUSH
    try:
        assert X.viterbi("i-d-i-o-t/" * 300, language.cost) == whole
    finally:
        X.FLUSH = kept


BAD = ["idiot", "stupid", "moron", "worthless", "loser", "scum"]


def corpus(seed=0):
    rng = random.Random(seed)
    vocab = ["".join(rng.choices(["th", "er", "on", "an", "re", "he", "in", "ed", "nd", "ha"], k=rng.randrange(1, 4))) for _ in range(300)]
    rows, labels = [], []
    for k in range(1600):
        words = rng.choices(vocab, k=rng.choice([8, 40, 150]))
        toxic = k % 8 == 0
        if toxic:
            for w in rng.sample(BAD, 2):
                how = rng.randrange(4) if k > 900 else 0
                w = [w, w.translate(LEET), " ".join(w), w[0] + w[1] * 4 + w[2:]][how]
                words.insert(rng.randrange(len(words)), w)
        rows.append((k, " ".join(words).capitalize()))
        labels.append((k, 1, int(toxic)))
    return rows, labels


def test_held_out_accuracy_and_odd_rows(spark, docs_of):
    rows, labels = corpus()
    odd = [(5000, None), (5001, ""), (None, "the idiot moron"), (16, rows[16][1]), (5002, "the " * 60_000 + "1d10t s t u p i d m0r0n"), (5003, "日本 тест 😀")]
    frame = spark.createDataFrame([*labels, (16, 0, 1), (None, 1, 1), (5001, 1, None)], "doc_id long, quality int, toxic int")
    out = X.toxicity(docs_of(rows + odd), frame)
    assert out.columns == ["doc_id", "held_out", "score", "predicted"]
    got = out.collect()
    assert len(got) == len(rows) + len(odd) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got)
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    held = [(r.predicted, r.doc_id % 8 == 0) for r in got if r.held_out and r.doc_id < 5000]
    assert sum(p == t for p, t in held) / len(held) > 0.98
    assert all(p == 0 for p, t in held if not t)
    assert {r.predicted for r in got if r.doc_id == 5002} == {1} and len({r.score for r in got if r.doc_id == 16}) == 1
    rng = random.Random(7)
    vocab = [w for k, x in rows if k % 8 for w in x.lower().split()]
    hidden = []
    for form in [*spellings("idiot", rng), "clean"]:
        for _ in range(40):
            words = rng.choices(vocab, k=40)
            for w in rng.sample(BAD, 2) if form != "clean" else []:
                words.insert(rng.randrange(len(words)), spellings(w, rng)[form])
            hidden.append((form, " ".join(words)))
    language, model = X.fitted(docs_of(rows), frame)
    caught = {}
    for r in X.score(spark.createDataFrame(hidden, "doc_id string, text string"), language, model, ["doc_id"]).collect():
        caught.setdefault(r.doc_id, []).append(r.score >= 0.7)
    shares = {form: sum(x) / len(x) for form, x in caught.items()}
    assert shares.pop("clean") <= 0.01 and all(x >= 0.9 for x in shares.values()), shares
    kept = X.without_toxic(docs_of(rows + odd), frame)
    assert kept.columns == docs_of([]).columns and kept.count() == sum(r.score < 0.7 for r in got)


def test_one_class_no_labels_no_documents(spark, docs_of):
    schema = "doc_id long, quality int, toxic int"
    rows, labels = corpus(1)
    clean = spark.createDataFrame([x for x in labels if not x[2]], schema)
    assert {r.score for r in X.toxicity(docs_of(rows[:50]), clean).collect()} == {0.0}
    assert {r.score for r in X.toxicity(docs_of(rows[:50]), spark.createDataFrame([], schema)).collect()} == {0.0}
    assert X.toxicity(docs_of([]), clean).count() == 0


# The whole operator done plainly: texts as strings, pieces as strings instead of hashes, steps by the max-min formula.


def plain_words(text):
    """Words of letters; repeated letters count once, symbols and all else are breaks."""
    letters = "".join(c if 0 < X.TABLE[ord(c)] < X.SYMBOL else " " for c in X.shown(X.narrow(text)))
    return re.sub(r"(.)\1+", r"\1", letters).split()


def plain_pieces(word):
    out = {("w", word)} if len(word) > 1 else set()
    out |= {("b", word[:n]) for n in range(4, 9) if len(word) > n}
    return out | {("p", word[k : k + 5]) for k in range(len(word) - 4)}


def plain_language(texts):
    grams, short = np.zeros(1 << 18), np.zeros(1 << 18)
    for text in texts:
        x = y = 0
        for z in [*(X.code_of(c) for c in X.shown(X.narrow(text))), 0]:
            if y or z:  # a break after a break is no event
                grams[(x << 12) + (y << 6) + z] += 1
                x, y = y, z
    core = "".join(c if X.TABLE[ord(c)] else " " for c in X.shown(X.narrow("\n".join(texts))))
    for word in core.split():
        number = 0
        for c in word if len(word) <= 3 else "":
            number = number * 64 + int(X.TABLE[ord(c)])
        short[number] += 1
    return X.Language(X.costs(grams.reshape(64, 64, 64)), X.rare_words(short))


def plain_scores(texts, toxic, train):
    """Score per text; ``toxic`` by text number for the texts in ``train``."""
    language = plain_language(texts)
    words = [{w for part in [t, *(r[2] for r in X.restored(t, language))] for w in plain_words(part)} for t in texts]
    held = [{w: plain_pieces(w) for w in ws} for ws in words]
    seen = [collections.Counter(), collections.Counter()]
    for k in train:
        seen[toxic[k]].update(set().union(*held[k].values()))
    n1 = sum(toxic[k] for k in train)
    n0 = len(train) - n1

    def evidence(k, mine):
        def strength(f):
            d1, d0 = seen[1][f] - (mine == 1), seen[0][f] - (mine == 0)
            return float(X.weight(np.array([d1]), np.array([d0]), n1, n0)[0]) if seen[1][f] > 1 else 0.0

        best = sorted((max(map(strength, fs), default=0.0) for fs in held[k].values()), reverse=True)
        return round(sum(best[:8]) * 4) / 4

    points = collections.defaultdict(list)
    for k in train:
        points[evidence(k, toxic[k])].append(toxic[k])
    at = sorted(points)
    ones, sizes = [sum(points[e]) for e in at], [len(points[e]) for e in at]
    fit = [max(min(Fraction(sum(ones[a : b + 1]), sum(sizes[a : b + 1])) for b in range(k, len(at))) for a in range(k + 1)) for k in range(len(at))]
    steps = []
    for value in sorted(set(fit)):
        here = [k for k in range(len(at)) if fit[k] == value]
        share = (sum(ones[k] for k in here) + n1 / (n0 + n1)) / (sum(sizes[k] for k in here) + 1)
        steps.append((at[here[0]], max([share, *(s for _, s in steps)])))

    def score(e):
        return 0.99 * max([steps[0], *(s for s in steps if s[0] <= e)])[1] + 0.01 * e / (e + 10)

    return language, [score(evidence(k, None)) for k in range(len(texts))]


def test_scores_equal_the_plain_computation(spark, docs_of):
    rows, labels = corpus(5)
    rows = [(k, t) for k, t in rows if len(t) < 400][:700] + [(9000, ""), (9001, "s tu p id m-o-r-o-n тест ìdíöt 1d10t і-d-i-о-t")]
    ids, texts = [k for k, _ in rows], [t for _, t in rows]
    toxic = {j: int(k % 8 == 0) for j, k in enumerate(ids)}
    train = [j for j, k in enumerate(ids) if k < 9000 and zlib.crc32(str(k).encode()) % 3 != 1]
    language, want = plain_scores(texts, toxic, train)
    frame = spark.createDataFrame([x for x in labels if x[0] in set(ids)], "doc_id long, quality int, toxic int")
    docs = docs_of(rows)
    got_language = X.language_model(docs)
    assert (got_language.cost == language.cost).all() and (got_language.rare == language.rare).all()
    got = {r.doc_id: r.score for r in X.toxicity(docs, frame).collect()}
    off = [(k, got[k], w) for k, w in zip(ids, want) if abs(got[k] - w) > 1e-6]
    assert len(off) <= 0.01 * len(ids), off[:5]
