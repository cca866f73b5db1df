"""Toxicity of texts after noisy-channel deobfuscation.

1. A character language model (interpolated trigrams over word-bounded letters)
   and the frequency of words of up to three letters are counted over all documents.
2. Stretches that look disguised become lattices: a symbol may stand for a letter
   or for a break, a look-alike of another script for itself or a Latin letter, a
   repeated letter for one or two, a run of separators for nothing or for a break.
   Viterbi decoding under the model picks the path. Searched are words with symbols
   beside letters, a letter three times in a row or look-alikes; words with
   separators between their letters; and neighbours of one to three letters each,
   whatever separates them, where one is rare as a word or both are single.
   Neighbours that are all frequent words are read as they stand; a stretch that
   begins or ends with some is read with and without them.
3. Words of the text and of its restored stretches, their beginnings and their
   letter 5-grams are features. Their document frequencies in toxic and clean
   labelled texts give log odds; only significant ones count. A word is as
   strong as its strongest piece, and a document's evidence is the sum over its
   ``top`` strongest different words, mapped to 0..1 by a rising step curve
   fitted on leave-one-out evidence of the labelled texts.

Labels are learned from a sample of at most ``max_labelled`` rows, those with
the smallest hash of their id; everything else covers all rows and whole texts.

Cases: null and empty texts have no evidence and get the curve's value at zero;
repeated rows get equal scores; accents, combining marks and invisible characters
are taken off and compatibility forms are plain letters; letters of other scripts
are letters (the language model folds them onto 36 codes, features do not); a null id is never a training row; without any
toxic or any clean training row every score is the share of toxic rows (zero if
there are no labels); an empty table gives no rows; further columns are not read.
"""

from __future__ import annotations

import itertools
import re
import unicodedata
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloom.llm.files import free_name, mapped
from tabloom.plans.sizing import pinned_if_small

#: What a symbol may stand for, each at the same channel cost.
LEET = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t",
}
#: Symbols that also end sentences or cells: disguise only with a letter behind them.
PUNCTUATION = "!|+"
SEPARATORS = " \t.-_*/,~:·•"
#: Letters of other scripts that look like a Latin one.
LOOK_ALIKES = {
    "а": "a", "в": "b", "с": "c", "ԁ": "d", "е": "e", "һ": "h", "н": "h", "і": "i", "ј": "j", "к": "k", "м": "m", "п": "n", "о": "o", "р": "p",
    "ԛ": "q", "г": "r", "ѕ": "s", "т": "t", "υ": "u", "ѵ": "v", "ѡ": "w", "х": "x", "у": "y", "α": "a", "ε": "e", "η": "n", "ι": "i", "κ": "k",
    "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "χ": "x", "γ": "y", "ω": "w", "ı": "i", "ł": "l", "ø": "o", "đ": "d", "ɡ": "g", "ɑ": "a", "ո": "n",
}
#: Channel costs in nats.
SUBSTITUTE, BREAK = 1.0, 9.0
#: Separators between single letters or without blanks, and other ones: dropped, or a break.
LONE, OTHER = [("", 0.3), (" ", 4.0)], [("", 0.5), (" ", 2.5)]
#: Shares of all words below which a single letter and a word of two or three letters are rare.
RARE_LETTER, RARE_WORD = 2e-3, 1e-4
SHORT = 3
SYMBOL = 63
CHUNK_CHARS = 1 << 20
MEMORY_CHARS, REMEMBERED = 4_000_000, 200
FLUSH = 2000
ROWS = 1000
BITS = 20
GONE, BLANK, TOP = 0xFFFF, 32, 0x1FFFF


def _fold() -> np.ndarray:
    """One 16-bit code per code point: the letter without accents and marks, ``GONE`` for marks and invisible characters.

    Letters beyond 16 bits fold onto the private range, other characters there onto a blank.
    """
    out = np.full(TOP + 1, BLANK, np.uint16)
    for k in range(TOP + 1):
        c = chr(k)
        kind = unicodedata.category(c)
        if kind in ("Mn", "Me") and not 0x0900 <= k < 0x1000 or kind == "Cf":
            out[k] = GONE
        elif kind[0] in "LNPSM" or k < 128:
            plain = ord("-" if kind == "Pd" else unicodedata.normalize("NFKD", c)[0].lower()[0])
            if plain <= 0xFFFF:
                out[k] = plain
            elif kind[0] == "L":
                out[k] = 0xE000 + plain % 6400
    out[TOP] = 0xE000  # all ideographs beyond
    return out


def _table() -> np.ndarray:
    """Letter codes: a-z are 1 to 26, other letters share 27 to 62, symbols of LEET share one, the rest is zero."""
    t = np.zeros(1 << 16, np.uint8)
    t[97:123] = np.arange(1, 27)
    for k in range(128, GONE):
        if 0xE000 <= k < 0xF900 or unicodedata.category(chr(k))[0] in "LM":
            t[k] = 27 + k % 36
    for s in LEET:
        t[ord(s)] = SYMBOL
    return t


def _flags(chars) -> np.ndarray:
    t = np.zeros(1 << 16, bool)
    t[[ord(c) for c in chars]] = True
    return t


FOLD, TABLE = _fold(), _table()
IS_SEPARATOR, IS_SPACE = _flags(SEPARATORS), _flags("\t\n\x0b\x0c\r ")
ENDS, LOOKS = _flags(PUNCTUATION), _flags(LOOK_ALIKES)
RUNS = re.compile(f"[{re.escape(SEPARATORS)}]+|(.)\\1*", re.DOTALL)


def narrow(text: str) -> np.ndarray:
    """Codes of a lower-cased text, see ``_fold``."""
    text = text.lower()
    if text.isascii():
        return np.frombuffer(text.encode(), np.uint8).astype(np.uint16)
    codes = FOLD[np.minimum(np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32), TOP)]
    return codes[codes != GONE]


def shown(raw: np.ndarray) -> str:
    return raw.tobytes().decode("utf-16-le", "replace")


def code_of(char: str) -> int:
    return int(TABLE[ord(char)]) % SYMBOL


#: Codes of the letters a reading is made of.
CODES = {chr(k): int(c) for k, c in enumerate(TABLE) if 0 < c < SYMBOL}


# ------------------------------------------------------------- language model


def trigram_counts(raw: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Counts of letter trigrams; breaks are one zero however long, and each text begins after two.

    So counts do not depend on which texts stand together. A break after a break is no event.
    """
    c = TABLE[raw]
    c = np.where(c == SYMBOL, 0, c)
    keep = (c > 0) | np.append(False, c[:-1] > 0)
    keep[np.cumsum(sizes) - 1] = True
    c = np.append([0, 0], c[keep]).astype(np.int32)
    a, b, z = c[:-2], c[1:-1], c[2:]
    event = (b > 0) | (z > 0)
    return np.bincount(((a << 12) | (b << 6) | z)[event], minlength=1 << 18)


def pieces(c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of runs of letters and symbols."""
    edge = np.diff(np.concatenate([[0], c > 0, [0]]).astype(np.int8))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def short_words(c: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A number below 2^18 for each piece: its codes if it has up to three, else zero."""
    size, out = end - start, np.zeros(len(start), np.int64)
    for k in range(SHORT):
        out = np.where(size > k, (out << 6) | c[np.minimum(start + k, len(c) - 1)], out)
    return np.where(size <= SHORT, out, 0)


def short_counts(raw: np.ndarray) -> np.ndarray:
    """Counts of short words by number; all longer ones are number zero."""
    c = TABLE[raw]
    return np.bincount(short_words(c, *pieces(c)), minlength=1 << 18)


def rare_words(counts: np.ndarray) -> np.ndarray:
    """Which short words are rare among all words."""
    share = counts / max(counts.sum(), 1)
    return share < np.where(np.arange(1 << 18) < 64, RARE_LETTER, RARE_WORD)


class Language(NamedTuple):
    """Costs -log P(c | a, b) as a 64 x 64 x 64 table; which short words are rare."""

    cost: np.ndarray
    rare: np.ndarray


def language_model(docs: DataFrame, text_col: str = "text") -> Language:
    """Both tables from all texts. At most 2^19 counts reach the driver."""

    def count(batches):
        total = np.zeros(1 << 19, np.int64)
        for batch in batches:
            for raw, sizes in chunks(batch.column(0)):
                total[: 1 << 18] += trigram_counts(raw, sizes)
                total[1 << 18 :] += short_counts(raw)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen.astype(np.int32)), pa.array(total[seen])], names=["gram", "n"])

    each = mapped(docs.select(text_col), count, "gram int, n long")
    summed = each.groupBy("gram").agg(F.sum("n").alias("n")).toArrow()
    n = np.zeros(1 << 19)
    n[summed["gram"].to_numpy()] = summed["n"].to_numpy()
    return Language(costs(n[: 1 << 18].reshape(64, 64, 64)), rare_words(n[1 << 18 :]))


def costs(n3: np.ndarray, hold: float = 5.0) -> np.ndarray:
    n2, n1 = n3.sum(axis=0), n3.sum(axis=(0, 1))
    p1 = (n1 + 1) / (n1 + 1).sum()
    p2 = (n2 + hold * p1) / (n2.sum(axis=1, keepdims=True) + hold)
    p3 = (n3 + hold * p2) / (n3.sum(axis=2, keepdims=True) + hold)
    return -np.log(p3)


# ------------------------------------------------------------------- decoding


def lattice(segment: str):
    """Options (letters or a blank for a break, cost) for each run of equal characters or of separators."""

    def inside(k):
        return 0 <= k < len(segment) and TABLE[ord(segment[k])] > 0

    for m in RUNS.finditer(segment):
        c, run = m[0][0], m.end() - m.start()
        if c in SEPARATORS:
            blank = any(x in " \t" for x in m[0])
            yield OTHER if blank and (inside(m.start() - 2) or inside(m.end() + 1)) else LONE
        elif c in LEET:
            for _ in range(min(run, 2)):
                yield [(x, SUBSTITUTE) for x in LEET[c]] + [(" ", BREAK)]
        elif c in LOOK_ALIKES:
            like = LOOK_ALIKES[c]
            yield [(c, 0.0), (like, SUBSTITUTE)] if run == 1 else [(c, 0.0), (c + c, 0.0), (like, SUBSTITUTE), (like + like, SUBSTITUTE)]
        elif TABLE[ord(c)]:
            yield [(c, 0.0)] if run == 1 else [(c, 0.0), (c + c, 0.0)]
        else:
            yield [(" ", 0.0)]


def read_back(path) -> list[str]:
    parts = []
    while path:
        parts.append(path[0])
        path = path[1]
    return parts[::-1]


def settled(states: dict, done: list[str]) -> dict:
    """Moves what all paths begin with to ``done``, so that a long stretch holds only the open ends of its paths."""
    paths = {s: read_back(path) for s, (_, path) in states.items()}
    first, *others = paths.values()
    common = min((next((k for k, (a, b) in enumerate(zip(first, o)) if a != b), min(len(first), len(o))) for o in others), default=len(first))
    done += first[:common]
    out = {}
    for s, parts in paths.items():
        path = None
        for letters in parts[common:]:
            path = (letters, path)
        out[s] = (states[s][0], path)
    return out


def viterbi(segment: str, cost: np.ndarray) -> str:
    """The cheapest reading of a segment between two breaks."""
    states, done = {(0, 0): (0.0, None)}, []
    for step, options in enumerate(itertools.chain(lattice(segment), [[(" ", 0.0)]]), 1):
        after: dict = {}
        for (a, b), (total, path) in states.items():
            for letters, paid in options:
                x, y, sum_ = a, b, total + paid
                for char in letters:
                    z = CODES.get(char) or 0
                    if z or y:  # a break after a break is no event
                        sum_ += cost[x][y][z]
                        x, y = y, z
                held = after.get((x, y))
                if held is None or sum_ < held[0]:
                    after[(x, y)] = (sum_, (letters, path))
        states = after
        if step % FLUSH == 0:
            states = settled(states, done)
    done += read_back(min(states.values(), key=lambda s: s[0])[1])
    return " ".join("".join(done).split())


def disguised(raw: np.ndarray, rare: np.ndarray) -> list[tuple[int, int]]:
    """Stretches (start, end) whose lattice has more than one path worth searching."""
    n = len(raw)
    if n < 3:
        return []
    c = TABLE[raw]
    pad = np.concatenate([[0, 0], c, [0, 0, 0]]).astype(np.uint8)
    letter, symbol = (pad > 0) & (pad < SYMBOL), pad == SYMBOL
    here, before, after, later = (slice(2, n + 2), slice(1, n + 1), slice(3, n + 3), slice(4, n + 4))
    stops = ENDS[raw]
    leet = symbol[here] & (letter[after] | (letter[before] & ~stops & ~(symbol[after] & symbol[later])))
    leet |= symbol[here] & symbol[after] & letter[later] & letter[before]
    same = letter[here] & (pad[here] == pad[after]) & (pad[here] == pad[later])
    looks = LOOKS[raw]
    latin = letter & (pad <= 26)
    mark = leet | same | (looks & (latin[before] | latin[after]))
    start, end = pieces(c)

    def within(flag, first, last):
        run = np.append(0, np.cumsum(flag))
        return run[last] - run[first]

    if looks.any():  # words of look-alikes only
        mark[start[(end - start > SHORT) & (within(looks, start, end) == end - start)]] = True
    out = []
    marks = np.flatnonzero(mark)
    if len(marks):
        space = np.flatnonzero(IS_SPACE[raw])
        k = np.searchsorted(space, marks)
        starts = np.where(k > 0, space[np.maximum(k - 1, 0)] + 1 if len(space) else 0, 0)
        ends = np.where(k < len(space), space[np.minimum(k, len(space) - 1)] if len(space) else n, n)
        out += sorted(set(zip(starts.tolist(), ends.tolist())))
    if len(start) < 2:
        return out
    separated = within(~IS_SEPARATOR[raw], end[:-1], start[1:]) == 0
    tight = (within(IS_SPACE[raw], end[:-1], start[1:]) == 0) & (letter[here][end[:-1] - 1] | letter[here][start[1:]])
    size = end - start
    short, single = size <= SHORT, size == 1
    odd = short & rare[short_words(c, start, end)]
    near = short[:-1] & short[1:] & (odd[:-1] | odd[1:] | (single[:-1] & single[1:]))
    edge = np.diff(np.concatenate([[0], separated & (tight | near), [0]]).astype(np.int8))
    first, last = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    # the same without frequent words in front, and without those at both ends
    kept = np.append(~short | odd, True) | np.concatenate([tight & separated, [False, False]]) | np.concatenate([[False], tight & separated, [False]])
    at = np.flatnonzero(kept)
    inner_first = at[np.searchsorted(at, first)]
    inner_last = at[np.maximum(np.searchsorted(at, last, side="right") - 1, 0)]
    front = (inner_first > first) & (inner_first < last)
    both = (inner_last < last) & (inner_first < inner_last)
    first = start[np.concatenate([first, inner_first[front], inner_first[both]])]
    last = end[np.concatenate([last, last[front], inner_last[both]])]
    lettered = within(letter[here], first, last) > 1
    return out + list(zip(first[lettered].tolist(), last[lettered].tolist()))


class Restorer:
    """Decodes disguised stretches; remembers the decodings of recent ones, up to a number of characters."""

    def __init__(self, language: Language):
        self.cost, self.rare, self.memory, self.held = language.cost.tolist(), language.rare, {}, 0

    def __call__(self, segment: str) -> str:
        found = self.memory.get(segment)
        if found is None:
            found = viterbi(segment, self.cost)
            if len(segment) <= REMEMBERED:
                self.held += 2 * len(segment)
                if self.held > MEMORY_CHARS:
                    self.memory, self.held = {}, 2 * len(segment)
                self.memory[segment] = found
        return found


def restored(text: str, language: Language) -> list[tuple[int, int, str]]:
    """Disguised stretches of a text with their readings; places are those of ``narrow``."""
    raw = narrow(text)
    return [(a, b, viterbi(shown(raw[a:b]), language.cost)) for a, b in disguised(raw, language.rare)]


# ------------------------------------------------------------------- features


def chunks(column: pa.Array):
    """Codes of an Arrow column's texts, each with two line ends: (codes, number of codes of each text with its ends).

    A chunk ends after the text that fills it, so a text is never cut.
    """
    held, sizes, total = [], [], 0
    for k in range(len(column)):
        one = narrow((column[k].as_py() or "") + "\n\n")
        held.append(one)
        sizes.append(len(one))
        total += len(one)
        if total >= CHUNK_CHARS:
            yield np.concatenate(held), np.array(sizes)
            held, sizes, total = [], [], 0
    if sizes:
        yield np.concatenate(held), np.array(sizes)


_BASE = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(int(_BASE), -1, 1 << 64))


_POWERS: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> list[np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2^64; one table that grows."""
    if len(_POWERS[0]) < n:
        for k, base in enumerate((_BASE, _BACK)):
            p = np.full(1 << (n - 1).bit_length(), base, np.uint64)
            p[0] = 1
            _POWERS[k] = np.cumprod(p, dtype=np.uint64)
    return _POWERS


PIECE, PREFIXES = 5, range(4, 9)


def word_features(raw: np.ndarray, doc: np.ndarray):
    """Hashed pieces of words: (feature, its word), and each word's document and hash.

    A word gives its beginnings, itself, and its letter 5-grams. Letters that
    stand twice in a row count once. One running polynomial hash serves all pieces.
    """
    c = TABLE[raw].astype(np.uint16)
    c = np.where(c == SYMBOL, 0, np.where(c > 26, raw, c))  # letters of other scripts keep their own code
    keep = np.append(True, c[1:] != c[:-1])
    c, doc = c[keep], doc[keep]
    inside = c > 0
    edge = np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8))
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if not len(start):
        return np.empty(0, np.uint32), np.empty(0, np.int64), np.empty(0, np.int32), np.empty(0, np.uint64)
    power, back = _powers(len(c))
    run = np.concatenate([np.zeros(1, np.uint64), np.cumsum(c * power[: len(c)], dtype=np.uint64)])

    def hashed(first, last, kind):
        h = (run[last] - run[first]) * back[first] + np.uint64(kind * 0x632BE59BD9B4E019 % (1 << 64))
        return h * np.uint64(0xD6E8FEB86659FD93)

    def bucket(h):
        return (h >> np.uint64(64 - BITS)).astype(np.uint32)

    size = end - start
    word = np.cumsum(edge[:-1] == 1) - 1
    feats, words = [], []
    full = np.flatnonzero(size >= 2)
    whole = hashed(start, end, 1)
    feats.append(bucket(whole[full]))
    words.append(full)
    for n in PREFIXES:
        longer = np.flatnonzero(size > n)
        feats.append(bucket(hashed(start[longer], start[longer] + n, n)))
        words.append(longer)
    if len(c) >= PIECE:
        at = np.flatnonzero(inside[: len(c) - PIECE + 1] & (word[: len(c) - PIECE + 1] == word[PIECE - 1 :]) & inside[PIECE - 1 :])
        feats.append(bucket(hashed(at, at + PIECE, 99)))
        words.append(word[at])
    return np.concatenate(feats), np.concatenate(words), doc[start], whole


def text_features(column: pa.Array, restore: Restorer):
    """Per chunk: features, their words, the words' documents and hashes, and the number of documents."""
    for raw, sizes in chunks(column):
        ends = np.cumsum(sizes)
        doc = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
        parts = [word_features(raw, doc)]
        extra, owners = [], []
        for a, b in disguised(raw, restore.rare):
            extra.append(narrow(restore(shown(raw[a:b])) + "\n"))
            owners.append(np.searchsorted(ends, a, side="right"))
        if extra:
            own = np.repeat(np.array(owners, np.int32), [len(x) for x in extra])
            parts.append(word_features(np.concatenate(extra), own))
        f, w, d, h = zip(*parts)
        if extra:
            w = (w[0], w[1] + len(d[0]))
        yield np.concatenate(f), np.concatenate(w), np.concatenate(d), np.concatenate(h), len(sizes)


def distinct_features(f: np.ndarray, d: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    key = np.unique((d.astype(np.int64) << BITS) | f)
    return key & ((1 << BITS) - 1), key >> BITS


# ---------------------------------------------------------------------- model


def weight(d1: np.ndarray, d0: np.ndarray, n1: float, n0: float, least_g: float = 18.0, doubt: float = 2.0) -> np.ndarray:
    """Log odds of features seen in ``d1`` of ``n1`` toxic and ``d0`` of ``n0`` clean texts; zero unless significant.

    ``doubt`` is taken off each: one telling word then outweighs several that a long clean text has by chance.
    """
    d1, d0 = np.maximum(d1, 0).astype(float), np.maximum(d0, 0).astype(float)
    share = n1 / max(n1 + n0, 1)
    e1, e0 = (d1 + d0) * share, (d1 + d0) * (1 - share)
    with np.errstate(divide="ignore", invalid="ignore"):
        g = 2 * (np.where(d1 > 0, d1 * np.log(d1 / e1), 0) + np.where(d0 > 0, d0 * np.log(d0 / e0), 0))
    w = np.log((d1 + 0.5) / (n1 + 1)) - np.log((d0 + 0.5) / (n0 + 1)) - doubt
    return np.where((g >= least_g) & (d1 > e1), np.maximum(w, 0.0), 0.0)


def strongest(w: np.ndarray, word: np.ndarray, word_doc: np.ndarray, word_hash: np.ndarray, n_docs: int, top: int) -> np.ndarray:
    """Per document, the sum over its ``top`` strongest different words, each as strong as its strongest piece."""
    if not len(w):
        return np.zeros(n_docs)
    doc, kind = word_doc[word].astype(np.int64), word_hash[word]
    order = np.lexsort((-w, kind, doc))
    w, doc, kind = w[order], doc[order], kind[order]
    first = np.append(True, (doc[1:] != doc[:-1]) | (kind[1:] != kind[:-1]))
    w, doc = w[first], doc[first]
    order = np.lexsort((-w, doc))
    w, doc = w[order], doc[order]
    place = np.arange(len(doc)) - np.searchsorted(doc, doc)
    return np.bincount(doc[place < top], weights=w[place < top], minlength=n_docs)


def curve(evidence: np.ndarray, label: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rising steps (from this evidence, share of toxic texts) by pooling neighbours that fall."""
    prior = n[label == 1].sum() / n.sum()
    blocks: list[list[float]] = []
    for e in np.unique(evidence):
        here = evidence == e
        blocks.append([float(e), float(n[here & (label == 1)].sum()), float(n[here].sum())])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][2] >= blocks[-1][1] * blocks[-2][2]:
            _, toxic, size = blocks.pop()
            blocks[-1][1] += toxic
            blocks[-1][2] += size
    at, toxic, size = map(np.array, zip(*blocks))
    return at, np.maximum.accumulate((toxic + prior) / (size + 1))


def on_curve(model: dict, e: np.ndarray) -> np.ndarray:
    """The step a document's evidence stands on; within a step a little more for more evidence."""
    step = np.searchsorted(model["at"], e, side="right") - 1
    return 0.99 * model["share"][np.maximum(step, 0)] + 0.01 * e / (e + 10)


def train(docs: DataFrame, labels: DataFrame, language: Language, top: int = 8, max_labelled: int = 20_000) -> dict:
    """Feature weights and the step curve from ``labels(doc_id, toxic)``.

    The sample of labels is broadcast (at most ``max_labelled`` rows of two
    numbers); counts of 2^20 features and the evidence histogram reach the driver.
    """
    one_each = labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    sample = one_each.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labelled)
    sample, _ = pinned_if_small(sample.select("doc_id", F.col("toxic").cast("int").alias("toxic")), max_rows=max_labelled)
    rows = docs.select("doc_id", "text").join(sample, "doc_id").select("text", "toxic")

    def count(batches):
        restore = Restorer(language)
        seen, n = np.zeros((2, 1 << BITS), np.int64), [0, 0]
        for batch in batches:
            y, at = np.array(batch.column(1).to_pylist()), 0
            for f, word, doc, _, size in text_features(batch.column(0), restore):
                f, who = distinct_features(f, doc[word])
                own = y[at : at + size]
                for k in (0, 1):
                    seen[k] += np.bincount(f[own[who] == k], minlength=1 << BITS)
                    n[k] += int((own == k).sum())
                at += size
        some = np.flatnonzero(seen.sum(axis=0))
        cols = [np.append(some, -1).astype(np.int32), np.append(seen[0, some], n[0]), np.append(seen[1, some], n[1])]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=["f", "d0", "d1"])

    counted = mapped(rows, count, "f int, d0 long, d1 long").groupBy("f").agg(F.sum("d0").alias("d0"), F.sum("d1").alias("d1"))
    # a feature that no weight can come from is left out: fewer than two toxic texts
    counted = counted.filter("f = -1 or d1 > 1").toArrow()
    f, d0, d1 = (counted[c].to_numpy() for c in ("f", "d0", "d1"))
    n0, n1 = (int(c[f == -1].sum()) for c in (d0, d1))
    if not n0 or not n1:
        return {"flat": n1 / max(n0 + n1, 1)}
    f, d0, d1 = f[f >= 0], d0[f >= 0], d1[f >= 0]
    near = (weight(d1, d0, n1, n0) > 0) | (weight(d1, d0 - 1, n1, n0) > 0)
    f, d0, d1 = f[near], d0[near], d1[near]
    place = np.full(1 << BITS, -1, np.int32)
    place[f] = np.arange(len(f))

    def held_out(batches):
        restore = Restorer(language)
        for batch in batches:
            y, at = np.array(batch.column(1).to_pylist()), 0
            for f, word, doc, kind, size in text_features(batch.column(0), restore):
                hit = np.flatnonzero(place[f] >= 0)
                k, word, own = place[f[hit]], word[hit], y[at : at + size]
                mine = own[doc[word]]
                w = weight(d1[k] - mine, d0[k] - (1 - mine), n1, n0)
                e = strongest(w, word, doc, kind, size, top)
                yield pa.RecordBatch.from_arrays([pa.array(np.round(e * 4).astype(np.int32)), pa.array(own.astype(np.int32))], names=["e", "y"])
                at += size

    seen = mapped(rows, held_out, "e int, y int").groupBy("e", "y").agg(F.count(F.lit(1)).alias("n")).toArrow()
    at, share = curve(seen["e"].to_numpy() / 4, seen["y"].to_numpy(), seen["n"].to_numpy())
    w = weight(d1, d0, n1, n0)
    return {"f": f[w > 0], "w": w[w > 0], "at": at, "share": share, "top": top}


def score(docs: DataFrame, language: Language, model: dict, keep: list[str], name: str = "score") -> DataFrame:
    """``docs`` columns in ``keep`` with the score under ``name``; ``text`` must be one of the columns of ``docs``."""
    if "flat" in model:
        return docs.select(*keep, F.lit(float(model["flat"])).alias(name))

    names = keep if "text" in keep else [*keep, "text"]
    at = names.index("text")

    def run(batches):
        restore = Restorer(language)
        w = np.zeros(1 << BITS, np.float32)
        w[model["f"]] = model["w"]
        for batch in batches:
            for k in range(0, len(batch), ROWS):
                part, out = batch.slice(k, ROWS), []
                for f, word, doc, kind, size in text_features(part.column(at), restore):
                    hit = np.flatnonzero(w[f] > 0)
                    e = strongest(w[f[hit]].astype(float), word[hit], doc, kind, size, model["top"])
                    out.append(on_curve(model, np.round(e * 4) / 4))
                yield pa.RecordBatch.from_arrays([*part.columns[: len(keep)], pa.array(np.concatenate(out))], names=[*keep, name])

    fields = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    return mapped(docs.select(*names), run, f"{fields}, `{name}` double")


def held_out(ident: Column) -> Column:
    """True for the third of ids that is never learned from."""
    return F.coalesce(F.crc32(ident.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def fitted(docs: DataFrame, labels: DataFrame, **options) -> tuple[Language, dict]:
    """The language model of all documents and the classifier of the labels outside the held-out third."""
    language = language_model(docs)
    return language, train(docs, labels.filter(~held_out(F.col("doc_id"))), language, **options)


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, **options) -> DataFrame:
    """``doc_id``, ``held_out``, ``score``, ``predicted`` for every row."""
    language, model = fitted(docs, labels, **options)
    scored = score(docs.select("doc_id", "text"), language, model, ["doc_id"])
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def without_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, **options) -> DataFrame:
    """Rows whose score is below the threshold, all columns as they were."""
    language, model = fitted(docs, labels, **options)
    name = free_name(docs, "_toxicity")
    return score(docs, language, model, docs.columns, name).filter(F.col(name) < threshold).drop(name)
