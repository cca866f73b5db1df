"""Main text of web pages by a recurrent block labeller.

A page becomes the sequence of its leaf blocks, each with the tags and attribute
words of its path. A block's vector holds hashed path parts, hashed words and a
few measures (words, links, sentence ends, place, and how far it shares its
elements with the blocks before and behind it); a bidirectional LSTM in numpy reads the whole sequence, so every
block is judged in the context of the document on both sides, and the blocks it
labels as content are joined.

There are no labelled pages, so the labeller is trained here on at most
``train_pages`` pages (those with the smallest hash of their id, texts of at most
``train_chars``) whose blocks are labelled by what their path says, together with
copies of these pages: some with blocks of other boilerplate paths, some with
all or a random half of the telling steps of their paths made plain ``div``,
so that pages without telling markup are judged by text, links, place and
neighbours.
The sample and the weights (about 100 kB) are the only things on the driver;
every page is labelled, whatever its length.

Cases: a null or empty html gives an empty text; markup that never ends is read
to the end; scripts, styles, comments, the head and what browsers do not show
are no blocks; white space is Unicode's; repeated pages get equal texts; a null
id or url is kept; with no pages to train on nothing is labelled and the result
is empty; further columns are not read.
"""

from __future__ import annotations

import html
import re
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.llm.files import mapped

# ---------------------------------------------------------------------- blocks

TAG = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)(?:>|\Z)"
    r"|<[!?][^>]*+(?:>|\Z)",
    re.S,
)
ATTRIBUTES = re.compile(r"\b(?:class|id|role|aria-label)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))", re.I)
WORDS = re.compile(r"[A-Za-z]+")
#: Elements whose content is not text of the page.
HIDDEN = frozenset("script style template noscript title textarea select option svg math iframe object canvas audio video head".split())
#: Of these the content is skipped as raw text, whatever it looks like.
RAW = frozenset("script style title textarea iframe noscript template".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul button label".split()
)
#: Fixed cue words of paths.
BOILER_TAGS = frozenset("nav header footer aside form menu dialog button label fieldset".split())
CONTENT_TAGS = frozenset("article main".split())
BOILER_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion nav navbar navigation menu breadcrumb breadcrumbs "
    "header masthead footer sidebar widget rail related recommended cookie cookies consent notice alert popup modal overlay newsletter subscribe "
    "signup login share sharing social comment comments reply replies discussion disqus form search pagination pager toolbar copyright legal".split()
)


class Block:
    """``shared``: how many elements of the path it is in together with the block before it."""

    __slots__ = ("path", "text", "linked", "shared")

    def __init__(self, path: tuple[str, ...], text: str, linked: int, shared: int = 0):
        self.path, self.text, self.linked, self.shared = path, text, linked, shared


def _step(tag: str, attributes: str) -> str:
    """A path step: the tag and the words of its class, id and role."""
    found = ATTRIBUTES.findall(attributes) if "=" in attributes else ()
    words = [w.lower() for three in found for w in WORDS.findall(re.sub(r"([a-z])([A-Z])", r"\1 \2", "".join(three)))]
    return " ".join([tag, *words])


def blocks(page: str | None) -> list[Block]:
    """Leaf blocks in page order; inline elements belong to the block around them."""
    page = page or ""
    stack: list[tuple[str, str, int]] = []
    out: list[Block] = []
    held: list[str] = []
    state = {"linked": 0, "hidden": 0, "links": 0, "opened": 0}
    before: list[int] = []
    known: dict[tuple[str, str], str] = {}

    def flush():
        if held:
            text = " ".join("".join(held).split())
            if text:
                elements = [n for _, _, n in stack]
                shared = next((k for k, (a, b) in enumerate(zip(before, elements)) if a != b), min(len(before), len(elements)))
                out.append(Block(tuple(s for _, s, _ in stack), text, state["linked"], shared))
                before[:] = elements
            held.clear()
        state["linked"] = 0

    def pop(upto: int):
        for tag, _, _ in stack[upto:]:
            state["hidden"] -= tag in HIDDEN
            state["links"] -= tag == "a"
        del stack[upto:]

    def add(piece: str):
        if piece and not state["hidden"]:
            text = html.unescape(piece) if "&" in piece else piece
            held.append(text)
            if state["links"]:
                state["linked"] += len(text)

    at = 0
    while m := TAG.search(page, at):
        if m.start() > at:
            add(page[at : m.start()])
        at = m.end()
        name = m.group(2) or m.group(5)
        if name is None:
            continue
        name, attributes = name.lower(), m.group(3) or m.group(6) or ""
        if m.group(1) or m.group(4):
            if name in BLOCK:
                flush()
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == name:
                    pop(k)
                    break
            continue
        if name in RAW:
            close = re.compile(rf"</{re.escape(name)}\b[^>]*+(?:>|\Z)", re.I).search(page, at)
            at = close.end() if close else len(page)
            continue
        if name == "br":
            add(" ")
            continue
        if name in BLOCK:
            flush()
            for k in range(len(stack) - 1, -1, -1):  # an open paragraph, list item or cell ends where the next block begins
                if stack[k][0] == "p" or (stack[k][0] == name and name in ("li", "td", "th", "tr", "dt", "dd", "option")):
                    pop(k)
                    break
                if stack[k][0] in BLOCK:
                    break
        if name in ("body", "article", "main"):
            state["hidden"] = 0
            stack[:] = [s for s in stack if s[0] not in HIDDEN]
        if name not in VOID and not attributes.endswith("/"):
            key = (name, attributes)
            step = known.get(key)
            if step is None:
                step = known[key] = _step(name, attributes)
            state["opened"] += 1
            stack.append((name, step, state["opened"]))
            state["hidden"] += name in HIDDEN
            state["links"] += name == "a"
    add(page[at:])
    flush()
    return out


# -------------------------------------------------------------------- features

PARTS, HASHED_WORDS, MEASURES = 48, 32, 11
WIDTH = PARTS + HASHED_WORDS + MEASURES


@lru_cache(maxsize=50_000)
def _path_vector(path: tuple[str, ...]) -> tuple[np.ndarray, np.ndarray]:
    v, cues = np.zeros(PARTS, np.float32), np.zeros(5, np.float32)
    for step in path:
        tag, *words = step.split(" ")
        v[zlib.crc32(tag.encode()) % PARTS] = 1
        for w in words:
            v[zlib.crc32(b"." + w.encode()) % PARTS] = 1
        cues[0] = max(cues[0], tag in BOILER_TAGS)
        cues[1] = max(cues[1], any(w in BOILER_WORDS for w in words))
        cues[2] = max(cues[2], tag in CONTENT_TAGS)
        cues[3] = tag in ("p", "h1", "h2", "h3", "h4", "h5", "h6", "pre", "blockquote")
    cues[4] = min(len(path), 20) / 10
    return v, cues


def vectors(page: list[Block]) -> np.ndarray:
    x = np.zeros((len(page), WIDTH), np.float32)
    for k, b in enumerate(page):
        v, cues = _path_vector(b.path)
        x[k, :PARTS] = v
        x[k, PARTS + HASHED_WORDS : PARTS + HASHED_WORDS + 5] = cues
        words = b.text.lower().split()
        hashed = np.fromiter((zlib.crc32(w.encode()) for w in words), np.uint32, len(words)) % HASHED_WORDS
        x[k, PARTS : PARTS + HASHED_WORDS] = np.bincount(hashed, minlength=HASHED_WORDS) / np.sqrt(len(words) + 1.0)
        x[k, -6:-4] = b.shared / 10, (page[k + 1].shared if k + 1 < len(page) else 0) / 10
        x[k, -4:] = (np.log1p(len(words)) / 4, min(b.linked / max(len(b.text), 1), 1), b.text[-1] in ".!?:;…", (k + 1) / len(page))
    return x


def said(path: tuple[str, ...], inside: bool) -> int:
    """The training label a path gives: 1 for content. ``inside``: the page has an article or main element."""
    cues = _path_vector(path)[1]
    return int(not cues[0] and not cues[1] and (bool(cues[2]) or not inside))


# ------------------------------------------------------------------------ LSTM


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Lstm:
    """One direction. ``x`` is time x batch x width."""

    def __init__(self, rng, width, hidden):
        self.h = hidden
        self.p = [
            (rng.standard_normal((width, 4 * hidden)) / np.sqrt(width)).astype(np.float32),
            (rng.standard_normal((hidden, 4 * hidden)) / np.sqrt(hidden)).astype(np.float32),
            np.repeat([0, 1, 0, 0], hidden).astype(np.float32),
        ]

    def forward(self, x, keep=True):
        wx, wh, b = self.p
        n, h = self.h, np.zeros((x.shape[1], self.h), np.float32)
        c, z = h, x @ wx + b
        hs, tape = np.empty((*x.shape[:2], n), np.float32), []
        for t in range(len(x)):
            a = z[t] + h @ wh
            ifo, g = _sigmoid(a[:, : 3 * n]), np.tanh(a[:, 3 * n :])
            new = ifo[:, n : 2 * n] * c + ifo[:, :n] * g
            th = np.tanh(new)
            if keep:
                tape.append((h, c, ifo, g, th))
            h, c = ifo[:, 2 * n :] * th, new
            hs[t] = h
        return hs, tape

    def backward(self, x, tape, dhs):
        wx, wh, _ = self.p
        n, grads = self.h, [np.zeros_like(p) for p in self.p]
        dh, dc = np.zeros_like(dhs[0]), np.zeros_like(dhs[0])
        for t in range(len(x) - 1, -1, -1):
            h, c, ifo, g, th = tape[t]
            i, f, o = ifo[:, :n], ifo[:, n : 2 * n], ifo[:, 2 * n :]
            dh = dh + dhs[t]
            dc = dc + dh * o * (1 - th * th)
            da = np.concatenate([dc * g * i * (1 - i), dc * c * f * (1 - f), dh * th * o * (1 - o), dc * i * (1 - g * g)], axis=1)
            grads[0] += x[t].T @ da
            grads[1] += h.T @ da
            grads[2] += da.sum(axis=0)
            dh, dc = da @ wh.T, dc * f
        return grads


def _padded(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Time x batch arrays of the pages and of each page reversed, and what is no padding."""
    longest = max(map(len, pages))
    x = np.zeros((longest, len(pages), pages[0].shape[1]), np.float32)
    back, mask = x.copy(), np.zeros((longest, len(pages)), np.float32)
    for k, p in enumerate(pages):
        x[: len(p), k], back[: len(p), k], mask[: len(p), k] = p, p[::-1], 1
    return x, back, mask


def _turned(a: np.ndarray, lengths: list[int]) -> np.ndarray:
    out = a.copy()
    for k, n in enumerate(lengths):
        out[:n, k] = a[:n, k][::-1]
    return out


class Labeller:
    """Bidirectional LSTM with a logistic output per block."""

    def __init__(self, hidden: int = 16, seed: int = 0):
        rng = np.random.default_rng(seed)
        self.ahead, self.behind = Lstm(rng, WIDTH, hidden), Lstm(rng, WIDTH, hidden)
        self.out = [(rng.standard_normal(2 * hidden + WIDTH) * 0.1).astype(np.float32), np.zeros(1, np.float32)]

    def _run(self, pages, keep):
        x, back, mask = _padded(pages)
        lengths = [len(p) for p in pages]
        a, tape_a = self.ahead.forward(x, keep)
        b, tape_b = self.behind.forward(back, keep)
        joined = np.concatenate([a, _turned(b, lengths), x], axis=2)
        return x, back, mask, lengths, tape_a, tape_b, joined, _sigmoid(joined @ self.out[0] + self.out[1])

    def __call__(self, pages: list[np.ndarray]) -> list[np.ndarray]:
        """Share of content for every block; empty pages allowed."""
        result: list = [np.empty(0, np.float32)] * len(pages)
        order = sorted((k for k in range(len(pages)) if len(pages[k])), key=lambda k: len(pages[k]))
        while order:
            # batches of like lengths, bounded in blocks; one very long page is a batch of its own
            n = max(1, min(len(order), 128, 20_000 // max(1, len(pages[order[min(127, len(order) - 1)]]))))
            some, order = order[:n], order[n:]
            p = self._run([pages[k] for k in some], False)[-1]
            for j, k in enumerate(some):
                result[k] = p[: len(pages[k]), j]
        return result

    def fit(self, pages: list[np.ndarray], labels: list[np.ndarray], epochs: int = 12, rate: float = 0.01, seed: int = 1) -> None:
        params = [*self.ahead.p, *self.behind.p, *self.out]
        m, v, step = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
        rng, order = np.random.default_rng(seed), np.argsort([len(p) for p in pages], kind="stable")
        groups = [order[k : k + 32] for k in range(0, len(order), 32)]
        hidden = self.ahead.h
        # few pages make few groups: as many steps are taken as a full sample takes
        for _ in range(max(epochs, -(-LEAST_STEPS // len(groups)))):
            for g in rng.permutation(len(groups)):
                some = groups[g]
                x, back, mask, lengths, tape_a, tape_b, joined, p = self._run([pages[k] for k in some], True)
                y = np.zeros_like(p)
                for j, k in enumerate(some):
                    y[: lengths[j], j] = labels[k]
                d = (p - y) * mask / mask.sum()
                grad_out = [np.einsum("tbk,tb->k", joined, d), np.array([d.sum()])]
                dj = d[..., None] * self.out[0]
                grads = [*self.ahead.backward(x, tape_a, dj[..., :hidden]), *self.behind.backward(back, tape_b, _turned(dj[..., hidden : 2 * hidden], lengths)), *grad_out]
                step += 1
                for q, dq, mq, vq in zip(params, grads, m, v):
                    mq += 0.1 * (dq - mq)
                    vq += 0.01 * (dq * dq - vq)
                    q -= rate * (mq / (1 - 0.9**step)) / (np.sqrt(vq / (1 - 0.99**step)) + 1e-7)


# -------------------------------------------------------------------- training


#: What may stand in an article element's place.
STEPS = ("main", "main content", "div content", "div post body", "section story", "div", "")


def _strange(rng, texts: list[str]) -> list[Block]:
    """Blocks of one boilerplate element, with a path the page's own template may not have."""
    words = sorted(BOILER_WORDS)
    kind = rng.integers(3)
    step = str(rng.choice(sorted(BOILER_TAGS))) if kind == 0 else f"div {rng.choice(words)}" if kind == 1 else f"section {rng.choice(['page', 'box', 'area'])} {rng.choice(words)}"
    linked = rng.random() < 0.4
    out = []
    for _ in range(rng.integers(1, 5)):
        text = texts[rng.integers(len(texts))]
        if rng.random() < 0.7:
            text = " ".join(text.split()[: rng.integers(1, 9)])
        leaf = ("ul", "li", "a") if linked else (("p",) if rng.random() < 0.6 else ())
        out.append(Block(("html", "body", step, *leaf), text, len(text) if linked else 0, 3 if out else 2))
    return out


#: Elements that differ from ``div`` in what they tell only.
TELLING = frozenset("nav header footer aside form menu dialog article main section".split())


def _plain(rng, page: list[Block], share: float) -> list[Block]:
    """The page with this share of its different path steps made plain: no words, ``div`` for telling elements."""
    made: dict[str, str] = {}

    def plain(step):
        if step not in made:
            tag = step.split(" ")[0]
            made[step] = step if rng.random() >= share else "div" if tag in TELLING else tag
        return made[step]

    return [Block(tuple(map(plain, b.path)), b.text, b.linked, b.shared) for b in page]


def training_set(pages: list[list[Block]], seed: int = 0) -> tuple[list[list[Block]], list[list[int]]]:
    """The pages with their path labels, and copies with other content elements, strange boilerplate and plain paths."""
    rng = np.random.default_rng(seed)
    texts = [b.text for p in pages for b in p] or ["text"]
    out, labels = [], []
    for page in pages:
        inside = any(_path_vector(b.path)[1][2] for b in page)
        own = [said(b.path, inside) for b in page]
        for copy in range(3):
            mixed, y = list(page), list(own)
            if copy == 2:  # the same page in a template without an article element
                other = STEPS[rng.integers(len(STEPS))]
                mixed = [Block(tuple(s for step in b.path for s in ([other] if step.split(" ")[0] in CONTENT_TAGS else [step]) if s), b.text, b.linked, b.shared) for b in page]
            for _ in range(0 if copy == 0 else rng.integers(1, 5)):
                new, k = _strange(rng, texts), rng.integers(len(mixed) + 1)
                if rng.random() < 0.3:  # inside the article
                    new = [Block(("html", "body", "article", *b.path[2:]), b.text, b.linked, b.shared + 1) for b in new]
                if k < len(mixed):
                    old = mixed[k]
                    mixed[k] = Block(old.path, old.text, old.linked, min(old.shared, new[0].shared))
                mixed[k:k], y[k:k] = new, [0] * len(new)
            out.append(mixed)
            labels.append(y)
        for share in (1.0, 0.5):
            out.append(_plain(rng, page, share))
            labels.append(own)
    return out, labels


#: Steps of a fit at least.
LEAST_STEPS = 200
#: Pages that are learned from where all are longer than ``train_chars``.
LONG_PAGES = 4


def train(pages: DataFrame, train_pages: int = 256, train_chars: int = 100_000, id_col: str = "page_id", html_col: str = "html") -> Labeller | None:
    usable = pages.filter(F.col(html_col).isNotNull() & (F.length(html_col) <= train_chars))
    keys = usable.select(F.xxhash64(F.col(id_col).cast("string"), html_col).alias("_k"), F.col(html_col).alias("h"))
    # the hashes alone are ordered; pages reach the driver only when they are known to be of the sample
    cut = keys.select("_k").orderBy("_k").limit(train_pages).agg(F.max("_k")).first()[0]
    chosen = keys.filter(F.col("_k") <= cut).dropDuplicates(["_k"]) if cut is not None else keys.limit(0)
    sample = [r.h for r in sorted(chosen.collect(), key=lambda r: r["_k"])]
    if not sample:  # long pages only: a few of the shortest
        length = F.length(html_col)
        few = pages.filter(length > 0).select(length.alias("n"), F.xxhash64(F.col(id_col).cast("string"), html_col).alias("_k"), F.col(html_col).alias("h"))
        sample = [r.h for r in few.orderBy("n", "_k").limit(LONG_PAGES).collect()]
    found = [b for b in map(blocks, sample) if b]
    if not found:
        return None
    made, labels = training_set(found)
    net = Labeller()
    net.fit([vectors(p) for p in made], [np.array(y, np.float32) for y in labels])
    return net


def main_text(pages: list[str | None], net: Labeller | None) -> list[str]:
    """Content blocks of each page, joined by line ends."""
    found = [blocks(p) for p in pages]
    shares = net([vectors(p) if p else np.empty((0, WIDTH), np.float32) for p in found]) if net else [np.zeros(len(p)) for p in found]
    return ["\n".join(b.text for b, s in zip(p, share) if s >= 0.5) for p, share in zip(found, shares)]


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", **options) -> DataFrame:
    """``page_id``, ``url``, main ``text`` and its length for every page."""
    net = train(pages, id_col=id_col, html_col=html_col, **options)

    def run(batches):
        for batch in batches:
            for k in range(0, len(batch), 256):
                part = batch.slice(k, 256)
                texts = main_text(part.column(2).to_pylist(), net)
                cols = [part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
                yield pa.RecordBatch.from_arrays(cols, names=["page_id", "url", "text", "n_chars"])

    picked = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).alias("html"))
    return mapped(picked, run, f"page_id {picked.schema['page_id'].dataType.simpleString()}, url string, text string, n_chars long")
