"""Blocks of awkward markup, the network's gradient, and held-out pages."""

import re

import numpy as np

from tabloom.llm import html_labeller as H


def texts(page):
    return [b.text for b in H.blocks(page)]


def test_blocks_of_awkward_markup():
    assert texts("<p>a &amp; b&nbsp; c<p>d<br>e <b>f</b>g<div>h</div>i") == ["a & b c", "d e fg", "h", "i"]
    assert texts("<script>var a='</p>';</script><style>p{}</style><!-- x <p>no</p> --><p>yes") == ["yes"]
    assert texts("<title>no<b></title><textarea><p>no</textarea>ok<SCRIPT>no</Script >ok") == ["okok"]
    assert texts("<p title='a>b' class=\"x\">in</p><p x='unclosed>still</p>") == ["in", "still"]
    assert texts("<ul><li>a<li>b</ul><table><tr><td>c<td>d") == ["a", "b", "c", "d"]
    assert texts("never <!-- closed") == ["never"] and texts("<script>never closed") == [] and texts(None) == texts("") == []
    assert texts("a < b &lt;p&gt; &#233; &bogus;") == ["a < b <p> é &bogus;"]
    assert H.blocks("<div class='siteHeader nav-x' id=top><p>a")[0].path == ("div site header nav x top", "p")


def test_gradient_of_the_network():
    rng = np.random.default_rng(0)
    x = rng.standard_normal((5, 2, 4)).astype(np.float64)
    net = H.Lstm(rng, 4, 3)
    net.p = [p.astype(np.float64) for p in net.p]
    up = rng.standard_normal((5, 2, 3))
    hs, tape = net.forward(x)
    grads = net.backward(x, tape, up)
    for p, g in zip(net.p, grads):
        for _ in range(4):
            at = tuple(rng.integers(n) for n in p.shape)
            keep, eps = p[at], 1e-3
            p[at] = keep + eps
            high = (net.forward(x)[0] * up).sum()
            p[at] = keep - eps
            low = (net.forward(x)[0] * up).sum()
            p[at] = keep
            assert abs((high - low) / (2 * eps) - g[at]) < 1e-2 * max(1, abs(g[at]))


def page(rng, k, template):
    words = lambda n: " ".join(rng.choice(["the", "of", "thin", "ouer", "and", "eran"], n))
    body = [f"Page {k} {words(5)}", *(words(rng.integers(1, 60)) + "." for _ in range(rng.integers(1, 8)))]
    article = "<h1>" + body[0] + "</h1>" + "".join(f"<p>{t}</p>" for t in body[1:])
    around = ["<nav><ul>" + "".join(f"<li><a href=#>{words(1)}</a>" for _ in range(5)) + "</ul></nav>", f"<div class='ad'>{words(9)}</div>", f"<footer>&copy; {words(8)}</footer>"]
    inner = f"<article>{article}</article>" if template else f"<main class='content'>{article}<aside>{words(7)}</aside></main><section class='comments'><p>{words(12)}.</p></section>"
    return f"<html><head><title>{body[0]}</title><script>x='<p>'</script></head><body>{around[0]}{around[1]}{inner}{around[2]}</body>", "\n".join(body)


def test_held_out_pages_and_another_template(spark):
    rng = np.random.default_rng(2)
    made = [page(rng, k, True) for k in range(160)]
    strange = [page(rng, 1000 + k, False) for k in range(60)]
    rows = [(k, "u", h, "x", 3) for k, (h, _) in enumerate(made + strange)]
    schema = "page_id long, url string, html string, text string, n_chars int"
    net = H.train(spark.createDataFrame(rows[:120], schema), train_pages=120)
    got = H.main_text([h for h, _ in made[120:] + strange], net)
    want = [t for _, t in made[120:] + strange]
    assert np.mean([a == b for a, b in zip(got[:40], want[:40])]) >= 0.95
    assert np.mean([a == b for a, b in zip(got[40:], want[40:])]) >= 0.8


def neutral(page):
    """The page without class, id and role, and with plain elements for the telling ones."""
    page = re.sub(r"\s(?:class|id|role)\s*=\s*(?:\"[^\"]*\"|'[^']*'|[^\s>]+)", "", page)
    return re.sub(r"(</?)(?:nav|article|main|aside|header|footer|section)\b", r"\1div", page)


def block_shares(net, pages, want):
    """Precision and recall of blocks."""
    hit = got_n = want_n = 0
    for got, right in zip(H.main_text(pages, net), want):
        got, right = got.split("\n") if got else [], right.split("\n")
        left = list(right)
        for b in got:
            if b in left:
                left.remove(b)
                hit += 1
        got_n, want_n = got_n + len(got), want_n + len(right)
    return hit / max(got_n, 1), hit / max(want_n, 1)


def test_neutral_markup_is_judged_by_context(spark):
    rng = np.random.default_rng(4)
    made = [page(rng, k, True) for k in range(240)]
    rows = [(k, "u", h) for k, (h, _) in enumerate(made[:160])]
    net = H.train(spark.createDataFrame(rows, "page_id long, url string, html string"), train_pages=160)
    want = [t for _, t in made[160:]]
    assert min(block_shares(net, [h for h, _ in made[160:]], want)) >= 0.99
    assert min(block_shares(net, [neutral(h) for h, _ in made[160:]], want)) >= 0.95
    assert [b.path for b in H.blocks(neutral("<nav id=a><p class='x'>a</p></nav>"))] == [("div", "p")]


def test_shared_elements_of_neighbours():
    assert [b.shared for b in H.blocks("<div><p>a<p>b</div><div><p>c<ul><li>d<li>e</ul></div>")] == [0, 1, 0, 1, 2]


def test_extraction_of_every_page(spark):
    rng = np.random.default_rng(3)
    made = [page(rng, k, True) for k in range(80)]
    rows = [(k, f"u{k}", h, "x", 3) for k, (h, _) in enumerate(made)] + [(500, None, None, "x", 3), (None, "u", "", "x", 3), (501, "u", "<p>" * 3000 + "a", "x", 3), (7, "u7", made[7][0], "x", 3)]
    schema = "page_id long, url string, html string, text string, n_chars int"
    out = H.extract(spark.createDataFrame(rows, schema).repartition(3))
    assert out.columns == ["page_id", "url", "text", "n_chars"] and out.count() == len(rows)
    got = [(r.page_id, r.text) for r in out.collect()]
    assert all(n == len(t) for n, t in ((r.n_chars, r.text) for r in out.collect()))
    assert np.mean([(k, t) in got for k, (_, t) in enumerate(made)]) >= 0.95
    assert dict(got)[500] == "" and dict(got)[None] == "" and len([g for g in got if g[0] == 7]) == 2
    assert H.extract(spark.createDataFrame([], schema)).count() == 0


def test_svg_and_math_hide_only_themselves():
    from tabloom.llm.html_labeller import blocks

    for icon in ("<svg viewBox='0 0 1 1'/>", "<svg><path d='M0'/><svg><text>in</text></svg><text>out</text></svg>", "<math><mi>x</mi></math>", "<math/>", "<svg><g>open</article>"):
        page = f"<html><body><article><p>Before it.</p>{icon}<p>After it.</p></article><p>End.</p></body></html>"
        texts = [b.text for b in blocks(page)]
        assert texts[0] == "Before it." and texts[-1] == "End.", (icon, texts)
        assert "open" not in texts and "in" not in texts and "out" not in texts
        assert "After it." in texts or icon.endswith("</article>")


def test_a_table_of_long_pages_only(spark):
    from tabloom.llm.html_labeller import extract

    long = "".join(f"<p>Paragraph number {k} tells something about the matter, in a whole sentence.</p>" for k in range(60))
    menu = "<nav><ul>" + "".join(f"<li><a href='/{k}'>Menu {k}</a></li>" for k in range(20)) + "</ul></nav>"
    rows = [(k, f"u{k}", f"<html><body>{menu}<article><h1>Title {k}</h1>{long}</article><footer>Copyright {k}</footer></body></html>") for k in range(6)]
    got = extract(spark.createDataFrame(rows, "page_id long, url string, html string"), train_chars=500).collect()
    assert all("Paragraph number 59 tells" in r.text and f"Title {r.page_id}" in r.text and "Menu 3" not in r.text and "Copyright" not in r.text for r in got)
