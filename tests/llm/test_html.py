"""Main text of pages: hand-made pages, made pages of another seed, and the given table by its markup."""

import html
import re

import numpy as np
import pytest

from tickloom.llm import html_labeller
from tickloom.llm.html_blocks import blocks, inputs

from .test_quality import SF


def test_blocks():
    page = "<div class='a-B'>x&amp;y <b>z</b>\u00a0 w<br>v<p>two<p>three</div><!-- <p>no --><script>var a='<p>';</script>four<style>p{}</style>"
    assert [b.text for b in blocks(page)] == ["x&y z w v", "two", "three", "four"]
    assert blocks(page)[0].path[:3] == ("tag div", "name a", "name b")
    assert blocks("") == [] and blocks("<p> \n</p>") == [] and blocks("<p>open <b")[0].text == "open <b"
    assert [b.text for b in blocks("<ul><li>a<li>b<ul><li>c</ul></ul>")] == ["a", "b", "c"]


def texts(page):
    return [b.text for b in blocks(page)]


def test_elements_that_do_not_end_lose_nothing():
    for odd in ('<svg class="i"/>', "<template/>", "<svg>", "<select>", "<noscript>", "<iframe src=x>", "<title>", "<textarea>", "</svg>", "</select>", "<svg><template><svg>"):
        assert texts(f"<p>one</p>{odd}<p>two</p>") == ["one", "two"], odd
        assert texts(f"<p>one</p><p>a{odd}<p>two</p><p>three</p>") == ["one", "a", "two", "three"], odd
    assert texts("<p>one<svg><title>icon</title><text>t</text></svg> two</p>") == ["one two"]
    assert texts("<p>one</p><select><option>a<p>b</select><p>two") == ["one", "two"]
    assert texts("<template><div><template>x</template>y</div></template><p>z") == ["z"]
    assert texts("<noscript><p>early<noscript><p>inner</noscript><p>late") == ["early", "late"]


def test_odd_tags():
    assert texts("<p class=it's>one</p><p class=\"it's\">two</p><p title='a>b' x=\"c'd\">three") == ["one", "two", "three"]
    assert texts('<p title="never closed>one</p><p>two') == ["one", "two"]
    assert texts("<p>1 < 2 and 3 <4 & <<b>x</b></p></ p><?php x ?><!doctype html><p>y") == ["1 < 2 and 3 <4 & <x", "y"]
    assert texts("<p>a</P><SCRIPT>'</p>' </scripty> x</Script ><p>b<style>c") == ["a", "b"]
    assert texts("<p =x a = 'b' / c>one<p/>two") == ["one", "two"]
    assert blocks("<div CLASS = Big-Box ID='a'>x")[0].path[:4] == ("tag div", "name big", "name box", "name a")


@pytest.mark.parametrize(
    "page",
    [
        "<script " * 60_000,
        "<script>" * 60_000,
        '<a "' * 200_000,
        "<a b='" * 100_000,
        "<a b=\"'" * 100_000,
        "<div>" * 100_000 + "</p>" * 100_000,
        "<div>" * 100_000 + "<li>x" * 30_000,
        "<ul><li>" + "<div>" * 50_000 + "<ul>" + "<b><li>x</li>" * 50_000,
        "<li><ul>" + "<div>" * 50_000 + "<li>x</li>" * 50_000,
        "<template>" * 100_000 + "x" + "</template>" * 50_000,
        "<p>x<select>" * 60_000,
        "<svg>x" * 100_000 + "</svg>",
        "<!--" * 100_000,
        "<" * 400_000,
        "&" * 400_000,
        "<a href = " + " " * 400_000,
        "<a " + "b = " * 100_000,
    ],
    ids=lambda page: page[:12],
)
def test_odd_markup_takes_linear_time(page):
    import time

    start = time.perf_counter()
    blocks(page)
    assert time.perf_counter() - start < 2


@pytest.fixture(scope="module")
def model():
    return html_labeller.train()


def test_other_pages_of_the_grammar(model):
    grammar = html_labeller._Grammar(99)
    data = [d for d in (html_labeller.labelled(grammar.page()) for _ in range(200)) if d[0]]
    chances = model([inputs(found) for found, _ in data])
    right = np.concatenate([(c >= 0.5) == t for c, (_, t) in zip(chances, data)])
    assert right.mean() > 0.99


def test_gradient():
    small = html_labeller.Labeller(3)
    grammar = html_labeller._Grammar(5)
    data = [d for d in (html_labeller.labelled(grammar.page()) for _ in range(3)) if d[0]]
    small.w = {k: v.astype(np.float64) for k, v in small.w.items()}
    x, mask, cells = small.pad([inputs(f) for f, _ in data])
    truth = np.zeros(mask.shape)
    for row, (_, t) in enumerate(data):
        truth[row, : len(t)] = t

    def loss():
        p, _ = small.forward(small.pad([inputs(f) for f, _ in data])[0].astype(np.float64), mask)
        return -(mask * (truth * np.log(p) + (1 - truth) * np.log(1 - p))).sum() / mask.sum()

    found = small.gradient(x, mask, cells, truth)
    r = np.random.default_rng(1)
    for name, w in small.w.items():
        flat, g = w.reshape(-1), found[name].reshape(-1)
        for k in r.choice(len(flat), min(4, len(flat)), replace=False):
            old, step = flat[k], 1e-3
            flat[k] = old + step
            up = loss()
            flat[k] = old - step
            down = loss()
            flat[k] = old
            assert (up - down) / (2 * step) == pytest.approx(g[k], abs=2e-4), name


def test_given_pages(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet").collect()
    got = {r.page_id: r for r in html_labeller.op5_html_extraction(spark, SF).collect()}
    assert len(got) == len(pages)
    for page in pages:
        article = re.search(r"<article>(.*?)(?:</article>|\Z)", page.html, re.S)[1]
        parts = [" ".join(html.unescape(re.sub("<[^>]+>", "", p.replace("<br>", " "))).split()) for p in re.split("</?(?:p|h1)>", article)]
        text = "\n\n".join(p for p in parts if p)
        assert got[page.page_id].text == text and got[page.page_id].n_chars == len(text) and got[page.page_id].url == page.url


def test_hand_made_pages(model):
    pages = [
        "<html><body><header><h1>Site</h1></header><nav><a href=x>Home</a></nav><div id='cookie'>We use cookies <button>OK</button></div><main><h1>Title here</h1><p>First paragraph of the story, with words.</p><div class='ad-box'>Buy now!</div><p>Second &amp; last.</p><section class='comments'><h2>Comments</h2><p>Nice post!</p></section></main><aside>Related</aside><footer>c 2024</footer></body></html>",
        "<div class='menu'><ul><li>a</li></ul></div><div class='content'><p>Hello there, this is an article.<p>And more of it.</div><div class='footer'>foot</div>",
        "<html><body><article><h1>A</h1><p>b c d.</p><form><label>Email</label><input></form><div class='notice'>Please subscribe.</div><p>e f g.</p></article><div class='comments'><div class='comment'><p>Reader says hi, a long text of a reader that goes on.</p></div></div></body></html>",
    ]
    want = ["Title here\n\nFirst paragraph of the story, with words.\n\nSecond & last.", "Hello there, this is an article.\n\nAnd more of it.", "A\n\nb c d.\n\ne f g."]
    assert html_labeller.main_texts(pages, model) == want


def test_whole_blocks_and_paths(model):
    """Words late in a block count, and so does a container far above the text."""
    long = " ".join(["word"] * 3000)
    assert inputs(blocks(f"<p>{long} one</p>"))[1] != inputs(blocks(f"<p>{long} two</p>"))[1]
    deep = "<div>" * 40
    page = f"<html><body><article><h1>The title</h1>{'<p>A story of some words, told here.</p>' * 5}</article>{{}}</body></html>"
    story = "\n\n".join(["The title"] + ["A story of some words, told here."] * 5)
    for tag in ("<aside class='related'>", "<nav class='menu'>", "<footer class='footer'>", "<div class='comments'>"):
        text = "<p>Words of others that tell of this and that.</p>"
        end = f"</{tag[1:].split()[0]}>"
        assert html_labeller.main_texts([page.format(tag + deep + text + "</div>" * 40 + end)], model) == [story], tag
        path = blocks(tag + deep + text)[0].path
        assert len(path) < 6 and path[0] == f"tag {tag[1:].split()[0]}"


def test_odd_pages(spark):
    long_page = "<article>" + "<p>some words of a long page</p>" * 5000 + "</article>"
    rows = [(1, None, None), (1, None, None), (None, "u", ""), (2, "u", "   "), (3, "u", "<p"), (4, "u", long_page), (5, "u", "<article><p>" + "w " * 200_000)]
    pages = spark.createDataFrame([(*r, "x", 1) for r in rows], "page_id long, url string, html string, text string, n_chars int")
    got = html_labeller.extract(pages).collect()
    assert len(got) == len(rows)
    assert [(r.text, r.n_chars) for r in got if r.page_id in (1, 2)] == [("", 0)] * 3
    long = next(r for r in got if r.page_id == 4)
    assert long.text.count("some words") == 5000
    assert html_labeller.extract(pages.limit(0)).count() == 0
