from __future__ import annotations

import html
import itertools
import re
import time

import numpy as np
import pytest

from roomledger.llm import extraction as X
from roomledger.llm.dom import Block, blocks
from roomledger.llm.labelled_pages import labelled_pages


@pytest.fixture(scope="module")
def model():
    return X.default_field()


def test_blocks_of_untidy_pages():
    text = lambda page: [b.text for b in blocks(page)]
    assert text("") == [] and text("plain") == ["plain"] and text("a < b &lt; c &amp d &#8364;") == ["a < b < c & d €"]
    assert text("<p>one <b>two<br>three<p>four</b> five</p>six") == ["one two three", "four five", "six"]
    assert text('<script>var t="</p>";</script><p>x<!-- <p>no --> y</p><style>p{}</style>') == ["x y"]
    assert text("<ul><li>a<li>b</ul><p>c") == ["a", "b", "c"]
    assert text("<p>kept <script>lost") == ["kept"] and text("<p>kept<!-- lost") == ["kept"] and text("<p>kept <a hre") == ["kept"]
    assert text('<p title="a > b">x</p>') == ["x"]
    (inner,) = [b for b in blocks('<article class="post main"><div id=c><p><i>x') if b.text == "x"]
    assert inner.path == (("article", "post main"), ("div", "c"), ("p", ""))


def test_time_and_memory_grow_with_broken_pages(model):
    n = 30_000
    broken = ["<a " * n, '<a "' * n, '<a "' * n + ">", "<a<a" * n + ">", "<a<a" * n + "'>", "<div>a" * n, "<div class=c><b>" * n + "x",
              "<b>" * n + "</i>" * n, "<p>" + "<b>" * n + "<hr>" * n, "<ul><li>" * n + "</ol>" * n, "<a href='\">" * n, "<!" * n, "</" * n, "<!--" * n,
              "<script" * n, "<a <b c='" * n + "<p>x</p>", "".join(f"<div class=k{k}>a" for k in range(n))]
    for page in broken:
        begun = time.process_time()
        labels = model.decode(found := blocks(page))
        assert len(labels) == len(found) and time.process_time() - begun < 10, page[:20]
    assert len(blocks("<div>a" * n)) == n
    assert [b.text for b in blocks("x <a 'y <p>z</p>")] == ["x <a 'y", "z"] and [b.text for b in blocks('a <b c="> d</b>')] == ["a d"]


def test_score_of_a_place_is_the_sum_of_its_features(model):
    for page, _ in labelled_pages(20, seed=11):
        states = {}
        for b in page:
            want = model.bias + sum(model.weights.get(f, 0.0) for f in X.path_features(b.path) + X.text_features(b))
            assert model._emission(b, states) == pytest.approx(want)


def test_cues_at_the_end_of_long_blocks():
    long = "w" * 3000
    assert "cue newsletter" in X.text_features(Block(long + " newsletter", None, 0)) and "cue advert" in X.text_features(Block("advert " + long, None, 0))
    assert not any(f.startswith("cue") for f in X.text_features(Block(long + " advert " + long, None, 0)))


def test_held_out_labelled_pages(model):
    pages = labelled_pages(150, seed=1234)
    wrong = sum(a != b for page, labels in pages for a, b in zip(model.decode(page), labels))
    assert wrong / sum(len(y) for _, y in pages) < 0.02


def test_decoding_finds_the_best_of_all_labellings(model):
    for page, _ in labelled_pages(25, seed=5):
        page = page[:8]

        def value(labels):
            total = model.first[labels[0]] + sum(model._emission(b) for b, y in zip(page, labels) if y)
            return total + sum(model.moves[a, b] for a, b in zip(labels, labels[1:]))

        best = max(itertools.product((0, 1), repeat=len(page)), key=value)
        assert value(best) == pytest.approx(value(model.decode(page)))


def test_marginals_equal_sums_over_all_labellings():
    rng = np.random.default_rng(2)
    emission, moves, first = rng.normal(size=(2, 4)), rng.normal(size=(2, 2)), rng.normal(size=2)
    length = np.array([4, 3])
    chance, pairs = X._marginals(emission, length, moves, first)
    want = np.zeros((2, 2))
    for p, n in enumerate(length):
        weights = {}
        for y in itertools.product((0, 1), repeat=int(n)):
            weights[y] = np.exp(first[y[0]] + sum(emission[p, t] for t in range(n) if y[t]) + sum(moves[a, b] for a, b in zip(y, y[1:])))
        total = sum(weights.values())
        for t in range(n):
            assert chance[p, t] == pytest.approx(sum(w for y, w in weights.items() if y[t]) / total)
        for y, w in weights.items():
            for a, b in zip(y, y[1:]):
                want[a, b] += w / total
    assert np.allclose(pairs, want)


def test_articles_of_the_given_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    found = {r.page_id: r for r in X.extract(pages).collect()}
    assert len(found) == pages.count()
    for r in pages.collect():
        inside = re.search(r"<article>(.*?)(?:</article>|$)", r.html, re.S)[1]
        parts = [" ".join(html.unescape(re.sub("<[^>]*>", " ", x)).split()) for x in re.split(r"</?(?:p|h1)>", inside)]
        want = "\n".join(x for x in parts if x)
        assert found[r.page_id].text == want and found[r.page_id].n_chars == len(want) and found[r.page_id].url == r.url


def test_menus_notices_forms_and_comments_go(model):
    page = (
        "<html><head><title>No</title></head><body><header><h1>Site name</h1></header><nav><ul><li><a href=/>Home</a></li></ul></nav>"
        "<main><div class='cookie-notice'>We use cookies.</div><article><h1>Title</h1><p>First words of it.</p><div class=ad>Buy now</div>"
        "<aside class='sidebar'><p>Also read</p></aside><p>Second words &eacute;.</p><form><label>Name</label><button>Send</button></form></article>"
        "<section id='comments'><p>A reader says a lot of things here, and more.</p></section></main><footer>&copy; 2020</footer></body></html>"
    )
    assert X.main_text(page, model) == "Title\nFirst words of it.\nSecond words é."
    bare = "<body><div id='header'>Top</div><div class='content'><h2>T</h2><p>Some text here.</p></div><div id='footer'>End</div></body>"
    assert X.main_text(bare, model) == "T\nSome text here."


def test_messy_pages(spark):
    schema = "page_id long, url string, html string, text string, n_chars string"
    rows = [(1, "u", None, "x", "y"), (1, "u", "", "x", "y"), (None, None, "<nav>a</nav>", "x", "y"), (2, "v", "<article>" + "<p>w x</p>" * 20000, None, None),
            (2, "v", "<" * 5000 + "p>" * 100, None, None), (3, "w", "<article><h1>&</h1><p>\x00 a &nbsp; b</article>", "x", "y")]
    found = X.extract(spark.createDataFrame(rows, schema)).collect()
    assert len(found) == len(rows) and all(r.n_chars == len(r.text) for r in found)
    assert [r.text for r in found if r.page_id == 1] == ["", ""] and [r.text for r in found if r.page_id is None] == [""]
    assert max(r.n_chars for r in found) == 20000 * 4 - 1
    assert X.extract(spark.createDataFrame([], schema)).count() == 0
    assert isinstance(blocks("<p>x")[0], Block)
