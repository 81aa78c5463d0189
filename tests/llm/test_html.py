import re
import time
from html import unescape

import numpy as np
import pytest

from shapeloom.llm.html_blocks import Block, blocks, vectors
from shapeloom.llm.html_extract import extract, main_text
from shapeloom.llm.html_model import made_pages, probabilities, trained


@pytest.fixture(scope="module")
def weights():
    return list(trained())


def test_held_out_made_pages(weights):
    held = made_pages(300, 99)
    found = probabilities(weights, [x for x, _ in held])
    right = [((p >= 0.5) == (y > 0.5)).all() for p, (_, y) in zip(found, held)]
    assert np.mean(np.concatenate([(p >= 0.5) == (y > 0.5) for p, (_, y) in zip(found, held)])) > 0.995
    assert np.mean(right) > 0.95


def test_articles_of_the_given_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {r.page_id: r for r in extract(pages).collect()}
    wrong = 0
    for r in pages.collect():
        article = re.search(r"<article>(.*?)(</article>|\Z)", r.html or "", re.S)
        parts = re.split(r"</?(?:p|h1)>|<br>", re.sub(r"</?b>", "", article[1])) if article else []
        want = "\n".join(x for x in (" ".join(unescape(p).split()) for p in parts) if x)
        wrong += got[r.page_id].text != want
        assert got[r.page_id].n_chars == len(got[r.page_id].text) and got[r.page_id].url == r.url
    assert wrong <= 0.01 * len(got)


PAGE = """<!doctype html><html><head><title>T</title><style>p{}</style><script>var a="<p>no</p>";</script></head><body>
<header><a href=/>Site name</a></header><nav><ul><li><a href=/>Home</a><li><a href=/x>About</a></ul></nav>
<div class="cookie-notice">We use cookies here. <button>Accept</button></div>
<article><h1>Title &amp; more</h1><p>First   para&shy;graph with <a href=#>a link</a> and<br>a break.
<p>Second &lt;b&gt; one, which is longer and has some more words in it.</p><div class="ad">Buy now at a discount.</div>
<p>Third paragraph closes the text of this article.</p></article>
<aside class=sidebar><h3>Related</h3><ul><li><a href=/a>One other story</a></ul></aside>
<section id=comments><h2>Comments</h2><p>I think this is a great post and I agree.</p></section>
<form><label>Name</label><input><select><option>a<option>b</select></form><!-- <p>gone</p> --><footer>&copy; 2024 Site</footer>"""


def test_one_page(weights):
    assert main_text([PAGE], weights)[0].split("\n") == [
        "Title & more", "First para\xadgraph with a link and a break.",
        "Second <b> one, which is longer and has some more words in it.", "Third paragraph closes the text of this article."]


def test_odd_markup_and_nothing(spark, weights):
    odd = [None, "", "   ", "<", "<p", "<p class='x", "<script>never closed <p>x", "</div></p>", "<!--", "<p>&#0;&bogus;&lt", "a<b", "<a href=\"'>\">t</a>",
           "<div>" * 3000 + "deep", "<" * 20_000, "<p a='" * 5000, "<p>" + "word " * 300_000, "<p>x" * 20_000]
    began = time.time()
    texts = main_text([x or "" for x in odd], weights)
    assert time.time() - began < 60 and texts[:3] == ["", "", ""]
    assert [b.text for b in blocks("<p>a<b>b</b>c<p>d<br>e</p>f<td>g")] == ["abc", "d e", "f", "g"]
    pages = spark.createDataFrame([(i, "u", x, "t") for i, x in enumerate(odd)] + [(None, None, PAGE, "t")] * 2,
                                  "page_id long, url string, html string, text string")
    got = extract(pages).collect()
    assert len(got) == len(odd) + 2 and {r.page_id: r.text for r in got if r.page_id is not None} == dict(enumerate(texts))
    assert extract(pages.limit(0)).count() == 0


def test_only_scripts_styles_templates_and_titles_hold_no_blocks(weights):
    def texts(html):
        return [b.text for b in blocks(html)]
    assert texts("<p>Let <math><mi>x</mi><mo>=</mo><mn>2</mn></math> be.</p>") == ["Let x=2 be."]
    assert texts("<p>a</p><object>b<object>c</object>d</object><noscript><p>e</p></noscript><iframe>f</iframe>g") == list("abcdefg")
    assert texts("<svg><path d='M0'/><text>a</text><title>no</title></svg><svg/><p>b</p>") == ["a", "b"]
    for name in ("math", "object", "svg", "noscript", "iframe", "template"):
        assert texts(f"<{name}><p>a</p><p>b</p>") == ["a", "b"]
    assert texts("<p>a</p><template>no<template>no</template>no<!--</template>--></template><p>b</p>") == ["a", "b"]
    assert texts("<template/><p>a</p><template><p>b</p><template>no</template>") == ["a", "b"]
    page = PAGE.replace("<p>Second", "<noscript><p>This paragraph of the article stands in another element.</p></noscript><p>Second")
    assert "This paragraph of the article stands in another element." in main_text([page], weights)[0].split("\n")
    began = time.time()
    assert len(blocks("<template>a" * 20_000)) == 20_000 and time.time() - began < 20


def test_quotes_outside_values_and_digits_of_the_whole_block():
    def texts(html):
        return [b.text for b in blocks(html)]
    assert texts("<p title=it's>First we don't know.</p><p>Second</p>") == ["First we don't know.", "Second"]
    assert texts("<p it's>we don't</p><p 5\" x>a \"b\"</p><a href=/?q=\"x>c</a> \"d\"") == ["we don't", 'a "b"', 'c "d"']
    assert texts("<p title = 'a > b' id=\"c>d\">e</p>") == ["e"]
    assert texts("<p title='never closed>a</p><p>b</p>") == ["a", "b"]
    early, late = (vectors([Block(t, (), 0.0)])[0] for t in ("1" * 40 + "a" * 60, "a" * 60 + "1" * 40))
    assert early[-2] == late[-2] == np.float32(0.4)


@pytest.mark.parametrize("bit", ["<p a=", "<p x='a ", "</a ", "<p x='><p x='=", "<p x=\"'>", "=a=a<p =", "<!", "<script ", "</script ", "<p a=' b='> "])
def test_hostile_pages_take_time_in_proportion(bit):
    def seconds(n):
        began = time.process_time()
        blocks(bit * (n // len(bit)))
        blocks(bit * (n // len(bit)) + ">'>\">")
        return time.process_time() - began
    seconds(1000)
    assert seconds(1_000_000) < 20


def test_tags_equal_the_rule_read_slowly():
    """Each tag's end by the pattern alone, tried at every place, on random strings of the characters that matter."""
    import random

    from shapeloom.llm import html_blocks as hb
    rule = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^=>]++|=\s*+(?:\"[^\"]*+\"|'[^']*+'|[^\s\"'>][^\s>]*+)|=)*+)>"
                      r"|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>|<[!?][^>]*+>", re.S)
    rng = random.Random(4)
    for _ in range(20_000):
        html = "".join(rng.choice(["<", "<p ", "</p", ">", "=", "'", '"', " ", "a", "/", "<!--", "-->", "<!"]) for _ in range(rng.randint(0, 25)))
        for ends in (None, hb._TagEnds(html, 0)):
            tags, at, got = hb.Tags(html), 0, []
            tags.ends = ends
            while tag := tags.after(at):
                got.append(tag)
                at = tag[1]
            want = [(m.start(), m.end(), bool(m[1] or m[4]), (m[2] or m[5] or "").lower(), (m[3] or m[6] or "")) for m in rule.finditer(html)]
            assert [g[:4] + (g[4] if g[3] else "",) for g in got] == want, html


def slow_probabilities(weights, x):
    """The labeller in plain loops over blocks and cells."""
    import math
    n_hidden = len(weights[1])

    def read(rows, wx, wh, b):
        hid, cell, out = [0.0] * n_hidden, [0.0] * n_hidden, []
        for row in rows:
            seen = [i for i, v in enumerate(row) if v]
            z = [b[j] + sum(row[i] * wx[i][j] for i in seen) + sum(hid[i] * wh[i][j] for i in range(n_hidden)) for j in range(4 * n_hidden)]
            gate = [1 / (1 + math.exp(-v)) for v in z[:3 * n_hidden]]
            cell = [gate[n_hidden + j] * cell[j] + gate[j] * math.tanh(z[3 * n_hidden + j]) for j in range(n_hidden)]
            hid = [gate[2 * n_hidden + j] * math.tanh(cell[j]) for j in range(n_hidden)]
            out.append(hid)
        return out
    lists = [np.asarray(w, dtype=float).tolist() for w in weights]
    ahead, behind = read(x, *lists[:3]), read(x[::-1], *lists[3:6])[::-1]
    return [1 / (1 + math.exp(-sum(a[j] * lists[6][j] + b[j] * lists[7][j] for j in range(n_hidden)) - lists[8][0])) for a, b in zip(ahead, behind)]


def test_query_equals_a_slow_labeller(spark, weights, monkeypatch):
    from shapeloom.llm import html_model
    from shapeloom.llm.queries import QUERIES
    sf = "/root/testdata/sf0.001"
    pages = spark.read.parquet(f"{sf}/pages.parquet").collect()
    got = {r.page_id: r for r in QUERIES["op9_block_labeller"].build(spark, sf).collect()}
    assert len(got) == len(pages)
    for r in pages[:40]:
        page = blocks(r.html or "")
        p = slow_probabilities(weights, vectors(page).astype(float).tolist()) if page else []
        assert all(abs(v - 0.5) > 1e-4 for v in p)
        assert got[r.page_id].text == "\n".join(b.text for b, v in zip(page, p) if v >= 0.5)
    page = blocks("".join(f"<p class=c{k % 7}>{'word ' * (k % 9 + 1)}.</p>" for k in range(50)))
    want = slow_probabilities(weights, vectors(page).astype(float).tolist())
    for window in (1, 7, 50, 1000):  # whatever the window
        monkeypatch.setattr(html_model, "WINDOW", window)
        assert np.abs(probabilities(weights, [html_model.Sequence(page)])[0] - want).max() < 1e-4


def test_a_page_of_many_blocks_takes_little_memory(weights):
    import tracemalloc
    tracemalloc.start()
    main_text(["<p>x y" * 20_000], weights)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 40e6, peak  # dense vectors of all blocks alone are 25 MB, and were held several times
