import itertools
import re
import time
from html import unescape

import numpy as np
import pytest
from conftest import SMALL

from citeloom.llm import html_content as hc
from citeloom.llm.html_tree import blocks, features, parse


@pytest.fixture(scope="module")
def model():
    return hc.fit()


def gold(html):
    """The article of the given tables' layout, by cutting it out."""
    inner = re.search("<article>(.*)</article>", html, re.S)[1]
    return " ".join(unescape(re.sub("</?b>", "", re.sub("</?(p|h1|br)>", "\n", inner))).split())


def test_articles_of_the_table(spark, model):
    pages = spark.read.parquet(f"{SMALL}/pages.parquet")
    got = {r["page_id"]: r for r in hc.main_text(pages, model).collect()}
    for r in pages.collect():
        assert got[r["page_id"]]["text"] == gold(r["html"])
        assert got[r["page_id"]]["n_chars"] == len(gold(r["html"])) and got[r["page_id"]]["url"] == r["url"]


PAGE = """<html><head><title>T</title></head><body class="home"><div id="cookie-banner"><p>We use cookies, and more. <a href="#">Accept</a></p></div>
<header class="site-header"><a href="/">Logo</a><nav class="main-nav"><ul><li><a href=1>Home</a><li><a href=2>News</a></ul></nav></header>
<div class="layout"><aside class="sidebar"><h3>Popular</h3><p>Subscribe to our long letter, it is worth it, they say.</p></aside>
<main><article class="post"><h1>Real   title &amp; more</h1><p>First para with <a href=x>a link</a> and <b>bo</b>ld text.</p><div class="ad">Buy now! Cheap.</div>
<p>Second para,<br>with break &#233;.</p><ul><li>item one</li><li>item two</li></ul><form action="/s"><label>Mail</label><button>Send</button></form></article>
<section id="comments"><h2>Comments</h2><div class="comment"><p>I like this article a lot, it is great, and long.</p></div></section></main></div>
<footer>&copy; 2020 Me.</footer><script>var x="<p>no</p>"</script></body></html>"""


def test_edges(spark, model):
    want = "Real title & more First para with a link and bold text. Second para, with break é. item one item two"
    htmls = [None, "", "  ", "plain text only, no markup", PAGE, PAGE, "<", "<p", "<div " * 50, "<div>" * 3000 + "deep text, quite deep.", "</p></div>", "<script>only", "<!-- x"]
    rows = [(i, f"u{i}", h, "extra") for i, h in enumerate(htmls)] + [(None, None, PAGE, "extra")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = {r["page_id"]: r["text"] for r in hc.main_text(pages, model).collect()}
    assert len(got) == len(rows)
    assert [got[i] for i in (0, 1, 2, 3, 4, 5, 11)] == ["", "", "", "plain text only, no markup", want, want, ""]
    assert got[None] == want
    assert hc.main_text(pages.where("false"), model).count() == 0


def test_marginals_match_enumeration():
    rng = np.random.default_rng(1)
    page = parse("<div><p>one <b>two</b></p><nav><a>x</a><a>y</a></nav></div>")
    tree = hc.TreeModel(rng.standard_normal(hc.WIDTH), rng.standard_normal((3, 2, 2)))
    trees = hc.forest([page, page])
    n = len(page.tags)
    unary = np.bincount(trees.owners, weights=tree.weights[trees.features])[:n]
    sums, z = np.zeros(n), 0.0
    for states in itertools.product((0, 1), repeat=n):
        w = np.exp(unary @ np.array(states) + sum(tree.pairs[trees.kinds[i], states[page.parents[i]], states[i]] for i in range(1, n)))
        sums += w * np.array(states)
        z += w
    assert np.allclose(hc.marginals(trees, tree), np.tile(sums / z, 2))


def test_held_out_pages(model):
    pages, labels = hc.labelled_pages(150, seed=77)
    keep = hc.marginals(hc.forest(pages), model) >= 0.5
    assert (keep == np.concatenate(labels)).mean() > 0.98
    at = np.cumsum([0, *map(len, labels)])
    right = sum(blocks(p, keep[a:b]) == blocks(p, y) for p, y, a, b in zip(pages, labels, at[:-1], at[1:], strict=True))
    assert right >= 0.75 * len(pages)


@pytest.mark.parametrize("html", [
    "<b" * 200_000, "x <b c " * 150_000, "<b a=\">\"" * 100_000, "<p " + "a" * 500_000 + ">", "<div>" * 20_000 + "<p>" * 100, "<!--" * 100_000,
    "&#" + "1" * 10_000 + ";" + "&#" + "0" * 9_000 + "65;",
])
def test_long_and_broken_pages_take_linear_time(html):
    start = time.monotonic()
    features(parse(html), 1 << 12)
    assert time.monotonic() - start < 30  # some 0.1 s; the squares would take hours


def test_references_of_any_length():
    assert blocks(parse("a&#" + "0" * 9000 + "65;b&#" + "9" * 9000 + ";c"), [True]) == "aAb\ufffdc"
