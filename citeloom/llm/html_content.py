"""Main text of raw pages by a tree-structured graphical model.

Every element of a page is a binary variable: part of the article (or around it), or not. An element has a potential from its
own features, and each parent and child share one that depends on what the child is (inline, block or section). The
graph is the page's tree, so one sum-product pass upward and one downward give the exact marginals; text stays where the
marginal of its element says content. Weights maximise the likelihood of labelled pages, with gradients from the
same passes. The labelled pages are drawn here: layouts with articles, menus, headers, footers, sidebars, notices, adverts,
forms, scripts and reader comments, under many names and with unclosed tags.

Passes run over all pages of a batch at once, depth by depth.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citeloom.llm.common import map_columns
from citeloom.llm.html_tree import BLOCK, Page, blocks, features, parse

WIDTH = 4096
TRAIN_PAGES, EPOCHS = 600, 80
SECTIONS = frozenset("article section main div aside nav header footer form body html table ul ol dl figure".split())


@dataclass(frozen=True)
class TreeModel:
    """Feature weights, and pair potentials by kind of child, state of the parent and state of the child."""

    weights: np.ndarray
    pairs: np.ndarray


@dataclass(frozen=True)
class Forest:
    """The elements of many pages, one after the other."""

    parents: np.ndarray
    kinds: np.ndarray
    levels: list[np.ndarray]
    features: np.ndarray
    owners: np.ndarray


def forest(pages: list[Page]) -> Forest:
    """Elements of all pages with global parent numbers, kinds, elements by depth, and features in one flat list."""
    parents, kinds, depths, flat, sizes, offset = [], [], [], [], [], 0
    for page in pages:
        parents += [p + offset if p >= 0 else -1 for p in page.parents]
        depths += page.depths
        kinds += [2 if t in SECTIONS else 1 if t in BLOCK else 0 for t in page.tags]
        for own in features(page, WIDTH):
            flat += own
            sizes.append(len(own))
        offset += len(page.tags)
    depth = np.array(depths, np.int64)
    order = np.argsort(depth, kind="stable")
    levels = np.split(order, np.flatnonzero(np.diff(depth[order])) + 1)
    return Forest(np.array(parents, np.int64), np.array(kinds, np.int64), levels, np.array(flat, np.int64), np.repeat(np.arange(len(sizes)), sizes))


def _log_add(a: np.ndarray, axis: int) -> np.ndarray:
    return np.logaddexp(a.take(0, axis), a.take(1, axis))


def sum_product(trees: Forest, model: TreeModel):
    """Beliefs before and after the downward pass (elements x 2), and each element's message to its parent."""
    n = len(trees.parents)
    below = np.zeros((n, 2))
    below[:, 1] = np.bincount(trees.owners, weights=model.weights[trees.features], minlength=n)
    up = np.zeros((n, 2))
    for level in reversed(trees.levels[1:]):
        up[level] = _log_add(below[level][:, None, :] + model.pairs[trees.kinds[level]], 2)
        np.add.at(below, trees.parents[level], up[level])
    total = below.copy()
    for level in trees.levels[1:]:
        from_parent = total[trees.parents[level]] - up[level]
        total[level] += _log_add(from_parent[:, :, None] + model.pairs[trees.kinds[level]], 1)
    return below, total, up


def marginals(trees: Forest, model: TreeModel) -> np.ndarray:
    """Probability of content of each element."""
    _, total, _ = sum_product(trees, model)
    return 1 / (1 + np.exp(np.clip(total[:, 0] - total[:, 1], -500, 500)))


def train(pages: list[Page], labels: list[np.ndarray], epochs: int = EPOCHS) -> TreeModel:
    """Weights of maximal likelihood (with a small penalty) by Adam on exact gradients."""
    trees, y = forest(pages), np.concatenate(labels).astype(float)
    model = TreeModel(np.zeros(WIDTH), np.zeros((3, 2, 2)))
    child = np.flatnonzero(trees.parents >= 0)
    parent, kind = trees.parents[child], trees.kinds[child]
    seen = np.zeros((3, 2, 2))
    np.add.at(seen, (kind, y[parent].astype(int), y[child].astype(int)), 1)
    state = [(np.zeros_like(a), np.zeros_like(a)) for a in (model.weights, model.pairs)]
    for step in range(1, epochs + 1):
        below, total, up = sum_product(trees, model)
        p = 1 / (1 + np.exp(np.clip(total[:, 0] - total[:, 1], -500, 500)))
        both = (total[parent] - up[child])[:, :, None] + model.pairs[kind] + below[child][:, None, :]
        both = np.exp(both - both.max(axis=(1, 2), keepdims=True))
        both /= both.sum(axis=(1, 2), keepdims=True)
        expected = np.zeros_like(seen)
        np.add.at(expected, kind, both)
        rise = np.bincount(trees.features, weights=(y - p)[trees.owners], minlength=WIDTH) / len(pages) - 1e-3 * model.weights
        moved = []
        for value, gradient, (first, second) in zip((model.weights, model.pairs), (rise, (seen - expected) / len(pages) - 1e-3 * model.pairs), state, strict=True):
            first += 0.1 * (gradient - first)
            second += 0.01 * (gradient * gradient - second)
            moved.append(value + 0.1 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8))
        model = TreeModel(*moved)
    return model


#: Names that page parts go by in the drawn pages.
NAMES = {
    "wrap": "wrapper container page site outer inner row layout content-area wrap shell root app columns",
    "article": "article content post entry story main post-content article-body entry-content story-body main-content text body-text",
    "nav": "nav menu navbar navigation breadcrumb breadcrumbs topnav main-menu tabs pager pagination toc skip-link",
    "header": "header site-header masthead banner top branding logo topbar",
    "footer": "footer site-footer copyright bottom legal colophon footer-links credits",
    "side": "sidebar aside widget related recommended trending popular rail side-column more-stories tags archive",
    "ad": "ad ads advert advertisement sponsor sponsored promo banner-ad adbox google-ads promotion ad-slot",
    "notice": "cookie cookie-notice consent gdpr notice alert popup modal overlay paywall subscribe-banner warning message",
    "share": "share social social-links share-buttons follow like-box meta-tools actions",
    "comments": "comments comment-list comment disqus responses replies discussion reader-comments user-comments comment-body",
    "form": "newsletter search search-form login signup subscribe contact form subscription",
}


class _Drawn:
    """Draws pages; every element carries its label in a ``data-y`` attribute, which is no feature."""

    def __init__(self, seed: int):
        self.rng = np.random.default_rng(seed)

    def chance(self, p: float) -> bool:
        return self.rng.random() < p

    def pick(self, options):
        return options[int(self.rng.integers(len(options)))]

    def words(self, low: int, high: int) -> str:
        out = []
        for _ in range(int(self.rng.integers(low, high + 1))):
            word = "".join(chr(97 + int(c)) for c in self.rng.integers(0, 26, int(self.rng.integers(1, 10))))
            out.append(word + self.pick(["", "", "", "", ",", "."]))
        return " ".join(out).capitalize()

    def name(self, kind: str, often: float = 0.85) -> str:
        if not self.chance(often):
            return self.pick(["", f' class="{self.words(1, 1).strip(".,").lower()}"'])
        return f' {self.pick(["class", "class", "id"])}="{self.pick(NAMES[kind].split())}{self.pick(["", "", " x1", " clearfix"])}"'

    def el(self, tag: str, y: int, inner: str, attrs: str = "", end: bool = True) -> str:
        return f'<{tag}{attrs} data-y="{y}">{inner}' + (f"</{tag}>" if end else "")

    def links(self, y: int, n: int) -> str:
        items = [self.el("a", y, self.words(1, 3), ' href="/x"') for _ in range(n)]
        return self.el("ul", y, "".join(self.el("li", y, i, end=self.chance(0.9)) for i in items)) if self.chance(0.7) else self.pick([" | ", " ", "<br>"]).join(items)

    def inline(self, y: int) -> str:
        text = self.words(3, 40)
        for tag in ("b", "a", "em", "span", "code", "i"):
            if self.chance(0.15):
                text += " " + self.el(tag, y, self.words(1, 6), ' href="/y"' if tag == "a" else "") + self.pick([" ", ". ", ", "]) + self.words(1, 20)
        return text

    def paragraph(self, y: int) -> str:
        if self.chance(0.08):
            return f'<p data-y="{y}"><b data-y="{y}">{self.words(2, 20)}<br>'
        return self.el("p", y, self.inline(y) if self.chance(0.85) else self.words(1, 4), end=self.chance(0.9))

    def nav(self) -> str:
        tag = self.pick(["nav", "nav", "div", "ul"])
        return self.el(tag, 0, self.links(0, int(self.rng.integers(2, 9))), self.name("nav", 0.9 if tag != "nav" else 0.4))

    def header(self) -> str:
        tag = self.pick(["header", "header", "div"])
        inner = self.pick([self.el("h1", 0, self.words(1, 4)), self.el("a", 0, self.words(1, 3)), self.el("p", 0, self.words(2, 12))])
        return self.el(tag, 0, inner + (self.nav() if self.chance(0.4) else ""), self.name("header", 0.95 if tag == "div" else 0.4))

    def footer(self) -> str:
        tag = self.pick(["footer", "footer", "div"])
        inner = self.pick([f"&copy; {self.words(1, 3)} &middot; {self.words(1, 25)}", self.links(0, 4), self.el("p", 0, self.words(3, 20))])
        return self.el(tag, 0, inner, self.name("footer", 0.95 if tag == "div" else 0.4))

    def part(self, kind: str) -> str:
        if kind == "form":
            options = "".join(self.el("option", 0, self.words(1, 2)) for _ in range(3))
            fields = self.el("label", 0, self.words(1, 3)) + '<input type="text">' + self.pick(["", self.el("select", 0, options), self.el("textarea", 0, self.words(1, 4))])
            fields += self.el("button", 0, self.words(1, 2))
            return self.el("form", 0, self.el("p", 0, self.words(3, 15)) + fields, self.name("form", 0.5))
        if kind == "comments":
            one = lambda: self.el(self.pick(["div", "li", "article"]), 0, self.el("p", 0, self.words(3, 40)), self.name("comments", 0.8))
            head = self.el(self.pick(["h2", "h3"]), 0, self.words(1, 3))
            return self.el(self.pick(["section", "div", "ol"]), 0, head + "".join(one() for _ in range(int(self.rng.integers(1, 4)))), self.name("comments", 1.0))
        if kind == "side":
            tag = self.pick(["aside", "aside", "div", "section"])
            inner = self.el("h3", 0, self.words(1, 3)) + self.pick([self.links(0, 5), self.el("p", 0, self.words(5, 30)), self.links(0, 3) + self.el("p", 0, self.words(3, 20))])
            return self.el(tag, 0, inner, self.name("side", 1.0 if tag != "aside" else 0.4))
        inner = self.pick([self.words(2, 25), self.el("p", 0, self.words(3, 30)), self.el("a", 0, self.words(2, 8), ' href="/ad"'), self.links(0, 3)])
        return self.el(self.pick(["div", "div", "section", "p", "span"]), 0, inner, self.name(kind, 1.0))

    def article(self) -> str:
        body = [self.el(self.pick(["h1", "h1", "h2"]), 1, self.words(2, 12))] if self.chance(0.9) else []
        for _ in range(int(self.rng.integers(1, 9))):
            draw = self.rng.random()
            if draw < 0.7:
                body.append(self.paragraph(1))
            elif draw < 0.75:
                body.append(self.el(self.pick(["h2", "h3"]), 1, self.words(1, 6)))
            elif draw < 0.85:
                item = self.pick([lambda: self.inline(1), lambda: self.words(1, 5)])
                body.append(self.el(self.pick(["ul", "ol"]), 1, "".join(self.el("li", 1, item()) for _ in range(int(self.rng.integers(1, 6))))))
            elif draw < 0.88:
                body.append(self.el("blockquote", 1, self.paragraph(1)))
            elif draw < 0.91:
                body.append(self.el("pre", 1, self.el("code", 1, self.words(3, 20))))
            elif draw < 0.94:
                row = lambda: self.el("tr", 1, "".join(self.el("td", 1, self.words(1, 4)) for _ in range(3)))
                body.append(self.el("table", 1, row() + row()))
            elif draw < 0.96:
                body.append(self.el("figure", 1, '<img src="x">' + self.el("figcaption", 1, self.words(3, 12))))
            else:
                body.append(self.el("div", 1, self.paragraph(1) + self.paragraph(1)))
            if self.chance(0.12):
                body.append(self.part(self.pick(["ad", "share", "side", "form", "notice", "comments"])))
        tag = self.pick(["article", "article", "article", "div", "main", "section"])
        inner = "".join(body)
        if self.chance(0.2):
            inner = self.el("div", 1, inner, self.name("article", 0.8))
        return self.el(tag, 1, inner, self.name("article", 0.3 if tag == "article" else 0.7))

    def page(self) -> str:
        before = [self.header(), self.nav(), self.part("ad"), self.part("notice"), self.part("form")]
        after = [self.part("side"), self.part("comments"), self.part("ad"), self.part("share"), self.part("form"), self.part("notice")]
        body = "".join(b for b in before if self.chance(0.5)) + "<!-- x -->" + self.article() + "".join(a for a in after if self.chance(0.35))
        for _ in range(int(self.rng.integers(0, 3))):
            body = self.el("div", 1, body, self.name("wrap", 0.8))
        body += self.footer() if self.chance(0.85) else ""
        head = self.el("title", 0, self.words(2, 10)) + "<style>p{margin:0}</style>" + '<script>var t="</p>";</script>' + '<meta charset="utf-8">'
        if self.chance(0.15):
            body = self.el("noscript", 0, self.words(2, 8)) + body
        return "<!DOCTYPE html>" + self.el("html", 1, self.el("head", 0, head) + self.el("body", 1, body), ' lang="en"')


def labelled_pages(n: int, seed: int = 11) -> tuple[list[Page], list[np.ndarray]]:
    """Drawn pages and the label of each element; elements without one have their parent's."""
    drawn, pages, labels = _Drawn(seed), [], []
    for _ in range(n):
        page = parse(drawn.page())
        y = np.zeros(len(page.tags), np.int64)
        y[0] = 1
        for i in range(1, len(y)):
            m = re.search('data-y="([01])"', page.attributes[i])
            y[i] = int(m[1]) if m else 0 if page.tags[i] in ("script", "style", "meta") else y[page.parents[i]]
        pages.append(page)
        labels.append(y)
    return pages, labels


def fit(pages: int = TRAIN_PAGES) -> TreeModel:
    """The model of the drawn pages; their number is the bound of the training set."""
    return train(*labelled_pages(pages))


def extract(htmls: list[str | None], model: TreeModel) -> list[str]:
    """Main text of each page."""
    pages = [parse(h) for h in htmls]
    if not pages:
        return []
    keep = (marginals(forest(pages), model) >= 0.5).tolist()
    out, at = [], 0
    for page in pages:
        out.append(blocks(page, keep[at : at + len(page.tags)]))
        at += len(page.tags)
    return out


def main_text(pages: DataFrame, model: TreeModel) -> DataFrame:
    """(page_id, url, text, n_chars) of each row of ``pages``.

    Null and empty pages, and pages without content, have the empty text. A page without markup is its text. Repeated rows
    give repeated results; other columns are not looked at; an empty table gives an empty table.
    """
    sent = pages.sparkSession.sparkContext.broadcast(model)

    def run(batch: pa.RecordBatch) -> dict:
        htmls, texts = batch.column(2).to_pylist(), []
        for at in range(0, len(htmls), 200):
            texts += extract(htmls[at : at + 200], sent.value)
        return {"page_id": batch.column(0), "url": batch.column(1), "text": texts, "n_chars": [len(t) for t in texts]}

    rows = pages.select(F.col("page_id").cast("long"), "url", "html")
    return map_columns(rows, run, "page_id long, url string, text string, n_chars long")
