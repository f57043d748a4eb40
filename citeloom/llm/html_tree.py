"""Page trees: tokens of raw HTML, elements with parents, and text with the element it stands in."""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass, field
from html import unescape

NAME = re.compile(r"[A-Za-z][^\s/>]*")
UNQUOTED = re.compile("[^>\"']*")
ATTRIBUTE = re.compile(r"(?<![A-Za-z-])([A-Za-z-]++)\s*+=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)")
PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")

#: Facts of the HTML standard: elements without content, of raw text, that end an open paragraph, and that close one another.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style".split())
BLOCK = frozenset(
    "html head body title address article aside blockquote center details dialog dd div dl dt fieldset figcaption figure footer form h1 h2 h3 "
    "h4 h5 h6 header hgroup hr li main menu nav ol p pre search section summary table tbody thead tfoot tr td th caption ul option select "
    "textarea button iframe noscript template svg video audio canvas object".split()
)
ENDS_P = frozenset(
    "address article aside blockquote center details dialog dd div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header "
    "hgroup hr li main menu nav ol p pre search section summary table ul".split()
)
SIBLINGS = {
    "li": ("li",), "dd": ("dd", "dt"), "dt": ("dd", "dt"), "option": ("option",), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
    "tbody": ("tbody", "thead", "tr", "td", "th"), "tfoot": ("tbody", "tr", "td", "th"), "body": ("head", "title"),
}
LIMITS = {"li": ("ul", "ol", "menu"), "dd": ("dl",), "dt": ("dl",), "option": ("select",), "tr": ("table",), "td": ("table", "tr"), "th": ("table", "tr"), "tbody": ("table",), "tfoot": ("table",)}
P_LIMITS = frozenset("table td th caption button object template html".split())


@dataclass
class Page:
    """Elements in page order: ``parents`` (-1 for the root), ``tags``, ``attributes``; ``texts`` are (element, block run, text)."""

    parents: list[int] = field(default_factory=list)
    depths: list[int] = field(default_factory=list)
    tags: list[str] = field(default_factory=list)
    attributes: list[str] = field(default_factory=list)
    texts: list[tuple[int, int, str]] = field(default_factory=list)


def decode(text: str) -> str:
    """Character references decoded; numbers of any length (a number beyond Unicode is U+FFFD)."""
    if "&" not in text:
        return text
    if "&#" in text:
        text = re.sub("&#0*+([1-9][0-9]{7,}+);?", "\ufffd", re.sub("&#0+(?=[0-9])", "&#", text))
    return unescape(text)


class Scanner:
    """Tokens of a page from left to right.

    A tag ends at the first > outside quotes. Where no such > is left, quotes count as any other character from there on,
    so what was looked at once without success is not looked at again and a page takes time in proportion to its length.
    """

    def __init__(self, source: str):
        self.source, self.at, self.last, self.quotes = source, 0, source.rfind(">"), True

    def next(self) -> tuple[str, str | None, bool, str]:
        """(text before, name, closing, attributes) of the next tag; comments have the name "", the end of the page None."""
        source, begin, look = self.source, self.at, self.at
        while (start := source.find("<", look)) >= 0:
            look = start + 1
            if source.startswith("<!--", start):
                end = source.find("-->", start + 4)
                self.at = len(source) if end < 0 else end + 3
                return source[begin:start], "", False, ""
            if start > self.last:  # no tag can end any more, but a comment can begin
                look = source.find("<!--", start)
                if look < 0:
                    break
            elif source[look] in "!?":
                self.at = source.find(">", look) + 1
                return source[begin:start], "", False, ""
            else:
                closing = source.startswith("/", look)
                name = NAME.match(source, look + closing)
                if name:
                    self.at = self._end(name.end()) + 1
                    return source[begin:start], name[0], closing, source[name.end() : self.at - 1]
        self.at = len(source)
        return source[begin:], None, False, ""

    def _end(self, at: int) -> int:
        """Place of the > that ends the tag whose name ends at ``at``; there is one from the tag's < on."""
        end = _unquoted_end(self.source, at) if self.quotes else -1
        if end < 0:
            self.quotes, end = False, self.source.find(">", at)
        return end

    def skip_to_end_tag(self, name: str) -> None:
        self.at = re.compile(f"</{name}\\s*>|\\Z", re.I).search(self.source, self.at).end()


def _unquoted_end(source: str, at: int) -> int:
    """Place of the first > outside quotes from ``at`` on, or -1."""
    while True:
        at = UNQUOTED.match(source, at).end()
        if at == len(source):
            return -1
        if source[at] == ">":
            return at
        at = source.find(source[at], at + 1) + 1
        if at == 0:
            return -1


def parse(html: str | None) -> Page:
    """The tree of a page. Any text gives a tree; unclosed and stray tags are mended much as browsers do."""
    page = Page([-1], [0], ["#page"], [""])
    stack, run, source = [0], 0, html or ""
    tags, parents, depths, attributes, texts = page.tags, page.parents, page.depths, page.attributes, page.texts
    open_at: dict[str, list[int]] = {}  # places in the stack of the open elements of a tag
    open_blocks = [0]

    def last(name: str) -> int:
        places = open_at.get(name)
        return places[-1] if places else 0

    def cut(place: int) -> None:
        while len(stack) > place:
            tag = tags[stack.pop()]
            open_at[tag].pop()
            if tag in BLOCK:
                open_blocks.pop()

    def close(name: str, limits) -> None:
        place = last(name)
        if place and all(last(limit) < place for limit in limits):
            cut(place)

    scanner = Scanner(source)
    while True:
        text, name, closing, attribute = scanner.next()
        if text:
            texts.append((stack[-1], run, decode(text)))
        if name is None:
            break
        if not name:
            continue
        name = name.lower()
        if name == "br":
            texts.append((stack[-1], run, "\n"))
            continue
        block = name in BLOCK
        run += block
        if closing:
            place = last(name)
            if place and (block or open_blocks[-1] < place):  # an inline end tag doesn't end a block
                cut(place)
            continue
        if name in ENDS_P:
            close("p", P_LIMITS)
        for other in SIBLINGS.get(name, ()):
            close(other, LIMITS.get(name, ()))
        parents.append(stack[-1])
        depths.append(len(stack))
        tags.append(name)
        attributes.append(attribute)
        if name in RAW:
            scanner.skip_to_end_tag(name)
        elif name not in VOID and not attribute.endswith("/"):
            open_at.setdefault(name, []).append(len(stack))
            if block:
                open_blocks.append(len(stack))
            stack.append(len(tags) - 1)
        elif name in VOID and block:
            run += 1
    return page


def blocks(page: Page, keep) -> str:
    """Kept texts: white space of a block is one space, blocks are joined by one space."""
    out, parts, current = [], [], -1
    for element, run, text in page.texts:
        if keep[element]:
            if run != current and parts:
                out.append(" ".join("".join(parts).split()))
                parts = []
            current = run
            parts.append(text)
    out.append(" ".join("".join(parts).split()))
    return " ".join(b for b in out if b)


def _bucket(n: int) -> int:
    return min(12, n.bit_length())


def features(page: Page, width: int) -> list[list[int]]:
    """Hashed features of each element: tag, parent's tag, parts of class, id and role, and the text and links below it."""
    n = len(page.tags)
    own, links, words, commas = [0] * n, [0] * n, [0] * n, [0] * n
    for element, _, text in page.texts:
        own[element] += len(text.strip())
        words[element] += text.count(" ")
        commas[element] += text.count(",") + text.count(". ")
    total = own[:]
    for i in range(n - 1, 0, -1):  # children come after their parents
        p = page.parents[i]
        if page.tags[i] == "a":
            links[i] = total[i]
        total[p] += total[i]
        links[p] += links[i]
        words[p] += words[i]
        commas[p] += commas[i]
    out = []
    for i, tag in enumerate(page.tags):
        parent = page.tags[page.parents[i]] if i else ""
        density = 0 if total[i] == 0 else 1 + int(4 * min(links[i], total[i]) / total[i])
        names = [f"t:{tag}", f"p:{parent}>{tag}", f"d:{density}", f"x:{tag}:{density}", f"n:{_bucket(total[i])}", f"c:{_bucket(commas[i])}", f"w:{_bucket(words[i])}", "bias"]
        if page.attributes[i]:
            for key, value in ATTRIBUTE.findall(page.attributes[i]):
                key = key.lower()
                if key in ("class", "id", "role"):
                    names += [f"a:{part.lower()}" for part in PART.findall(value)]
                elif key == "style" and "none" in value:
                    names.append("hidden")
        out.append([zlib.crc32(name.encode()) % width for name in names])
    return out
