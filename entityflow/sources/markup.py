"""A small page reader for the card extractors: elements, their text, and simple selectors.

Selectors: tag, .class, [attr], [attr='v'], [attr^='v'], :has(> tag), joined by
blank (inside) or '>' (directly inside), with ',' for alternatives.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import lru_cache
from html.parser import HTMLParser

# Fixed value: elements that never have content.
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
# Which open elements a start tag ends, as a browser reads it, and the elements that such an end can't cross.
BLOCKS = {
    "address", "article", "aside", "blockquote", "center", "details", "dialog", "dir", "div", "dl", "fieldset", "figcaption", "figure", "footer",
    "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "main", "menu", "nav", "ol", "p", "pre", "search", "section", "summary", "table", "ul",
}
IMPLIED = {
    "li": ({"li"}, {"ul", "ol", "menu", "table", "td", "th"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select", "datalist"}), "optgroup": ({"option", "optgroup"}, {"select"}),
    "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "tr": ({"tr", "td", "th"}, {"table"}),
    "tbody": ({"tr", "td", "th", "thead", "tbody", "tfoot"}, {"table"}), "thead": ({"tr", "td", "th", "tbody"}, {"table"}),
    "tfoot": ({"tr", "td", "th", "thead", "tbody"}, {"table"}),
}
# A run of start tags without attributes, and the elements whose content the parser reads as text.
BARE_TAGS = re.compile(r"(?:<[A-Za-z][A-Za-z0-9]*>)+")
RAW = {"script", "style", "title", "textarea", "iframe", "noembed", "noframes", "noscript", "plaintext", "xmp"}
SPECIAL = VOID | BLOCKS | set(IMPLIED) | RAW
P_SCOPE = {"button", "td", "th", "table", "caption", "object", "template"}
SIMPLE = re.compile(r"^([\w-]+|\*)?((?:\.[\w-]+|\[[^\]]+\])*)(?::has\(>\s*([\w-]+)\))?$")
ATTR = re.compile(r"\[\s*([\w-]+)\s*(?:(\^?=)\s*['\"]?([^'\"\]]*)['\"]?\s*)?\]")


class Node:
    """One element of a page, by its number in document order."""

    __slots__ = ("page", "number")

    def __init__(self, page, number):
        self.page, self.number = page, number

    @property
    def tag(self) -> str:
        return self.page.tags[self.number]

    @property
    def attrs(self) -> dict[str, str]:
        return self.page.attributes[self.number]

    @property
    def parent(self) -> Node | None:
        above = self.page.parents[self.number]
        return None if above < 0 else Node(self.page, above)

    def text(self) -> str:
        return "".join(self.strings())

    def strings(self) -> list[str]:
        page = self.page
        return page.texts[page.text_starts[self.number] : page.text_ends[self.number]]


class Nodes(Sequence):
    """A stretch of a page's elements in document order."""

    def __init__(self, page, numbers: range):
        self.page, self.numbers = page, numbers

    def __len__(self) -> int:
        return len(self.numbers)

    def __getitem__(self, k: int) -> Node:
        return Node(self.page, self.numbers[k])


class Page(HTMLParser):
    """Elements in document order; unknown end tags are ignored, open ones close with their parent.

    ``implied`` also ends an element where a browser does: a list item at the next one, a paragraph at the next block,
    cells and rows at the next ones. Elements are columns, a value per element: tag, attributes, number of the parent (-1: none)
    and, as descendants and texts of an element are stretches in document order, where these start and end (None: with the page).
    """

    def __init__(self, html: str, implied: bool = False):
        super().__init__(convert_charrefs=True)
        self.implied = implied
        self.texts: list[str] = []
        self.tags, self.attributes, self.parents, self.ends, self.text_starts, self.text_ends = [], [], [], [], [], []
        self._open = [-1]
        self.feed(html)
        self.close()

    @property
    def nodes(self) -> Nodes:
        return Nodes(self, range(len(self.tags)))

    def updatepos(self, i, j):
        """Line numbers are never asked for; counting them is a tenth of the reading time."""
        return j

    def _close_implied(self, tag):
        if tag in BLOCKS:
            self._close({"p"}, P_SCOPE)
        if tag in IMPLIED:
            self._close(*IMPLIED[tag])

    def _close(self, ended, scope):
        """End the outermost open element of ``ended`` above the nearest of ``scope``."""
        last = None
        for depth in range(len(self._open) - 1, 0, -1):
            tag = self.tags[self._open[depth]]
            if tag in scope:
                break
            if tag in ended:
                last = depth
        if last is not None:
            self._end(last)

    def _end(self, depth):
        for number in self._open[depth:]:
            self.ends[number], self.text_ends[number] = len(self.tags), len(self.texts)
        del self._open[depth:]

    def _add(self, tags, attributes):
        """Elements that each lie in the one before, the first in the last open one."""
        first, n = len(self.tags), len(tags)
        self.tags += tags
        self.attributes += attributes
        self.parents += [self._open[-1], *range(first, first + n - 1)]
        self.ends += [None] * n
        self.text_starts += [len(self.texts)] * n
        self.text_ends += [None] * n
        self._open += range(first, first + n)

    def parse_starttag(self, i):
        """Start tags without attributes that end no other element are read a run at a time."""
        run = BARE_TAGS.match(self.rawdata, i)
        if run is None:
            return super().parse_starttag(i)
        tags = run.group()[1:-1].lower().split("><")
        plain = len(tags) if SPECIAL.isdisjoint(tags) else next(k for k, tag in enumerate(tags) if tag in SPECIAL)
        if not plain:
            return super().parse_starttag(i)
        self._add(tags[:plain], [{}] * plain)
        return i + sum(map(len, tags[:plain])) + 2 * plain

    def handle_starttag(self, tag, attrs):
        if self.implied:
            self._close_implied(tag)
        self._add([tag], [{k: v or "" for k, v in attrs}])
        if tag in VOID:
            self._end(len(self._open) - 1)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self._end(len(self._open) - 1)

    def handle_endtag(self, tag):
        for depth in range(len(self._open) - 1, 0, -1):
            if self.tags[self._open[depth]] == tag:
                self._end(depth)
                return

    def handle_data(self, data):
        self.texts.append(data)


@lru_cache(maxsize=256)
def _compiled(selector: str):
    """[[(joint, tag, classes, attrs, child tag), ...] per alternative], and the tags that can match (None: any)."""
    out = []
    for alternative in selector.split(","):
        spaced = re.sub(r"\s*>\s*(?![^(]*\))", " > ", alternative.strip())
        tokens = re.findall(r"(?:[^\s(\[]|\([^)]*\)|\[[^\]]*\])+", spaced)
        steps, joint = [], " "
        for token in tokens:
            if token == ">":
                joint = ">"
                continue
            tag, rest, child = SIMPLE.match(token).groups()
            classes = re.findall(r"\.([\w-]+)", re.sub(r"\[[^\]]*\]", "", rest))
            steps.append((joint, None if tag in (None, "*") else tag, classes, ATTR.findall(rest), child))
            joint = " "
        out.append(steps)
    tags = {steps[-1][1] if steps else None for steps in out}
    return out, None if None in tags else tags


def _fits(node: Node, step) -> bool:
    _, tag, classes, attrs, child = step
    if tag and node.tag != tag:
        return False
    if classes and not set(classes) <= set(node.attrs.get("class", "").split()):
        return False
    for name, op, value in attrs:
        got = node.attrs.get(name)
        if got is None or (op == "=" and got != value) or (op == "^=" and not got.startswith(value)):
            return False
    return not child or any(c.tag == child and c.page.parents[c.number] == node.number for c in within(node))


def _matches(node: Node, steps) -> bool:
    if not _fits(node, steps[-1]):
        return False
    if len(steps) == 1:
        return True
    up = node.parent
    while up is not None:
        if _matches(up, steps[:-1]):
            return True
        if steps[-1][0] == ">":
            return False
        up = up.parent
    return False


def within(node: Node) -> Nodes:
    end = node.page.ends[node.number]
    return Nodes(node.page, range(node.number + 1, len(node.page.tags) if end is None else end))


def select(nodes: Nodes, selector: str):
    """Elements matching the selector, in document order."""
    alternatives, tags = _compiled(selector)
    page, known = nodes.page, nodes.page.tags
    found = (Node(page, k) for k in nodes.numbers if tags is None or known[k] in tags)
    return (n for n in found if any(_matches(n, steps) for steps in alternatives))


def first(node: Node, selector: str):
    return next(select(within(node), selector), None)
