"""Block elements of an HTML page, their texts, and what a classifier can know about them."""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field

import numpy as np

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<[a-zA-Z/!?][^>]*+(?:>|\Z)", re.DOTALL
)
_ATTRIBUTE = re.compile(r"([^\s=\"'/]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
_NAMES = re.compile(r"[a-z]+|[0-9]+")

INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark picture q s samp small source "
    "span strike strong sub sup time tt u var wbr svg path".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = frozenset("script style template noscript title head svg math object iframe select option textarea".split())
RAW = frozenset("script style textarea title noscript iframe template".split())
#: An element that is still open when another of these begins ends there; listed are those that hold it open.
ENDED_BY_LIKE = {
    "li": "ul ol menu", "dt": "dl", "dd": "dl", "tr": "table thead tbody tfoot", "td": "tr table", "th": "tr table", "option": "select"
}
_HOLDERS = {k: frozenset(v.split()) for k, v in ENDED_BY_LIKE.items()}

#: Words in class, id or role that speak for or against content.
POSITIVE = frozenset("article body content entry main post story text".split())
NEGATIVE = frozenset(
    "ad ads advert advertisement banner breadcrumb comment comments consent cookie copyright disclaimer footer form gdpr header "
    "login masthead menu meta nav navbar navigation newsletter notice pager pagination popup promo recommended related reply "
    "replies search share sidebar signup social sponsor sponsored subscribe tags toolbar widget".split()
)
_SECTIONS = {"article": 1, "main": 1, "section": 2, "nav": 3, "menu": 3, "aside": 4, "header": 5, "footer": 6, "form": 7, "button": 7, "fieldset": 7}
_BLOCKS = {"p": 1, "h1": 2, "h2": 3, "h3": 3, "h4": 3, "h5": 3, "h6": 3, "div": 4, "ul": 5, "ol": 5, "li": 6, "table": 7, "tr": 7, "td": 7, "pre": 8, "blockquote": 8, "body": 9, "html": 9}


@dataclass
class Node:
    tag: str
    parent: int
    depth: int
    positive: int = 0
    negative: int = 0
    given: int = -1  # label put there for training
    own: int = 0  # characters of its own text
    links: int = 0  # of them within links
    marks: int = 0  # punctuation marks
    words: int = 0
    inline: int = 0  # inline elements
    place: int = 0  # among its parent's children
    children: list[int] = field(default_factory=list)


def parse(page: str) -> tuple[list[Node], list[tuple[int, str]]]:
    """Block elements in page order, and the texts (node, text) in page order.

    Tags may be missing or misplaced: a paragraph ends where a block begins, a list item where the
    next one begins, an end tag without its start is ignored, and the end of the page ends all.
    """
    nodes = [Node("html", -1, 0)]
    texts: list[tuple[int, str]] = []
    stack = [0]
    buffer: list[str] = []
    in_link = 0
    link_chars = 0
    at, n = 0, len(page)

    def flush() -> None:
        nonlocal link_chars
        if buffer:
            text = " ".join(html.unescape("".join(buffer)).split())
            buffer.clear()
            if text:
                node = nodes[stack[-1]]
                node.own += len(text)
                node.links += min(link_chars, len(text))
                node.marks += sum(map(text.count, ".,;:!?"))
                node.words += text.count(" ") + 1
                texts.append((stack[-1], text))
        link_chars = 0

    def add(piece: str) -> None:
        nonlocal link_chars
        buffer.append(piece)
        if in_link:
            link_chars += len(piece.strip())

    def close(tag: str, stop: frozenset = frozenset()) -> None:
        for k in range(len(stack) - 1, 0, -1):
            name = nodes[stack[k]].tag
            if name == tag:
                flush()
                del stack[k:]
                return
            if name in stop:
                return

    for m in _TOKEN.finditer(page):
        if m.start() < at:
            continue
        if m.start() > at:
            add(page[at : m.start()])
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if m[1]:
            if tag == "a":
                in_link = 0
            elif tag not in INLINE:
                close(tag)
            continue
        if tag in RAW:
            end = re.compile(rf"</{tag}\b[^>]*>?", re.IGNORECASE).search(page, at)
            at = end.end() if end else n
            continue
        if tag in INLINE:
            nodes[stack[-1]].inline += 1
            if tag == "a":
                in_link = 1
            elif tag == "br":
                buffer.append(" ")
            continue
        flush()
        if tag in VOID:
            continue
        in_link = 0
        if nodes[stack[-1]].tag == "p":
            stack.pop()
        if tag in _HOLDERS:
            close(tag, _HOLDERS[tag])
        if tag in ("html", "body", "head") and tag == "html":
            continue
        node = Node(tag, stack[-1], len(stack))
        for a in _ATTRIBUTE.finditer(m[3]):
            name = a[1].lower()
            value = next((v for v in a.groups()[1:] if v is not None), "")
            if name in ("class", "id", "role"):
                found = set(_NAMES.findall(re.sub(r"(?<=[a-z])(?=[A-Z])", " ", value).lower()))
                node.positive += len(found & POSITIVE)
                node.negative += len(found & NEGATIVE)
            elif name == "data-training-label" and value.isdigit():
                node.given = int(value)
        if not m[3].endswith("/"):
            brothers = nodes[stack[-1]].children
            node.place = len(brothers)
            brothers.append(len(nodes))
            stack.append(len(nodes))
            nodes.append(node)
    if at < n:
        add(page[at:])
    flush()
    return nodes, [t for t in texts if not _hidden(nodes, t[0])]


def _hidden(nodes: list[Node], i: int) -> bool:
    while i > 0:
        if nodes[i].tag in HIDDEN:
            return True
        i = nodes[i].parent
    return False


N_FEATURES = 30


def features(nodes: list[Node]) -> np.ndarray:
    """One row per node: itself, its subtree, its place among its siblings, and its ancestors."""
    n = len(nodes)
    own = np.array([x.own for x in nodes], float)
    sub = np.array([[x.own, x.links, x.marks, x.words, x.inline + 1, x.own > 0] for x in nodes], float)
    height = np.zeros(n)
    for i in range(n - 1, 0, -1):
        p = nodes[i].parent
        sub[p] += sub[i]
        height[p] = max(height[p], height[i] + 1)
    out = np.zeros((n, N_FEATURES))
    page = max(sub[0, 0], 1.0)
    before = 0.0
    above = np.zeros((n, 10))  # hints and sections of the ancestors
    for i, x in enumerate(nodes):
        p = x.parent
        if p >= 0:
            above[i] = above[p]
        text, links, marks, words, tags, with_text = sub[i]
        brothers = nodes[p].children if p >= 0 else [0]
        place = x.place
        prior = sub[brothers[place - 1], 0] if place > 0 else 0.0
        following = sub[brothers[place + 1], 0] if place + 1 < len(brothers) else 0.0
        out[i, :20] = (
            x.depth, height[i], len(x.children), x.own, text, links / max(text, 1), marks / max(text, 1), text / max(words, 1),
            text / tags, with_text, words / max(with_text, 1), text / page, text / max(sub[p, 0] if p >= 0 else page, 1),
            place / max(len(brothers), 1), len(brothers), prior, following, before / page, x.positive, x.negative,
        )
        out[i, 20] = _BLOCKS.get(x.tag, 0)
        out[i, 21] = _SECTIONS.get(x.tag, 0)
        out[i, 22:30] = above[i, :8]
        above[i, 0] += x.positive
        above[i, 1] += x.negative
        kind = _SECTIONS.get(x.tag, 0)
        if kind:
            above[i, 1 + min(kind, 6)] += 1
        before += own[i]
    return out


def decode(nodes: list[Node], odds: np.ndarray) -> np.ndarray:
    """Which nodes to keep: the best set by log-odds in which no node is kept without its ancestors."""
    n = len(nodes)
    value = odds * (1.0 + np.log1p([x.own for x in nodes]))
    for i in range(n - 1, 0, -1):
        if value[i] > 0:
            value[nodes[i].parent] += value[i]
    keep = value > 0
    keep[0] = True
    for i in range(1, n):
        keep[i] &= keep[nodes[i].parent]
    return keep
