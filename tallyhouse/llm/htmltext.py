"""Main text of web pages: gradient-boosted trees over DOM nodes, decoded along the tree.

Training pages are a bounded sample of the table and generated ones. Labels come from the markup
where it is plain (article, nav, footer, ...); the same pages are used again with that markup
replaced by bare blocks, with and without telling class names, and with notices, forms, sidebars
and comments put in, so that the trees learn from density, place and attribute words as well. A node counts as
content when any content lies below it, and the decoder only keeps nodes whose ancestors are kept.
"""

from __future__ import annotations

import pickle
import random
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.boosting import Trees, fit
from tallyhouse.llm.dom import decode, features, parse

SAMPLE_PAGES = 300
GENERATED_PAGES = 120
_AT_ONCE = 100  # pages whose nodes are scored together
_LABEL = "data-training-label"
_AGAINST = ("nav", "header", "footer", "aside", "form")
_AD = re.compile(r"(<(?:div|section|ul|p)\b)(?=[^>]*class=\"[^\"]*\b(?:ads?|advert|banner|cookie|sidebar|comments?|related|share|menu|promo)\b)")
_PUT_IN = [
    '<aside class="sidebar" {0}><h3>{1}</h3><ul><li><a href="/x">{2}</a></li><li><a href="/y">{3}</a></li></ul></aside>',
    '<div class="cookie-notice" {0}><p>{1} <a href="/ok">{2}</a></p></div>',
    '<div id="comments" {0}><h3>{1}</h3><div class="comment"><p>{2}</p></div><div class="comment"><p>{3}</p></div></div>',
    '<section class="comments" {0}><ol><li><p>{2}</p></li><li><p>{3}</p></li></ol></section>',
    '<form action="/s" {0}><p>{1}</p><input name="q"><button>{2}</button></form>',
    '<div class="ad" {0}>{1}</div>',
    '<div class="related" {0}><h4>{1}</h4><ul><li><a href="/a">{2}</a></li><li><a href="/b">{3}</a></li></ul></div>',
    '<header {0}><p><a href="/">{1}</a></p></header>',
    '<div {0}><a href="/a">{1}</a> <a href="/b">{2}</a> <a href="/c">{3}</a></div>',
]
_PLAIN = [("div", ""), ("div", 'class="content"'), ("div", 'id="main"'), ("div", 'class="post-body"'), ("section", ""), ("main", ""), ("article", "")]
_BARE = {
    "nav": [("div", 'class="menu"'), ("div", ""), ("ul", 'class="navbar"')],
    "footer": [("div", 'class="footer"'), ("div", 'id="footer"'), ("div", "")],
    "aside": [("div", 'class="sidebar"')],
    "header": [("div", 'class="header"')],
    "form": [("form", "")],
}


def labelled(page: str) -> str:
    """The page with training labels on the elements that its markup gives away."""
    page = page.replace(_LABEL, "")
    page = re.sub(r"<(article|main)\b", rf'<\1 {_LABEL}="1"', page)
    for tag in _AGAINST:
        page = re.sub(rf"<{tag}\b", f'<{tag} {_LABEL}="0"', page)
    return _AD.sub(rf'\1 {_LABEL}="0"', page)


def disguised(page: str, rng: random.Random) -> str:
    """A labelled page with other elements in place of the telling ones, and more blocks put in."""
    words = re.sub(r"<[^>]*>", " ", page).split() or ["text"]

    def some(n: int) -> str:
        i = rng.randrange(len(words))
        return " ".join(words[i : i + rng.randint(1, n)])

    extra = [
        block.format(f'{_LABEL}="0"', some(4), some(12), some(25)) for block in rng.sample(_PUT_IN, rng.randint(1, 4))
    ]
    body_end, article_end = page.rfind("</body>"), page.rfind("</article>")
    for block in extra:
        inside = "comment" in block or "related" in block or 'class="ad"' in block
        if inside and article_end >= 0 and rng.random() < 0.6:
            page = page[:article_end] + block + page[article_end:]
        elif rng.random() < 0.5 and "<article" in page:
            at = page.index("<article")
            page = page[:at] + block + page[at:]
        elif body_end >= 0:
            at = page.rfind("</body>")
            page = page[:at] + block + page[at:]
        article_end = page.rfind("</article>")
    tag, attributes = rng.choice(_PLAIN)
    page = re.sub(r"<article\b", f"<{tag} {attributes} ", page).replace("</article>", f"</{tag}>")
    for old, choices in _BARE.items():
        if rng.random() < 0.7:
            tag, attributes = rng.choice(choices)
            page = re.sub(rf"<{old}\b", f"<{tag} {attributes} ", page).replace(f"</{old}>", f"</{tag}>")
    return page


def generated(rng: random.Random) -> str:
    """A page of invented words with an article and the usual surroundings."""

    def word() -> str:
        return "".join(rng.choice("bcdfglmnprstv") + rng.choice("aeiou") for _ in range(rng.randint(1, 4)))

    def words(n: int) -> str:
        return " ".join(word() for _ in range(n))

    def prose() -> str:
        return " ".join(words(rng.randint(4, 18)).capitalize() + rng.choice(["", ", " + words(4)]) + "." for _ in range(rng.randint(1, 6)))

    links = "".join(f'<li><a href="/{word()}">{words(rng.randint(1, 2))}</a></li>' for _ in range(rng.randint(3, 9)))
    parts = [f"<p>{prose()}</p>" if rng.random() < 0.8 else f"<h2>{words(4)}</h2><p>{prose()}</p>" for _ in range(rng.randint(1, 12))]
    if rng.random() < 0.3:
        parts.insert(rng.randrange(len(parts) + 1), "<ul>" + "".join(f"<li>{prose()}</li>" for _ in range(3)) + "</ul>")
    if rng.random() < 0.2:
        parts.append(f"<blockquote><p>{prose()}</p></blockquote>")
    return (
        f"<html><body><nav><ul>{links}</ul></nav><article><h1>{words(rng.randint(2, 9))}</h1>{''.join(parts)}</article>"
        f"<footer>&copy; {words(rng.randint(2, 8))}. {prose() if rng.random() < 0.5 else ''}</footer></body></html>"
    )


def training_rows(page: str) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of the nodes of a labelled page that hold text."""
    nodes, texts = parse(page)
    zone = np.full(len(nodes), -1)
    for i, x in enumerate(nodes):
        zone[i] = x.given if x.given >= 0 else (zone[x.parent] if x.parent >= 0 else -1)
    content, text = np.zeros(len(nodes), bool), np.zeros(len(nodes), bool)
    for i, _ in texts:
        text[i], content[i] = True, content[i] or zone[i] == 1
    for i in range(len(nodes) - 1, 0, -1):
        content[nodes[i].parent] |= content[i]
        text[nodes[i].parent] |= text[i]
    known = text & (content | (zone >= 0)) if (zone >= 0).any() else np.zeros(len(nodes), bool)
    return features(nodes)[known], content[known].astype(float)


def train(pages: list[str], seed: int = 0) -> Trees:
    rng = random.Random(seed)
    rows = []
    for page in [*pages, *(generated(rng) for _ in range(GENERATED_PAGES))]:
        page = labelled(page)
        rows += [training_rows(page), training_rows(disguised(page, rng)), training_rows(disguised(page, rng))]
    return fit(np.concatenate([x for x, _ in rows]), np.concatenate([y for _, y in rows]))


def train_on(pages: DataFrame, sample_pages: int = SAMPLE_PAGES) -> Trees:
    """Trees trained in one task on at most ``sample_pages`` pages; only the trees reach the driver."""
    few = pages.where("html is not null").select("html", F.xxhash64("html").alias("h")).orderBy("h", "html").limit(sample_pages)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sample = [x for batch in batches for x in batch.column(0).to_pylist()]
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(vars(train(sample)))], pa.binary())], names=["trees"])

    found = few.select("html").coalesce(1).mapInArrow(run, "trees binary").collect()
    return Trees(**pickle.loads(found[0][0])) if found else train([])


def main_texts(pages: list[str], trees: Trees) -> list[str]:
    """Of each page the texts of the nodes that the decoder keeps, one line each."""
    parsed = [parse(page) for page in pages]
    if not parsed:
        return []
    odds = trees.log_odds(np.concatenate([features(nodes) for nodes, _ in parsed]))
    out, at = [], 0
    for nodes, texts in parsed:
        keep = decode(nodes, odds[at : at + len(nodes)])
        at += len(nodes)
        out.append("\n".join(text for i, text in texts if keep[i]))
    return out


def extract(pages: DataFrame, sample_pages: int = SAMPLE_PAGES) -> DataFrame:
    """Per page: page_id, url, text, n_chars (code points).

    Null or empty html and pages without content give an empty text. Whole pages are read,
    however long. Repeated rows give repeated results.
    """
    source = pages.select("page_id", "url", "html")
    trees = train_on(source, sample_pages)
    kinds = dict(source.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, _AT_ONCE):
                part = batch.slice(i, _AT_ONCE)
                texts = main_texts([x or "" for x in part.column(2).to_pylist()], trees)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                    names=["page_id", "url", "text", "n_chars"],
                )

    return source.mapInArrow(run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long")
