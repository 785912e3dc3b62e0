import random
import re

import pytest

from tallyhouse.llm import htmltext
from tallyhouse.llm.boosting import fit
from tallyhouse.llm.dom import features, parse


@pytest.fixture(scope="module")
def trees():
    return htmltext.train([])


def texts(page):
    nodes, found = parse(page)
    return [(nodes[i].tag, t) for i, t in found]


def test_blocks_of_broken_markup():
    assert texts("<p><b>One.<br><p>two &amp; 3&nbsp;x</p>tail") == [("p", "One."), ("p", "two & 3 x"), ("html", "tail")]
    assert texts("<ul><li>a<li>b <ul><li>c</ul></ul>d") == [("li", "a"), ("li", "b"), ("li", "c"), ("html", "d")]
    assert texts("<script>var t='</p>';</script><style>p{}</style><!-- x <p>y</p> --><p>z") == [("p", "z")]
    assert texts("<title>t</title></div><p>a</b></p><!-- open") == [("p", "a")]
    assert texts("<p title='a > b'>x 1 < 2 and a<b>c</b>") == [("p", "x 1 < 2 and ac")]
    assert texts("") == [] and texts("   ") == [] and texts("just text") == [("html", "just text")]


def test_long_and_deep_pages(trees):
    assert htmltext.main_texts(["<div>" * 3000 + "x" + "<p>" * 3000], trees) is not None
    assert len(parse("<" * 200_000)[0]) == 1
    parse("<a b='" * 20_000)


def test_trees_learn_a_rule():
    import numpy as np

    rng = np.random.default_rng(0)
    x = rng.random((2000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.3)).astype(float)
    assert (((fit(x, y).log_odds(x) > 0) == y).mean()) > 0.97


def test_held_out_disguised_pages(trees):
    rng = random.Random(11)
    good, total = 0, 150
    for _ in range(total):
        page = htmltext.disguised(htmltext.labelled(htmltext.generated(rng)), rng)
        nodes, found = parse(page)
        zone = []
        for x in nodes:
            zone.append(x.given if x.given >= 0 else (zone[x.parent] if x.parent >= 0 else -1))
        want = "\n".join(t for i, t in found if zone[i] == 1)
        bare = re.sub(r'data-training-label="\d"', "", page)
        good += htmltext.main_texts([bare], trees) == [want]
    assert good >= 0.95 * total


def test_sample_pages_give_their_articles(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    html = {r.page_id: r.html for r in pages.collect()}
    for row in htmltext.extract(pages).collect():
        article = re.search(r"<article>(.*?)</article>", html[row.page_id], re.DOTALL)[0]
        assert row.text == "\n".join(t for _, t in texts(article))
        assert row.n_chars == len(row.text)


@pytest.mark.parametrize("n", [0, 2])
def test_nulls_repeated_rows_and_empty_tables(spark, n):
    rows = [(None, None, None, "x"), (1, "u", "", "x")] * n
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    assert [(r.text, r.n_chars) for r in htmltext.extract(pages).collect()] == [("", 0)] * 2 * n


@pytest.mark.parametrize("n", [199, 200, 300])
def test_places_among_many_brothers(n):
    nodes, _ = parse("<ul>" + "".join(f"<li><p>{'x' * (k + 1)}</p></li>" for k in range(n)) + "</ul>")
    found = [row for x, row in zip(nodes, features(nodes), strict=True) if x.tag == "li"]
    assert [round(row[13] * n) for row in found] == list(range(n))
    assert [row[15] for row in found] == list(range(n))
    assert [row[16] for row in found] == [*range(2, n + 1), 0]
