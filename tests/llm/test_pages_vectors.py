"""Page extraction and nearest neighbours."""

import re
from html import unescape

import numpy as np
import pytest

from strataframe.llm import html_text, neighbours

PAGE = """<!doctype html><html><head><title>Title</title><style>p{}</style></head><body class="with-sidebar"><header><h1>Site</h1></header>
<nav><ul><li><a href="/">Home</a></ul></nav><div class="cookie-notice">We use cookies, yes, really.</div>
<div id="wrapper"><div class="content"><h2>A &amp; B</h2><p>First, with &eacute;, commas,
and more   text that is long enough to be a paragraph.<br>Next line</p><p>Short.<p>Unclosed <b>bold
<ul><li>one<li>two</ul><form><p>Sign up, now, please</p></form><script>var x="</p>";</script><!-- no --></div>
<aside><p>Side, text, with, many, commas, that, is, long, long, long</p></aside><div class="ad">Buy</div></div>
<section id="comments"><article class="comment"><p>Great, post, thanks, a lot, for writing it, even longer than the article, yes, yes, yes, yes, yes, yes.</p></article></section>
<footer>&copy; foot</footer></body></html>"""


def test_page():
    want = "A & B\nFirst, with é, commas, and more text that is long enough to be a paragraph. Next line\nShort.\nUnclosed bold\none\ntwo"
    assert html_text.extract(PAGE) == want


@pytest.mark.parametrize(
    "html, text",
    [
        ("", ""), ("plain a < b", "plain a < b"), ("<p>only", "only"), ("<article><p>a</p><p>b</p></article>", "a\nb"),
        ("<body><p>x &#233; &lt;b&gt;</p></body>", "x é <b>"), ("<div class='a>unclosed <p>x</p>", None), ("<script>never ends", ""),
        ("<main><section><p>One, two.</p></section><section><p>Three</p></section></main>", "One, two.\nThree"),
    ],
)
def test_page_edges(html, text):
    got = html_text.extract(html)
    assert text is None or got == text


def test_deep_and_long_pages():
    assert html_text.extract("<div>" * 20_000 + "deep" + "</div>" * 20_000) == "deep"
    assert html_text.extract("<article>" + "<p>x y</p>" * 20_000 + "</article>").count("\n") == 19_999


def test_pages_against_their_articles(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    got = {r.page_id: r for r in html_text.extract_pages(pages, "page_id", "url").collect()}
    for row in pages.collect():
        inside = re.search(r"<article>(.*)</article>", row.html, re.S)[1]
        blocks = re.split(r"</?(?:p|h1)>", inside.replace("<br>", " "))
        want = "\n".join(x for x in (" ".join(unescape(re.sub("<[^>]+>", "", b)).split()) for b in blocks) if x)
        assert got[row.page_id].text == want and got[row.page_id].n_chars == len(want)


def test_null_pages(spark):
    frame = spark.createDataFrame([(1, "u", None, "x"), (None, None, "<p>a</p>", "y")], "page_id long, url string, html string, text string")
    assert [(r.page_id, r.text, r.n_chars) for r in html_text.extract_pages(frame, "page_id", "url").collect()] == [(1, "", 0), (None, "a", 1)]
    assert html_text.extract_pages(frame.limit(0), "page_id", "url").count() == 0


def exact(rows, queries, k=5):
    out = {}
    for q, v in queries:
        s = sorted(((-float(np.dot(v, x) / np.linalg.norm(v) / np.linalg.norm(x)), i) for i, x in rows if i != q))
        out[q] = [i for _, i in s[:k]]
    return out


def test_neighbours_recall(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "ROWS_PER_PART", 60)
    monkeypatch.setattr(neighbours, "CHUNK_ROWS", 50)
    rows = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    got = neighbours.nearest(rows, rows.filter("vec_id % 50 = 0")).collect()
    data = [(r.vec_id, np.array(r.embedding, float)) for r in rows.collect()]
    want = exact(data, [d for d in data if d[0] % 50 == 0])
    hits = sum(r.vec_id in want[r.query_id] for r in got)
    assert len(got) == 5 * len(want) and hits >= 0.9 * len(got)
    by_id = dict(data)
    for r in got:
        a, b = by_id[r.query_id], by_id[r.vec_id]
        assert r.score == pytest.approx(float(a @ b / np.linalg.norm(a) / np.linalg.norm(b)), abs=1e-12)


def test_neighbours_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (50, [1.0, 0.0]), (50, [1.0, 0.0]), (3, [1.0, 0.0]), (2, [2.0, 0.0]), (4, [0.0, 1.0]), (5, None), (6, [0.0, 0.0]), (7, [nan, 1.0]), (8, [inf, 1.0]), (9, [None, 1.0]), (None, [1.0, 1.0]), (10, []), (11, [1.0, 1.0, 1.0])]
    frame = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<float>, rank string")
    got = neighbours.nearest(frame, frame.filter("vec_id % 50 = 0")).orderBy("query_id", "rank").collect()
    assert [(r.query_id, r.rank, r.vec_id) for r in got] == [(0, 1, 2), (0, 2, 3), (0, 3, 50), (0, 4, 4), (50, 1, 0), (50, 2, 2), (50, 3, 3), (50, 4, 4)]
    assert neighbours.nearest(frame.limit(0), frame.limit(0)).count() == 0


def test_names_inside_the_article():
    page = """<body><nav>n</nav><article><header class="entry-header"><h1><a href="t">Title</a></h1></header><p>One, two, three, four and some words more.</p>
<section id="related-work"><h2>Related work</h2><p><a href="o">Others did this, too.</a></p></section><h2 id="search-algorithms">Search</h2><p>We search, then find.</p>
<h2 id="copyright-law">Law</h2><div id="notice-periods"><p>Periods are long.</p></div><div class="related"><p>You may like</p></div>
<div class="share-box"><a href="x">Share</a> <a href="y">Send</a></div></article></body>"""
    want = ["Title", "One, two, three, four and some words more.", "Related work", "Others did this, too.", "Search", "We search, then find.", "Law", "Periods are long."]
    assert html_text.extract(page).split("\n") == want


WHOLE_PAGES = {
    "a form around the page": ("<body><form id='f'><h1>Title here</h1><div><p>First paragraph, that goes on, and on.</p><p>Second one, of the same kind.</p></div></form></body>",
        "Title here\nFirst paragraph, that goes on, and on.\nSecond one, of the same kind."),
    "a quotation with a name": ("<body><article><h1>T</h1><p>Text of the article, long enough.</p><blockquote class='social'>A quotation that belongs here.</blockquote><p>More text, and more.</p></article></body>",
        "T\nText of the article, long enough.\nA quotation that belongs here.\nMore text, and more."),
    "title and parts side by side": ("<body><div id='t'><h1>The title</h1></div><div>First part of the body, which has a sentence.</div><div>Second part of the body, which goes on, with more, and more.</div></body>",
        "The title\nFirst part of the body, which has a sentence.\nSecond part of the body, which goes on, with more, and more."),
    "a form beside the text": ("<body><div class='x'><p>Article text, that is long, and good. It has sentences, too.</p></div><form><p>Subscribe to our newsletter. Enter your mail address here, please, it is free.</p></form></body>",
        "Article text, that is long, and good. It has sentences, too."),
}


@pytest.mark.parametrize("name", WHOLE_PAGES)
def test_nothing_of_the_article_is_lost(name):
    html, text = WHOLE_PAGES[name]
    assert html_text.extract(html) == text


@pytest.mark.parametrize("open_", ["<div class='related{}'>some text, of a level that is long enough ", "<article>text, of an article that is long enough {}", "<td><div class='share'>cell, of a table that is long enough {}"])
def test_deep_pages_take_time_that_grows_with_them(open_):
    import time

    start = time.perf_counter()
    html_text.extract("<body>" + "".join(open_.format(i % 3) for i in range(20_000)))
    assert time.perf_counter() - start < 6
