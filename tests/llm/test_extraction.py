"""Pages with known articles, and odd markup."""

import re
from html import unescape

import pytest
from conftest import SF
from hypothesis import given, settings, strategies as st

from reelspark.llm import extraction as e
from reelspark.llm.common import table

ARTICLE = ["A heading", "First paragraph & more of it, long enough to be the article's own text in any case.", "Short.",
           "Another paragraph of the article that goes on for a while and ends here."]


def page(before="", after="", inside=""):
    body = "".join(f"<p>{p.replace('&', '&amp;')}</p>{inside}" for p in ARTICLE[1:])
    return (f"<!DOCTYPE html><html><head><title>T</title><style>p {{}}</style></head><body>{before}<div class='content'>"
            f"<h1>{ARTICLE[0]}</h1>{body}</div>{after}</body></html>")


MENU = "<nav><ul><li><a href='/a'>Home</a><li><a href='/b'>About us and our many long-named products</a></ul></nav>"


@pytest.mark.parametrize("before, after, inside", [
    ("", "", ""), (MENU, "<footer>Copyright text that is quite long, long enough to look like prose in a page.</footer>", ""),
    ("<div class=\"ad top\">Buy this thing now, it is the best thing that money can buy you today.</div>", "", "\n"),
    ("", "<div id='comments'><p>I liked this article a lot and want to say so at some length here.</p></div>", ""),
    ("<form><label>Search</label><input></form>", "<aside><p>Related reading of several words and more.</p></aside>", ""),
    ("<script>var x = '</p><p>not text at all, though it is long enough for a line of it';</script>", "", ""),
    ("<!-- a comment with <p>markup that is long enough to be mistaken for a paragraph</p> -->", "", ""),
    ("<ul><li><a href=1>One link</a></li><li><a href=2>Two links</a></li><li><a href=3>Three</a></li></ul><div></div>", "", ""),
    ("", "", "<div class='ad'>An advert in the midst of the article</div>"),
])
def test_article_without_what_stands_beside(before, after, inside):
    got = e.main_text(page(before, after, inside)).split("\n\n")
    assert [x for x in got if "link" not in x and x != "Three"] == ARTICLE


LONG = "A paragraph of the article that is long enough to be told from the lines around it, whatever they are."
CLOSE = "Short closing words."
BODY = f"<h1>Head</h1><p>{LONG}</p><p>{CLOSE}</p>"
ADVERT = "<div class=ad><p>Buy now, it is cheap and you need it, as everybody does.</p><p>Buy two.</p></div>"


@pytest.mark.parametrize("html", [
    f"<article><h1>Head</h1><p>{LONG}</p>{ADVERT}<p>{CLOSE}</p></article>",
    f"<main><h1>Head</h1><p>{LONG}</p>{ADVERT}{ADVERT}{ADVERT}<p>{CLOSE}</p></main>",
    f"<body><div><h1>Head</h1><p>{LONG}</p>{ADVERT}<p>{CLOSE}</p></div></body>",
    f"<body><h1>Head</h1><p>{LONG}</p>{ADVERT}<p>{CLOSE}</p><footer>{LONG}</footer></body>",
    f"<div class='content-sidebar-wrap'><article>{BODY}</article><div class=sidebar><p>{LONG}</p></div></div>",
    f"<main><div class='content-sidebar-wrap'><article>{BODY}</article></div></main>",
    f"<div id='main' class='has-sidebar'>{BODY}</div>",
    f"<div class='post tags'><article>{BODY}</article></div>",
    f"<article><div class='post tags'>{BODY}</div></article>",
    f"<article><header class='article-header'><h1>Head</h1></header><p>{LONG}</p><p>{CLOSE}</p></article>",
    f"<section class='article-header'><h1>Head</h1></section><p>{LONG}</p><p>{CLOSE}</p>",
    f"<header><h1>Head</h1></header><article><p>{LONG}</p><p>{CLOSE}</p></article>",
    f"<header><h1>Site</h1><p>{LONG}</p></header><article>{BODY}</article>",
    f"<header><p>{LONG}</p></header><div>{BODY}</div>",
    f"<form action=x><article>{BODY}</article><input></form>",
    f"<article>{BODY}</article><div id=comments><article><p>{LONG}</p><p>{LONG}</p></article></div>",
    f"<div class=cookie-notice><p>{LONG}</p><p>{LONG}</p><p>{LONG}</p></div><div>{BODY}</div>",
])
def test_article_stays_whole(html):
    assert e.main_text(html).split("\n\n") == ["Head", LONG, CLOSE]


def test_captions_and_lists_of_links_stay():
    links = "".join(f"<li><a href={k}>Source {k}</a></li>" for k in range(5))
    html = f"<article><p>{LONG}</p><figure><img><figcaption>A caption</figcaption></figure><ul>{links}</ul><p>{CLOSE}</p></article>"
    assert e.main_text(html).split("\n\n") == [LONG, "A caption", *(f"Source {k}" for k in range(5)), CLOSE]


@given(st.lists(st.sampled_from([0, 0, 1, 30, 60, 90, 200]), max_size=20), st.integers(1, 4))
@settings(max_examples=300, deadline=None)
def test_runs_by_their_definition(lengths, window):
    """A line is kept if text stands in every window from a surge down to it, or if it rises without a gap to a surge."""
    sums = [sum(lengths[i:i + window]) for i in range(len(lengths))]
    wanted = min(80, max(sums, default=0) / 2)
    surges = [i for i, s in enumerate(sums) if s and s >= wanted]
    kept = {k for i in surges for k in range(i, len(lengths)) if all(sums[i:k + 1])}
    kept |= {k for i in surges for k in range(i) if all(lengths[k:i])}
    got = {k for a, b in e.text_runs(lengths, window) for k in range(a, b)}
    assert {k for k in got if lengths[k]} == {k for k in kept if lengths[k]}


@pytest.mark.parametrize("html, text", [
    (None, ""), ("", ""), ("plain", "plain"), ("<p>a &lt;b&gt; &#233;&nbsp; c\n\td</p>", "a <b> é c d"), ("<p>a<br>b", "a b"),
    ("<p>one<p>two", "one\n\ntwo"), ("a < b", "a < b"), ("<p title='a>b'>x</p>", "x"), ("<p>x<!-- open", "x"),
    ("<script>never closed", ""), ("<nav>never closed <p>text", "never closed\n\ntext"), ("<nav>only</nav>", ""),
])
def test_odd_markup(html, text):
    assert e.main_text(html) == text


@pytest.mark.parametrize("part", ["<", "<!--", "<p ", "<div class='", "<nav>", "<p class=ad>", "&amp", "<script>", "</p>"])
def test_long_pages_end(part):
    e.main_text(part * 20_000)


@pytest.mark.parametrize("name", ["div", "section", "p", "header"])
def test_nested_boxes_end(name):
    e.main_text(f"<{name} class=sidebar>" * 20_000 + LONG + f"</{name}>" * 20_000)


def test_runs():
    assert e.text_runs([0, 5, 90, 40, 0, 0, 0, 3, 0]) == [(1, 4)]
    assert e.text_runs([10, 0, 0, 0, 10]) == [(0, 1), (4, 5)] and e.text_runs([]) == [] and e.text_runs([0, 0]) == []


def test_given_pages(spark):
    """In the given pages the article is an element of its own, whose blocks are headings and paragraphs."""
    rows = e.op4(spark, SF).collect()
    html = {r.page_id: r.html for r in table(spark, SF, "pages").collect()}
    assert len(rows) == len(html)
    for r in rows:
        article = re.search(r"<article>(.*?)</article>", html[r.page_id], re.S)[1]
        blocks = (" ".join(unescape(re.sub(r"<[^>]*>", " ", b)).split()) for b in re.split(r"</?(?:p|h1)[^>]*>", article))
        assert r.text == "\n\n".join(b for b in blocks if b) and r.n_chars == len(r.text)


def test_odd_rows(spark):
    rows = [(1, "u", None), (2, None, ""), (2, None, ""), (None, "u", "<p>x")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    assert sorted(r.text for r in e.extracted(pages).collect()) == ["", "", "", "x"]
    assert e.extracted(pages.limit(0)).collect() == []
