"""The page walk against the slow model, on broken pages, and for its cost."""

import random
import re
import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import markup_model as M
from civicscan.functions import html as H
from civicscan.functions import markup
from civicscan.operators import articles as A
from civicscan.operators import dates as X

PARTS = ["<p>", "</p>", "<div>", "</div>", "<b>", "</b>", "<nav>", "</nav>", "<form", ">", "<", "</", "/>", "=", "'", '"', " ", "\n", "a", "it's", "x y", "&amp;",
         "&copy", "&nbsp", "&bogus;", "&#38;", "<!--", "-->", "<!", "<?", "<a href=", "<a href='u'>", "</a>", "<script>", "</script>", "</script ", "<style>",
         "</style>", "<template>", "</template>", "<time>", "</time>", "<time datetime=", "<meta name=", "<meta content='c'", "class=x", "title=\"", "<br/>", "<br>",
         "<article>", "</article>", "<h2>", "</h2>", "<li>", "<head>", "</head>", "<title>", "</title>", "<em>", "</em>", "=\"", "='", "<div/>", "<p/ >", "<x=y>",
         "<noscript>", "</noscript>", "long words of text "]
pages = st.lists(st.sampled_from(PARTS), max_size=30).map("".join)


def as_events(page):
    out = []
    for kind, what, a, b in markup.tokens(page):
        if kind == "text":
            out.append(("text", what))
        elif kind == "start":
            out.append(("start", what, markup.attributes(page, a, b)))
        elif kind == "end":
            out.append(("end", what))
    return out


def decoded(events):
    return [e if e[0] != "start" else (*e[:2], {k: markup.attribute_text(v) for k, v in e[2].items()}) for e in events]


@settings(max_examples=3000, deadline=None)
@given(pages)
def test_tokens_equal_the_state_machine(page):
    assert as_events(page) == decoded(M.events(page))


@settings(max_examples=3000, deadline=None)
@given(pages)
def test_texts_elements_and_containers_equal_the_tree(page):
    walk, root = markup.Page(page), M.tree(page)
    for view, (_, hidden) in markup.VIEWS.items():
        assert walk.text(view, "\n").split("\n") == "\n".join(M.texts(root, hidden)).split("\n")
    every = list(M.nodes(root))
    assert walk.metas == [{k: markup.attribute_text(v) for k, v in n.attrs.items()} for n in every if n.name == "meta"]
    assert [t[0] for t in walk.times] == [{k: markup.attribute_text(v) for k, v in n.attrs.items()} for n in every if n.name == "time"]
    hidden = markup.DENSE_HIDDEN

    def visible(n):
        while n is not None:
            if n.name in hidden:
                return False
            n = n.parent
        return True

    best = None
    for n in [n for n in every if n.name in markup.CONTAINERS and visible(n)]:
        text = "\n".join(M.texts(n, hidden))
        links = sum(k.name == "a" and visible(k) for k in M.nodes(n))
        if len(text) > 20 and (best is None or len(text) / (links + 1) > best[0]):
            best = len(text) / (links + 1), links, text
    got = markup.densest(walk, 20)
    assert (got and (got[3], got[2], got[4])) == best


def text_of(page, view="page", sep=" "):
    return markup.Page(page).text(view, sep)


def test_stray_quotes_and_broken_tags_lose_no_text():
    assert text_of("<p data-x=it's>Hello there</p><p>we don't stop</p><p>end</p>", sep="|") == "Hello there|we don't stop|end"
    assert text_of("<p class=x id=it's>A</p><p>B don't</p>", sep="|") == "A|B don't"
    assert text_of('<p title="a>A</p><p>b</p>', sep="|") == "A|b"  # a quote that is never closed
    assert text_of('<p title="a > b">q</p>r', sep="|") == "q|r"
    assert text_of("x &nbsp &copy 2024 &amp y &amp;lt; &bogus; &#146;") == "x \xa0 © 2024 & y &lt; &bogus; ’"
    assert text_of("<nav>menu<p>x</p><article>text</article>", "article") == ""  # the open <nav> holds them
    assert text_of("<div><nav>menu</div><p>text</p>", "article") == "text"  # and ends with its parent
    assert text_of("a < b <3 c") == "a < b <3 c"
    assert text_of("a<!-->b") == "a b" and text_of("a<!-- b") == "a"


def test_first_of_repeated_attributes_counts():
    assert markup.Page("<meta name=a NAME=b content='1' content=2>").metas == [{"name": "a", "content": "1"}]
    assert markup.Page("<meta content='?a=1&copy=2&amp=3&lt;&copy'>").metas == [{"content": "?a=1&copy=2&amp=3<©"}]


@pytest.mark.parametrize("part", ["<a ", '<a b="', "<!-- ", "</", "<nav>", "<time>", "<b>", "</b>", "<script>", "'", "<p title='", "<div><p>", "<b><div>", "<li>",
                                  "<a href=x>", "<div><b></div>", "<x y='z'>", "&", "<"])
def test_time_is_linear_in_the_page(part):
    def seconds(n):
        best = 9.0
        for _ in range(2):
            t = time.perf_counter()
            markup.Page(part * n, linked=True)
            best = min(best, time.perf_counter() - t)
        return best

    assert seconds(80_000) < 16 * seconds(20_000) + 0.05  # a square would be 16-fold or more beyond the constant


def test_a_tag_with_100000_attributes(spark):
    tag = "<p " + " ".join(f'a{i}="v{i}"' for i in range(100_000)) + ">"
    page = f"<html><body>{tag}text</p><time datetime='2024-02-03' {tag[3:]}x</time><meta name=pubdate content=2024-01-02 {tag[3:]}</body>"
    rows = [(1, "u", page, None, 200), (2, "u", "<script>" + "<a x='y' " * 100_000, None, 200)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, http_last_modified string, status_code int")
    assert {r.page_id: (str(r.published)) for r in X.page_dates(df).collect()} == {1: "2024-01-02", 2: "None"}
    assert {r.page_id: r.t.text_all for r in df.select("page_id", H.texts(F.col("html")).alias("t")).collect()} == {1: "text x", 2: ""}
    assert A.article_records(df).count() == 2


def test_one_walk_serves_all_signals_of_a_page(spark):
    from civicscan.plans.catalog import QUERIES
    from conftest import SF_SMALL
    for name in ("page_dates", "article_records", "visible_text"):
        plan = QUERIES[name](spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("ArrowEvalPython") == 1, name
    assert len(QUERIES["page_dates"](spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()) < 60_000


def test_linked_text_of_random_pages_has_every_word():
    rng = random.Random(3)
    for _ in range(300):
        page = "".join(rng.choice(["<p>", "</p>", "<a href=u>", "</a>", "<b>", "<h1>", "</h1>", "<li>", "<img src=x>"]) + f"w{i} " for i in range(12))
        got = "".join(markup.Page(page, linked=True).linked)
        assert re.findall(r"w\d+", got) == [f"w{i}" for i in range(12)]
