"""Golden cases for the date ladder and page date evidence."""

import datetime as dt

from pyspark.sql import functions as F

from civicscan.functions import dates as D
from civicscan.operators import dates as X


def parse_all(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    return [r.d for r in df.select(D.parse_date("s").alias("d")).collect()]


def test_ladder(spark):
    got = parse_all(spark, [
        "2024-01-05T23:30:00-05:00", "20240105", "1/5/2024", "January 5, 2024",
        "Jan. 5th 2024", "Wed, 21 Oct 2015 07:28:00 GMT", "March 2024", "no date here",
        "2024-02-30", "Posted 12:00", None,
    ])
    assert got == [dt.date(2024, 1, 5), dt.date(2024, 1, 5), dt.date(2024, 1, 5), dt.date(2024, 1, 5),
                   dt.date(2024, 1, 5), dt.date(2015, 10, 21), dt.date(2024, 3, 1), None, None, None, None]


def test_jsonld_walk_order():
    obj = {"a": {"datePublished": "nested"}, "DatePublished": "own", "l": [{"updated": 3}],
           "dateModified": None}
    assert X.first_dates(obj) == ("own", "3")
    read = X.read_items(['[{"@type":"X"}, {"uploadDate": "2020-01-02"}]', "{broken", "  ", "[" * 100_000, None])
    assert [(i["published"], i["updated"]) for i in read] == [(None, None), ("2020-01-02", None)]


def test_shapes_that_stand_in_pages(spark):
    day = dt.date(2024, 1, 5)
    cases = {"01/05/24": day, "25/12/2023": dt.date(2023, 12, 25), "5-Jan-2024": day, "Jan-05-2024": day, "Fri Jan  5 12:30:00 2024": day,
             "Jan 5 '24": day, "202401051230": day, "Sunday, 06-Nov-94 08:49:37 GMT": dt.date(1994, 11, 6), "5th of January 2024": day,
             "January 5, 2024 3:00 PM (see 2023-12-01)": day, "see 2023-12-01 or January 5, 2024": dt.date(2023, 12, 1),
             "5 Jan 12:30": None, "version 1.2.3": None, "99/99/2024": None}
    assert parse_all(spark, list(cases)) == list(cases.values())


def test_token_orders_agree_with_an_independent_parser(spark):
    from dateutil import parser
    texts = ["Jan 5, 24", "2024 January 5", "2024-Jan-05", "05JAN2024", "Jan5,2024", "2024/01", "01/2024", "1/2024", "2024 Jan 5 10:00", "5/Jan/2024",
             "Jan/5/2024", "2024 5 January", "05.01.24", "Jun-2024", "Fri Jan  5 12:30:00 EST 2024", "2024 01 05", "Jan 5 2024 10 AM", "99-01-05",
             "Apr-2003-25", "21st March, 2019", "MARCH 3RD 2020 at 5:00 pm"]
    want = [parser.parse(t, default=dt.datetime(1970, 1, 1), fuzzy=True, ignoretz=True).date() for t in texts]
    got = parse_all(spark, texts)
    assert [(t, g, w) for t, g, w in zip(texts, got, want) if g != w] == []
    none = ["version 1.2.3", "Jan 5, 10 AM", "555-12-2024", "192.168.10.24", "2024-01-XX", "20241399", "2024", "5 Jan 12:30", "13-13-13", "", " , "]
    assert parse_all(spark, none) == [None] * len(none)
    assert parse_all(spark, ["page 3 - 2024-05-06", "12 5 January 2024", "March 2024 12 comments"]) == [
        dt.date(2024, 5, 6), dt.date(2024, 1, 5), dt.date(2024, 3, 1)]


def test_the_date_grammar_is_a_small_plan():
    assert len(D.parse_date_text("x")) < 10_000


FORMATS = ["%Y-%m-%d", "%Y/%m/%d", "%Y.%m.%d", "%Y-%m-%dT%H:%M:%S", "%Y%m%d", "%Y%m%d%H%M", "%Y%m%d%H%M%S", "%m/%d/%Y", "%m-%d-%Y",
           "%m/%d/%y", "%B %d, %Y", "%b %d, %Y", "%b. %d %Y", "%b-%d-%Y", "%d %B %Y", "%d-%b-%Y", "%d-%b-%y", "%a, %d %b %Y %H:%M:%S GMT",
           "%a %b %d %H:%M:%S %Y", "%A, %d-%b-%y %H:%M:%S GMT", "%d of %B %Y", "%b %d '%y", "Updated: %B %d, %Y at %H:%M"]


def test_shapes_agree_with_an_independent_parser(spark):
    import random

    from dateutil import parser
    rng = random.Random(7)
    texts = []
    for f in FORMATS:
        for _ in range(40):
            d = dt.datetime(rng.choice([1995, 2001, 2013, 2019, 2024]), rng.randint(1, 12), rng.randint(1, 28), rng.randint(0, 23), rng.randint(0, 59), 7)
            texts.append(d.strftime(f))
    want = [parser.parse(t, default=dt.datetime(1970, 1, 1), fuzzy=True).date() for t in texts]
    got = parse_all(spark, texts)
    assert [(t, g, w) for t, g, w in zip(texts, got, want) if g != w] == []


PAGE = """<html><head>
<meta name="pubdate" content="">
<meta name="pubdate" content="2020-01-01">
<meta property="article:published_time" content=" 2021-03-04T10:00:00Z ">
<meta itemprop="dateModified" value="2021-05-06">
<script type="application/ld+json">{"@type":"NewsArticle","datePublished":"2021-03-04","dateModified":"2021-06-01"}</script>
</head><body><article>
<time datetime="2021-07-08">Last updated</time>
<time class="stamp updated">2021-01-02</time>
<time id="x" class="modified">2021-01-03</time>
<p>Posted: March 9, 2021</p>
</article></body></html>"""


def test_page_candidates_and_best(spark):
    pages = spark.createDataFrame([(1, "u", PAGE, "Tue, 01 Jun 2021 00:00:00 GMT", 200)],
                                  "page_id long, url string, html string, http_last_modified string, status_code int")
    rows = X.candidate_rows(X.candidates(pages)).collect()
    got = sorted((r.kind, r.weight, r.dt, r.source) for r in rows)
    # first pubdate meta is empty -> no candidate from that rule (first tag only)
    assert ("published", 70, dt.date(2020, 1, 1), "meta[name=pubdate]") not in got
    assert ("published", 90, dt.date(2021, 3, 4), "meta[property=article:published_time]") in got
    assert ("updated", 90, dt.date(2021, 5, 6), "meta[itemprop=dateModified]") in got
    assert ("updated", 68, dt.date(2021, 7, 8), "time element") in got          # text says updated
    assert ("published", 70, dt.date(2021, 1, 2), "time element") in got        # class ignored without id
    assert ("updated", 68, dt.date(2021, 1, 3), "time element") in got          # class used with id
    assert ("published", 50, dt.date(2021, 3, 9)) in [g[:3] for g in got]
    assert ("updated", 40, dt.date(2021, 6, 1), "http.Last-Modified") in got
    best = X.page_dates(pages).collect()[0]
    assert best.published == dt.date(2021, 3, 4)     # JSON-LD weight 100
    assert best.updated == dt.date(2021, 6, 1)       # JSON-LD weight 95
    assert best.http_last_modified == dt.date(2021, 6, 1)


def test_best_ties(spark):
    c = spark.createDataFrame([([("published", 70, "a", dt.date(2022, 5, 1), "s", 2),
                                  ("published", 70, "b", dt.date(2021, 12, 1), "s", 1),
                                  ("updated", 60, "c", dt.date(2020, 1, 1), "s", 3),
                                  ("updated", 60, "d", dt.date(2021, 1, 1), "s", 4)],)],
                              "cands array<struct<kind:string,weight:int,raw:string,dt:date,source:string,ord:bigint>>")
    r = c.select(X.best(F.col("cands"), "published").alias("p"),
                 X.best(F.col("cands"), "published", tie="lexical").alias("pl"),
                 X.best(F.col("cands"), "updated").alias("u")).collect()[0]
    assert r.p == dt.date(2021, 12, 1)        # earliest
    assert r.pl == dt.date(2022, 5, 1)        # '05/01/2022' < '12/01/2021' as text
    assert r.u == dt.date(2021, 1, 1)         # latest


def test_non_200_pages_have_no_dates(spark):
    pages = spark.createDataFrame([(1, "u", PAGE, None, 404)],
                                  "page_id long, url string, html string, http_last_modified string, status_code int")
    assert X.page_dates(pages).count() == 0


def test_date_plan_is_narrow(spark):
    from civicscan.plans.catalog import QUERIES
    plan = QUERIES["page_dates"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and "Exchange rangepartitioning" not in plan


def test_ladder_more_shapes(spark):
    got = parse_all(spark, ["01-05-2024", "1.5.2024", "as of 2024-03", "2024-03-07", "Posted: March 9, 2021"])
    assert got == [dt.date(2024, 1, 5), dt.date(2024, 1, 5), dt.date(2024, 3, 1), dt.date(2024, 3, 7),
                   dt.date(2021, 3, 9)]


def test_label_after_no_break_space(spark):
    html = "<html><body><p>Posted:&nbsp;March 9, 2021</p></body></html>"
    pages = spark.createDataFrame([(1, "u", html, None, 200)],
                                  "page_id long, url string, html string, http_last_modified string, status_code int")
    rows = X.candidate_rows(X.candidates(pages, ("text",))).collect()
    assert [(r.kind, r.dt) for r in rows] == [("published", dt.date(2021, 3, 9))]
