"""Logs of stored answers that hold far more than a sample asks for: only the
answers to its requests are parsed and grouped, each once."""

import pytest
from pyspark.sql import functions as F

from civicscan.operators import utilities
from civicscan.plans import notices

AFTER = " after:2025-01-01"
ASK = ' Responding in either "YES" or "NO" do you think this news article is about a boil water advisory'


@pytest.fixture
def stored(monkeypatch):
    """Rows of each table that the job stores."""
    counts: dict[str, list[int]] = {}
    keep = notices.materialize

    def spy(df, name):
        out = keep(df, name)
        counts.setdefault(name, []).append(out.count())
        return out

    monkeypatch.setattr(notices, "materialize", spy)
    return counts


def counties(spark):
    rows = [(1, "VA0000001", 10010, "County 10"), (2, "TX0000002", 10010, "County 10"), (3, "OH0000003", 10011, "County 11"),
            (4, "MA0000004", 10012, "County 12"), (None, "PR0000005", 10013, None)]
    return spark.createDataFrame(rows, "utility_id long, pwsid string, county_fips long, county_name string")


def log(spark, rows, key, value):
    """A log of ``rows`` and of other requests, whose answers fail when they are read."""
    rows = spark.createDataFrame(rows, f"{key} string, {value} string")
    others = spark.range(500).select(F.concat(F.lit("other "), "id").alias(key), F.lit("").alias(value))
    all_ = rows.unionByName(others)
    return all_.withColumn(value, F.when(F.col(key).startswith("other"), F.raise_error(F.lit("an answer that nobody asked for"))).otherwise(F.col(value)))


def local_rows():
    def items(link):
        return f'{{"items":[{{"title":"t","link":"{link}","snippet":"s"}}]}}'
    return ([("local news in County 10, VA", items("https://b.example"))] * 40 + [("local news in County 10, VA", items("https://a.example"))] * 40
            + [("local news in County 10, VA", "<html>"), ("local news in County 10, VA", None)]
            + [("local news in County 11, OH", "<b>"), ("local news in County 12, MA", items("https://c.example")), (None, items("https://n.example"))])


def test_site_chain_reads_asked_answers_only(spark, stored):
    got = notices.site_chain(spark, counties(spark), log(spark, local_rows(), "query", "body"))
    assert sorted(map(tuple, got.collect())) == [
        (10010, "County 10", "VA", "https://a.example", "Boil Water Notice site:https://a.example" + AFTER),
        (10012, "County 12", "MA", "https://c.example", "Boil Water Notice site:https://c.example" + AFTER)]
    assert stored == {"local-requests": [4], "asked-answers": [6]}  # 84 rows answer its requests


def test_answered_is_the_plain_join(spark):
    from civicscan.operators import responses as R
    requests = utilities.county_requests(spark.createDataFrame([("A", "VA"), ("A", "VA"), ("B", "TX"), (None, "OH")], "county string, state string"), "q {county}, {state}")
    answers = spark.createDataFrame([("q A, VA", '{"items":[2]}'), ("q A, VA", "<x>"), ("q A, VA", '{"items":[1]}'), ("q C, TX", "{}"), (None, "n")],
                                    "query string, body string")
    want = requests.join(R.one_answer(answers, "query", "body", R.FLAT_PATH), "query").select("query", "county", "state", "body")
    for path in (R.FLAT_PATH, None):
        got = notices.answered(requests, answers, "query", "body", path).select("query", "county", "state", "body").collect()
        assert [r.query for r in got] == ["q A, VA"] * 2
        if path:
            assert sorted(map(tuple, got)) == sorted(map(tuple, want.collect()))
    assert notices.answered(requests.limit(0), answers, "query", "body").count() == 0


def test_sampled_advisories_read_asked_answers_only(spark, stored):
    site = "Boil Water Notice site:https://%s.example" + AFTER
    found = '{"items":[{"link":"https://a.example/1","snippet":"please boil"},{"link":"https://a.example/2","snippet":"dry"}]}'
    also = '{"items":[{"link":"https://b.example/x","snippet":"boil"},{"link":"https://a.example/1","snippet":"please boil"},{"link":"u","snippet":"boil"}]}'
    site_rows = [(site % "a", found)] * 30 + [(site % "a", "<html>"), (site % "c", also), (site % "z", found), (None, found)]
    verdicts = [("please boil" + ASK, "YES")] * 20 + [("boil" + ASK, "YES"), ("boil" + ASK, "NO"), (None, "YES")]
    articles = [("https://a.example/1", '{"advisories":[{"type":"E","location":"R"}]}')] * 20 + [("https://b.example/x", "none"), (None, "{}")]
    html = '<script type="application/ld+json">{"@type":"Article","datePublished":"2024-03-04"}</script>'
    crawl = spark.createDataFrame([(2, "https://a.example/1", "<p>later</p>", None, 200), (1, "https://a.example/1", html, None, 200), (3, None, html, None, 200)],
                                  "page_id long, url string, html string, http_last_modified string, status_code int")
    got = notices.sampled_advisories(spark, counties(spark), log(spark, local_rows(), "query", "body"), log(spark, site_rows, "query", "body"),
                                     log(spark, verdicts, "prompt", "response"), crawl, log(spark, articles, "link", "response"))
    rows = [(r.county_fips, r["rank"], r.type, r.location, r.publish_date, r.county, r.state, r.link) for r in got.collect()]
    assert sorted(rows) == [(10010, 1, "E", "R", "03/04/2024", "County 10", "VA", "https://a.example/1"),
                            (10012, 2, "E", "R", "03/04/2024", "County 12", "MA", "https://a.example/1")]
    assert stored == {"local-requests": [4], "asked-answers": [6, 3], "site-requests": [2], "verdict-requests": [3],
                      "judged-links": [2], "article-urls": [1]}
