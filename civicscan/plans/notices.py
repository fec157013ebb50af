"""Composite jobs (K5–K9): requests -> collected responses -> filters ->
page evidence -> report rows.

Every former network call is a join with a collected-response table keyed by
the request text (or by the article link).  A request logged more than once
counts once.  Pages are looked up by the url that was requested, and only the
pages that results ask for are parsed.
Skew: the same result url (a site's landing page) or summary can stand behind
a large share of all results; those lookups are salted, and the tables looked
up are narrow (one row per url).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..functions import dates as D
from ..operators import articles, dates, responses, utilities
from ..operators.feed import first_per_link, keep_first
from ..operators.joins import keep_asked, salted_lookup
from ..session import materialize


def pages_for(crawl: DataFrame, urls: DataFrame, name: str) -> DataFrame:
    """The crawled pages of the requested ``urls`` (one column, repeats allowed).

    The distinct urls are written to the shared folder first: they are
    computed once, and counted to size the filter that cuts the crawl where it
    is scanned, before any HTML is parsed or shuffled.
    """
    wanted = materialize(urls.toDF("_url").distinct(), name)
    return keep_asked(crawl, "url", wanted)


def dates_by_url(crawl: DataFrame) -> DataFrame:
    """X8 keyed by the requested url: best published date text (MM/DD/YYYY)
    per crawled url, the lowest page id winning when a url was crawled twice.
    Results are joined on the url they asked for, so a redirect target
    (``final_url``) must not replace the key here."""
    pd_ = dates.page_dates(crawl.drop("final_url") if "final_url" in crawl.columns else crawl)
    one = keep_first(pd_, "url", [F.col("page_id").asc()])
    return one.select("url", D.format_mdy(F.col("published")).alias("published"),
                      D.format_mdy(F.col("updated")).alias("updated"))


def utility_notices(utilities_df: DataFrame, search_log: DataFrame, crawl: DataFrame,
                    top_n: int = schemas.NESTED_RESULTS_PER_REQUEST,
                    url_dates: DataFrame | None = None) -> DataFrame:
    """K5: utility x year requests -> responses -> results with 'boil' in the
    snippet -> published date of the result page -> snippet report rows."""
    reqs = utilities.year_requests(utilities.over_threshold(utilities_df))
    answered = reqs.join(responses.one_answer(search_log, "query", "body", responses.NESTED_PATH), "query")   # J6
    res = responses.nested_results(answered, ("utility_id", "county", "state", "year", "query"),
                                   top_n=top_n)                    # S9 + P13 + W4
    hits = materialize(responses.snippet_contains(res), "notice-hits")   # P4
    if url_dates is None:
        url_dates = dates_by_url(pages_for(crawl, hits.select("display_url"), "notice-urls"))
    pd_ = url_dates.select(F.col("url").alias("display_url"), "published")
    joined = salted_lookup(hits, pd_, "display_url")               # J7
    out = joined.withColumnsRenamed({"display_url": "link", "published": "publish_date"})
    return out.select("utility_id", "year", *schemas.SNIPPET_CSV_FIELDS)      # R4


def summary_advisories(utilities_df: DataFrame, news_log: DataFrame, crawl: DataFrame,
                       extract_log: DataFrame, top_n: int = schemas.FLAT_RESULTS_DEFAULT,
                       url_dates: DataFrame | None = None) -> DataFrame:
    """K7: county news-site requests -> results with 'boil' -> page dates ->
    advisories extracted from the result summary, with the result columns.

    ``extract_log`` holds model answers keyed by the summary text they were
    asked about (input_text, response)."""
    u = utilities.over_threshold(utilities_df).select(
        "utility_id", F.col("county_name").alias("county"), F.left(F.col("pwsid"), F.lit(2)).alias("state"))
    reqs = utilities.county_requests(u, schemas.COUNTY_NEWS_QUERY)
    res = responses.nested_results(reqs.join(responses.one_answer(news_log, "query", "body", responses.NESTED_PATH), "query"),
                                   ("utility_id", "county", "state"), top_n=top_n)
    hits = materialize(responses.snippet_contains(res), "summary-hits")
    if url_dates is None:
        url_dates = dates_by_url(pages_for(crawl, hits.select("display_url"), "summary-urls"))
    pd_ = url_dates.select(F.col("url").alias("display_url"), F.col("published").alias("publish_date"))
    extras = salted_lookup(hits, pd_, "display_url").select(
        "utility_id", "rank", "county", "state", F.col("display_url").alias("link"), "summary",
        F.coalesce("publish_date", F.lit("")).alias("publish_date"))
    stored = responses.one_answer(extract_log, "input_text", "response").withColumnRenamed("input_text", "summary")
    # many results may carry the same summary
    answers = salted_lookup(extras, stored, "summary", like=hits).where(F.col("response").isNotNull())
    return responses.advisories_carrying(answers, ["utility_id", "rank"],
                                         ["county", "state", "link", "summary", "publish_date"])


def answered(requests: DataFrame, log: DataFrame, key: str, value: str, path: str | None = None) -> DataFrame:
    """``requests`` (stored) with the one stored answer of each, an inner join
    on ``key``.

    The log is cut to the requests where it is scanned, so one of very many
    other requests costs its scan.  Answers to be parsed are stored first, each
    once however often it was logged: a distinct right below the minimum over
    them would be dropped from the plan, and every copy parsed."""
    asked = keep_asked(log.select(key, value), key, requests.select(key))
    if path is not None:
        asked = materialize(asked.distinct(), "asked-answers")
    return requests.join(responses.one_answer(asked, key, value, path), key)


def site_chain(spark, utilities_df: DataFrame, local_log: DataFrame, seed: int = 0) -> DataFrame:
    """Sampled county -> top-1 local-news result -> site-restricted notice
    request text (dated after a fixed day)."""
    counties = utilities.county_first(utilities_df, utilities.county_sample(spark, utilities_df, seed))
    # one row per sampled county
    local_q = materialize(utilities.county_requests(counties, schemas.LOCAL_NEWS_QUERY), "local-requests")
    local = responses.flat_results(answered(local_q, local_log, "query", "body", responses.FLAT_PATH),
                                   ("county_fips", "county", "state"), top_n=1)
    after = F.date_format(F.lit(schemas.SITE_NOTICE_AFTER).cast("date"), "yyyy-MM-dd")   # F12
    return local.select("county_fips", "county", "state", "link", utilities.template(
        schemas.SITE_NOTICE_QUERY, link=F.col("link"), after=after).alias("query"))


def sampled_advisories(spark, utilities_df: DataFrame, local_log: DataFrame, site_log: DataFrame,
                       verdict_log: DataFrame, crawl: DataFrame, article_llm: DataFrame,
                       seed: int = 0) -> DataFrame:
    """K6: county sample -> top local-news site -> site-restricted notices after
    a date -> snippet has 'boil' -> verdict says YES -> article record ->
    advisories with the article's (parsed) date, county, state and link."""
    site_q = materialize(site_chain(spark, utilities_df, local_log, seed).drop("link"), "site-requests")   # J9
    found = responses.flat_results(answered(site_q, site_log, "query", "body", responses.FLAT_PATH),
                                   ("county_fips", "county", "state"), top_n=2)
    hits = responses.snippet_contains(found)                                            # P4
    asked = materialize(hits.withColumn("prompt", responses.verdict_prompt(F.col("snippet"))), "verdict-requests")   # F13
    judged = responses.verdict_yes(answered(asked, verdict_log, "prompt", "response"))  # P5
    # at most (sample size x 2) rows, computed once: they choose the pages and carry the answers
    links = materialize(judged.select("county_fips", "rank", "county", "state", "link"), "judged-links")
    # One record per requested url (lowest page id); links without a page keep
    # their row with no article date.
    asked_about = article_requests(links, crawl)
    enriched = answered(links, article_llm, "link", "response").join(asked_about.select("link", "article_date"), "link", "left")
    answers = enriched.withColumn("publish_date", D.format_mdy(D.parse_date("article_date")))
    return responses.advisories_carrying(answers, ["county_fips", "rank"],
                                         ["county", "state", "link", "publish_date"],
                                         fields=schemas.ADVISORY_CSV_FIELDS_B)


def record_per_url(pages: DataFrame) -> DataFrame:
    """X12, one record per requested url: the one of the lowest page id.  A
    page may name another url as its own; that one is no key here."""
    return keep_first(articles.article_records(pages), "request_url", [F.col("page_id").asc()])


def article_requests(links: DataFrame, crawl: DataFrame) -> DataFrame:
    """K6's model requests: per link with a crawled page the article date and
    the extraction prompt around the whole article text (F13)."""
    recs = record_per_url(pages_for(crawl, links.select("link"), "article-urls"))
    return recs.select(F.col("request_url").alias("link"), F.col("date").alias("article_date"),
                       responses.extraction_prompt(F.col("text")).alias("prompt"))


def enriched_news(news: DataFrame, crawl: DataFrame) -> DataFrame:
    """K8: first row per link of the news feed with the article title, text
    and description of the page crawled for it (left join on the link)."""
    first = materialize(first_per_link(news), "news-first")
    recs = record_per_url(pages_for(crawl, first.select("link"), "news-urls")).select(
        F.col("request_url").alias("link"), F.col("title").alias("article_title"),
        F.col("text").alias("article_text"), F.col("description").alias("article_summary"))
    return first.join(recs, "link", "left")                                             # J8 + R8


def build_utility_master(spark, utilities_csv: str, crosswalk_csv: str, out_dir: str,
                         utilities_schema=None, crosswalk_schema=None) -> DataFrame:
    """K9: utility CSV (explicit schema) joined with the county crosswalk on the
    county code, written as a CSV report directory; returns the joined frame."""
    from ..sources import csvio
    u = csvio.read_csv(spark, utilities_csv, utilities_schema or schemas.UTILITY_CSV_SCHEMA)
    x = csvio.read_csv(spark, crosswalk_csv, crosswalk_schema or "COUNTYFIPS long, county_label string, county_class string")
    master = utilities.with_crosswalk(u, x, key="COUNTYFIPS")
    csvio.write_csv(master, out_dir)
    return master


def notice_reports(utilities_df: DataFrame, search_log: DataFrame, news_log: DataFrame,
                   crawl: DataFrame, extract_log: DataFrame) -> tuple[DataFrame, DataFrame]:
    """K5 and K7 together: the per-url page dates (the expensive, HTML-wide
    step) are computed once, written to the shared checkpoint folder, and
    both reports read that table."""
    url_dates = materialize(dates_by_url(crawl), "url-dates")
    return (utility_notices(utilities_df, search_log, crawl, url_dates=url_dates),
            summary_advisories(utilities_df, news_log, crawl, extract_log, url_dates=url_dates))
