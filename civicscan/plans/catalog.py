"""Query catalog: one callable ``(spark, sf_dir) -> DataFrame`` per operator or
composite job.  Each reads the driver tables in ``sf_dir`` (through the fixture
views) so its work grows with them.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..operators import feed, trends
from ..session import checkpoint_dir, ship_package
from ..sources import csvio, fixtures
from ..sources.tables import read_state_geo, read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn):
    """Register ``fn``; the registered callable first makes sure the Python
    workers can import this package (pandas UDFs live in it)."""
    import functools

    @functools.wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return fn(spark, sf_dir)

    QUERIES[fn.__name__] = run
    return fn


# ---------------------------------------------------------------- shared inputs

def news_locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feed.us_locations(fx(spark, sf_dir, "fx_gkg"))


def news_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feed.first_per_link(news_locations(spark, sf_dir))


def notice_news(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trend input: first row per link whose link carries a notice keyword."""
    return feed.keyword_include(news_first(spark, sf_dir))


def non_country(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trends.non_country_rows(notice_news(spark, sf_dir))


def located(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trends.lookup_state(non_country(spark, sf_dir), schemas.state_names(spark))


def known_located(spark: SparkSession, sf_dir: str) -> DataFrame:
    return located(spark, sf_dir).where(F.col("state").isNotNull())


# ---------------------------------------------------------------- feed (K1, K2)

@query
def feed_us_locations(spark, sf_dir):
    return news_locations(spark, sf_dir)


@query
def feed_first_location(spark, sf_dir):
    return news_first(spark, sf_dir)


@query
def feed_keyword_include(spark, sf_dir):
    return feed.keyword_include(news_first(spark, sf_dir))


@query
def feed_keyword_exclude(spark, sf_dir):
    return feed.keyword_exclude(news_first(spark, sf_dir))


@query
def feed_excluded_count(spark, sf_dir):
    return feed.excluded_count(news_first(spark, sf_dir))


# ---------------------------------------------------------------- trends (K3, K4)

@query
def location_type_counts(spark, sf_dir):
    return trends.location_type_counts(notice_news(spark, sf_dir))


@query
def non_country_rows(spark, sf_dir):
    return non_country(spark, sf_dir)


@query
def state_lookup(spark, sf_dir):
    return located(spark, sf_dir)


@query
def state_lookup_unknown(spark, sf_dir):
    return trends.unknown_states(non_country(spark, sf_dir), schemas.state_names(spark))


@query
def counts_by_year(spark, sf_dir):
    return trends.counts_by_year(non_country(spark, sf_dir))


@query
def counts_by_state(spark, sf_dir):
    return trends.counts_by_state(known_located(spark, sf_dir))


@query
def counts_by_state_year(spark, sf_dir):
    return trends.counts_by_state_year(known_located(spark, sf_dir), schemas.state_names(spark))


def _state_geo(spark, sf_dir):
    return trends.state_geo_from_points(known_located(spark, sf_dir), schemas.state_names(spark))


@query
def state_map_table(spark, sf_dir):
    # one located frame feeds both branches, so its dedupe exchange is reused
    states = schemas.state_names(spark)
    known = known_located(spark, sf_dir)
    counts = trends.counts_by_state_year(known, states)
    geo = trends.state_geo_from_points(known, states)
    return trends.state_map_table(counts, geo, states)


@query
def state_map_stored(spark, sf_dir):
    """The map table over a geometry table that was stored before."""
    states = schemas.state_names(spark)
    path = _report_folder(spark, "state_geo")
    known = known_located(spark, sf_dir)
    trends.state_geo_from_points(known, states).write.parquet(path)
    return trends.state_map_table(trends.counts_by_state_year(known, states), read_state_geo(spark, path), states)


@query
def state_extent(spark, sf_dir):
    return trends.state_extent(_state_geo(spark, sf_dir))


# ---------------------------------------------------------------- utilities (K5 requests, K9, O4)

from ..operators import responses, utilities  # noqa: E402


def fx(spark, sf_dir, name):
    return fixtures.load(spark, sf_dir, name)


@query
def utilities_over_threshold(spark, sf_dir):
    return utilities.over_threshold(fx(spark, sf_dir, "fx_utilities"))


@query
def utility_year_requests(spark, sf_dir):
    return utilities.year_requests(utilities.over_threshold(fx(spark, sf_dir, "fx_utilities")))


@query
def utility_crosswalk(spark, sf_dir):
    return utilities.with_crosswalk(fx(spark, sf_dir, "fx_utilities"), fx(spark, sf_dir, "fx_crosswalk"))


@query
def county_sample(spark, sf_dir):
    return utilities.county_sample(spark, fx(spark, sf_dir, "fx_utilities"))


@query
def county_first(spark, sf_dir):
    u = fx(spark, sf_dir, "fx_utilities")
    return utilities.county_first(u, utilities.county_sample(spark, u))


# ---------------------------------------------------------------- responses

@query
def search_results(spark, sf_dir):
    return responses.nested_results(fx(spark, sf_dir, "fx_search"))


@query
def search_flat(spark, sf_dir):
    return responses.flat_results(fx(spark, sf_dir, "fx_search_flat"),
                                  top_n=schemas.FLAT_RESULTS_DEFAULT)


@query
def search_top_n(spark, sf_dir):
    return responses.flat_results(fx(spark, sf_dir, "fx_search_flat"), top_n=2)


@query
def search_urls(spark, sf_dir):
    return responses.result_urls(fx(spark, sf_dir, "fx_search"))


@query
def snippet_hits(spark, sf_dir):
    return responses.snippet_contains(responses.nested_results(fx(spark, sf_dir, "fx_search")))


@query
def verdict_yes(spark, sf_dir):
    return responses.verdict_yes(fx(spark, sf_dir, "fx_llm"))


@query
def prompt_text(spark, sf_dir):
    from ..sources.tables import read_state_geo, read_table
    docs = read_table(spark, sf_dir, "documents")
    return docs.select("doc_id", responses.extraction_prompt(F.col("text")).alias("prompt"))


@query
def advisories_strict(spark, sf_dir):
    return responses.advisories(fx(spark, sf_dir, "fx_llm"))


@query
def advisories_lenient(spark, sf_dir):
    return responses.advisories(fx(spark, sf_dir, "fx_llm"), lenient=True)


@query
def advisories_bad(spark, sf_dir):
    return responses.advisories_rejected(fx(spark, sf_dir, "fx_llm"))


def _advisory_extras(spark, sf_dir):
    """Per-article extras: the first nested search result (link, summary) and
    the utility's county and state."""
    res = responses.nested_results(fx(spark, sf_dir, "fx_search")).where(F.col("rank") == 1)
    u = fx(spark, sf_dir, "fx_utilities").select(F.col("utility_id").alias("doc_id"),
                                                 F.col("county_name").alias("county"),
                                                 F.col("state_code").alias("state"))
    return res.select("doc_id", F.col("display_url").alias("link"), "summary").join(u, "doc_id")


@query
def advisory_report(spark, sf_dir):
    advs = responses.advisories(fx(spark, sf_dir, "fx_llm"))
    return responses.advisory_rows(advs.drop("adv_pos"), _advisory_extras(spark, sf_dir), ["doc_id"])


# ---------------------------------------------------------------- page dates

from ..operators import dates  # noqa: E402


def _signal_rows(spark, sf_dir, signal):
    pages = dates.pages_ok(fx(spark, sf_dir, "fx_pages"))
    return dates.candidate_rows(dates.candidates(pages, (signal,)))


@query
def pages_ok(spark, sf_dir):
    return dates.pages_ok(fx(spark, sf_dir, "fx_pages")).select(
        "page_id", "url", "status_code", "http_last_modified")


@query
def dates_jsonld(spark, sf_dir):
    return _signal_rows(spark, sf_dir, "jsonld")


@query
def dates_meta(spark, sf_dir):
    return _signal_rows(spark, sf_dir, "meta")


@query
def dates_time(spark, sf_dir):
    return _signal_rows(spark, sf_dir, "time")


@query
def dates_text(spark, sf_dir):
    return _signal_rows(spark, sf_dir, "text")


@query
def dates_last_modified(spark, sf_dir):
    return _signal_rows(spark, sf_dir, "http")


@query
def date_candidates(spark, sf_dir):
    pages = dates.pages_ok(fx(spark, sf_dir, "fx_pages"))
    return dates.candidate_rows(dates.candidates(pages))


@query
def page_dates(spark, sf_dir):
    return dates.page_dates(fx(spark, sf_dir, "fx_pages"))


@query
def page_date_lists(spark, sf_dir):
    return dates.candidate_lists(fx(spark, sf_dir, "fx_pages"))


# ---------------------------------------------------------------- articles

from ..functions import html as H  # noqa: E402
from ..operators import articles  # noqa: E402


@query
def jsonld_articles(spark, sf_dir):
    pages = fx(spark, sf_dir, "fx_pages")
    return articles.jsonld_articles(pages.where(articles.fetched(pages)))


@query
def visible_text(spark, sf_dir):
    pages = fx(spark, sf_dir, "fx_pages")
    found = pages.select("page_id", H.texts(F.col("html")).alias("t"))
    return found.select("page_id", "t.text_all", H.article_text(F.col("t.text_article")).alias("text_article"))


@query
def markdown_text(spark, sf_dir):
    pages = fx(spark, sf_dir, "fx_pages")
    return pages.select("page_id", H.markdown_text(F.col("html")).alias("markdown"))


@query
def best_container(spark, sf_dir):
    pages = fx(spark, sf_dir, "fx_pages")
    return articles.best_containers(pages.where(articles.fetched(pages)))


@query
def article_records(spark, sf_dir):
    return articles.article_records(fx(spark, sf_dir, "fx_pages"))


# ---------------------------------------------------------------- composite jobs (K5–K8)

from . import notices  # noqa: E402


@query
def utility_notices(spark, sf_dir):
    return notices.utility_notices(fx(spark, sf_dir, "fx_utilities"), fx(spark, sf_dir, "fx_search_log"),
                                   fx(spark, sf_dir, "fx_crawl"))


@query
def summary_advisories(spark, sf_dir):
    return notices.summary_advisories(fx(spark, sf_dir, "fx_utilities"), fx(spark, sf_dir, "fx_news_log"),
                                      fx(spark, sf_dir, "fx_crawl"), fx(spark, sf_dir, "fx_summary_llm"))


@query
def sampled_advisories(spark, sf_dir):
    return notices.sampled_advisories(spark, fx(spark, sf_dir, "fx_utilities"), fx(spark, sf_dir, "fx_local_log"),
                                      fx(spark, sf_dir, "fx_site_log"), fx(spark, sf_dir, "fx_verdict_log"),
                                      fx(spark, sf_dir, "fx_crawl"), fx(spark, sf_dir, "fx_article_llm"))


@query
def enriched_news(spark, sf_dir):
    return notices.enriched_news(news_locations(spark, sf_dir), fx(spark, sf_dir, "fx_news_crawl"))


@query
def site_chain(spark, sf_dir):
    return notices.site_chain(spark, fx(spark, sf_dir, "fx_utilities"), fx(spark, sf_dir, "fx_local_log"))


@query
def news_head(spark, sf_dir):
    """O3: the first 100 news rows in (publish_time, link) order."""
    return news_first(spark, sf_dir).orderBy(F.col("publish_time").asc_nulls_last(), "link").limit(100)


@query
def model_response_text(spark, sf_dir):
    return responses.model_texts(fx(spark, sf_dir, "fx_llm_parts"))


# ---------------------------------------------------------------- CSV hand-offs

def _report_folder(spark, name):
    """A new folder for a report, where driver and executors can read it."""
    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


@query
def documents_csv(spark, sf_dir):
    """Texts with quotes, commas and line breaks through a CSV report, read back as many tasks per file."""
    path = _report_folder(spark, "documents_csv")
    csvio.write_csv(read_table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "text"), path)
    return csvio.read_csv(spark, path, "doc_id long, lang string, source string, text string", multi_line=True)


@query
def news_report_csv(spark, sf_dir):
    """The feed report written and read back with its schema, as the trend job takes it."""
    path = _report_folder(spark, "news_report_csv")
    csvio.write_csv(news_first(spark, sf_dir), path)
    return csvio.read_news_csv(spark, path, multi_line=True)


@query
def appended_advisories(spark, sf_dir):
    """Advisory rows appended by two runs, one of them tried twice: each row counts once."""
    path = _report_folder(spark, "appended_advisories")
    rows = responses.advisories(fx(spark, sf_dir, "fx_llm"))
    odd = F.pmod("doc_id", F.lit(2)) == 1
    for run_id, part in (("odd", odd), ("even", ~odd | odd.isNull()), ("odd", odd)):
        csvio.append_run(rows.where(part), path, run_id)
    return csvio.read_runs(spark, path, rows.schema, multi_line=True).na.fill("")


@query
def counts_csv_by_year(spark, sf_dir):
    """One folder per year, written twice, read back with the year from the folders."""
    path = _report_folder(spark, "counts_csv_by_year")
    counts = trends.counts_by_state_year(known_located(spark, sf_dir), schemas.state_names(spark))
    for _ in range(2):
        csvio.write_by_year(counts, path)
    return csvio.read_csv(spark, path, counts.schema, multi_line=True)
