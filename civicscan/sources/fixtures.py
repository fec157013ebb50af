"""Reference-shaped inputs derived from the driver tables.

The driver tables hold no news feed, utilities, search responses or model
responses, so each input is a deterministic SQL view over them.  Every text
below is valid in Spark SQL and in DuckDB, so the oracle and the Spark job read
the same rows.  ``${name}`` marks a table: for Spark it becomes a direct
parquet path scan (no temp-view registration, so calls with different data
folders never collide); for DuckDB it stays the registered view name.

Fixture views that depend on other fixture views are listed in ``DEPENDS``.
"""

from __future__ import annotations

from string import Template

from pyspark.sql import DataFrame, SparkSession

from .tables import table_path

# News feed (knowledge-graph rows) from ``events``.
FX_GKG = r"""
SELECT event_id,
 (2013 + event_id % 13)*10000000000 + (1 + event_id % 12)*100000000 + (1 + event_id % 28)*1000000 + (event_id % 24)*10000 + (event_id % 60)*100 + event_id % 60 AS gkg_date,
 CAST(ts AS DATE) AS partition_date,
 concat('https://news', CAST(user_id % 20 AS STRING), '.example.com/', CASE event_id % 4 WHEN 0 THEN 'Boil-Water-Advisory' WHEN 1 THEN 'boil-order-for-water' WHEN 2 THEN 'weather' ELSE 'boil-the-water-now' END, '-', CAST(CAST(floor(event_id / 40) AS BIGINT) AS STRING)) AS document_identifier,
 concat('news', CAST(user_id % 20 AS STRING), '.example.com') AS source_common_name,
 CASE WHEN event_id % 17 = 0 THEN NULL WHEN event_id % 29 = 0 THEN '2#Short'
  WHEN event_id % 31 = 0 THEN '2#Nowhere, United States#US#USZZ##35.0#-90.0#ZZ#20' WHEN event_id % 37 = 0 THEN '2#Blank, United States#US#US##35.0#-90.0##20' ELSE concat(
  CASE event_id % 5 WHEN 0 THEN '1#United States#US#US##39.8#-98.5#US#10' WHEN 1 THEN '2#Virginia, United States#US#USVA##37.8#-78.2#VA#20' WHEN 2 THEN '3#Austin, Texas, United States#US#USTX#TX453#30.3#-97.7#1#30' WHEN 3 THEN 'x#Bad Type, Ohio, United States#US#USOH##bad#-82.9#2#40' ELSE '4#London, United Kingdom#UK#UKH9##51.5#-0.1#3#50' END,
  CASE WHEN event_id % 3 = 0 THEN CASE event_id % 2 WHEN 0 THEN ';3#Boston, Massachusetts, United States#US#USMA#MA025#42.4#-71.1#4#60' ELSE ';3#San Juan, Puerto Rico#US#USPR##18.5#-66.1#5#70' END ELSE '' END) END AS v2locations
FROM ${events}
"""

# Water utilities from ``customer``.
FX_UTILITIES = r"""
SELECT c_custkey AS utility_id,
 concat(CASE c_nationkey % 5 WHEN 0 THEN 'VA' WHEN 1 THEN 'TX' WHEN 2 THEN 'MA' WHEN 3 THEN 'OH' ELSE 'PR' END, lpad(CAST(c_custkey AS STRING), 7, '0')) AS pwsid,
 CASE c_nationkey % 5 WHEN 0 THEN 'VA' WHEN 1 THEN 'TX' WHEN 2 THEN 'MA' WHEN 3 THEN 'OH' ELSE 'PR' END AS state_code,
 10001 + c_custkey % 700 AS county_fips, concat('County ', CAST(c_custkey % 700 AS STRING)) AS county_name,
 CASE WHEN c_custkey % 41 = 0 THEN NULL ELSE CAST(floor(c_acctbal) AS BIGINT) END AS population_served_count FROM ${customer}
"""

# County crosswalk: one row per county code of the utilities.
FX_CROSSWALK = r"""
SELECT 10001 + k AS county_fips, concat('County ', CAST(k AS STRING)) AS county_label,
 CASE k % 3 WHEN 0 THEN 'urban' WHEN 1 THEN 'suburban' ELSE 'rural' END AS county_class
FROM (SELECT DISTINCT c_custkey % 700 AS k FROM ${customer}) c
WHERE k % 10 <> 9
"""

# Crawled pages from ``pages`` with injected date evidence.
FX_PAGES = r"""
SELECT page_id, url, replace(replace(html, '</head>', concat(
  CASE page_id % 4
   WHEN 0 THEN concat('<script type="application/ld+json">{"@type":"NewsArticle","headline":"Notice ', CAST(page_id AS STRING), CASE WHEN page_id % 8 = 0 THEN concat('","url":"https://a.example/', CAST(page_id + 1 AS STRING)) ELSE concat('","url":"https://www.example.com/canonical/', CAST(page_id % 40 AS STRING)) END, '","datePublished":"2024-01-', lpad(CAST(1 + page_id % 28 AS STRING), 2, '0'), 'T23:30:00-05:00","dateModified":"2024-02-', lpad(CAST(1 + page_id % 28 AS STRING), 2, '0'), '","author":[{"name":"A"},{"name":"B"}],"publisher":{"name":"Daily"}}</script>')
   WHEN 1 THEN concat('<!-- <script type="application/ld+json">{"datePublished":"2020-01-01"}</script> --><script async type=application/ld+json>[{"@type":"WebSite"},{"@graph":[{"@type":["Article"],"uploadDate":"2023-06-', lpad(CAST(1 + page_id % 28 AS STRING), 2, '0'), '"}]}]</script>')
   WHEN 2 THEN '<script type="application/ld+json">{broken</script>' ELSE '' END,
  CASE WHEN page_id % 3 = 0 THEN concat('<meta property="article:published_time" content="2024-03-', lpad(CAST(1 + page_id % 28 AS STRING), 2, '0'), '">') ELSE '' END,
  CASE WHEN page_id % 2 = 0 THEN concat('<meta name="pubdate" content="2022-12-', lpad(CAST(1 + page_id % 28 AS STRING), 2, '0'), '">') ELSE '' END,
  '</head>')), '</article>', concat(
  CASE WHEN page_id % 5 = 0 THEN concat('<time datetime="2024-04-', lpad(CAST(1 + page_id % 28 AS STRING), 2, '0'), '">Updated</time>') ELSE '' END,
  CASE WHEN page_id % 7 = 0 THEN '<p>Published: 2021-05-06</p>' ELSE '' END,
  CASE WHEN page_id % 9 = 0 THEN '<nav-bar><p title="a>b">Caf&eacute; &#8217;26 &#x26; more</p></nav-bar><!-- <time datetime="2019-01-01">old</time> --><time-ago>then</time-ago><meta content="see name=pubdate here"><template><p>hidden text</p></template><nav>menu</nav><div class=x>open' ELSE '' END,
  CASE WHEN page_id % 9 = 4 THEN replace('<p data-x=it~s>Stray quote</p><p class=x id=it~s>We don~t stop &copy 2024 &amp more</p><p title="say "a>b" now">Said</p><time datetime=2024-05-01 class=it~s>then</time><p title = "c>d">Spaced</p></b>', '~', chr(39)) ELSE '' END,
  CASE WHEN page_id % 13 = 2 THEN concat('<p>Published: ', CASE page_id % 5 WHEN 0 THEN 'Jan 5, 24' WHEN 1 THEN '2024-Jan-05' WHEN 2 THEN '2024 January 5' WHEN 3 THEN '05JAN2024' ELSE '05.01.24' END, '</p>') ELSE '' END,
  CASE WHEN page_id % 10 = 3 THEN concat('<section><h2>More</h2><div class="box"><p>', repeat('Boil water for one minute before use. ', 8), '</p><div>Not closed</section><section><p>', repeat('Tap water is safe again. ', 10), '<a href="/more">more</a></p></section><main><div>Short</div></main>') ELSE '' END,
  CASE WHEN page_id % 11 = 0 THEN '<p>Last updated: 5-Jan-2024</p>' WHEN page_id % 11 = 1 THEN '<p>Posted on 25/12/2023 by us</p>' WHEN page_id % 11 = 2 THEN '<time>5th of January 2024</time>' ELSE '' END, '</article>')) AS html,
 CASE WHEN page_id % 6 = 0 THEN 'Wed, 21 Oct 2015 07:28:00 GMT' WHEN page_id % 6 = 1 THEN 'Sunday, 06-Nov-94 08:49:37 GMT' END AS http_last_modified,
 CASE WHEN page_id % 13 = 0 THEN 404 ELSE 200 END AS status_code FROM ${pages}
"""

# Crawl table keyed by the result urls the search responses point at: pages
# answer https://a.example/<n>, every 50th one the shared https://b.example/x
# (crawled many times over), and every tenth keeps its own url.
FX_CRAWL = r"""
SELECT page_id,
 CASE WHEN page_id % 50 = 7 THEN 'https://b.example/x' WHEN page_id % 10 = 9 THEN url ELSE concat('https://a.example/', CAST(page_id AS STRING)) END AS url,
 html, http_last_modified, status_code
FROM fx_pages
"""

# Nested-shape search bodies from ``documents``.
FX_SEARCH = r"""
SELECT doc_id, CASE WHEN doc_id % 19 = 0 THEN '<html>rate limited</html>' WHEN doc_id % 11 = 0 THEN '{"data":{}}' ELSE concat('{"data":{"webPages":{"value":[{"url":"https://a.example/', CAST(CAST(floor(doc_id / 4) AS BIGINT) AS STRING), '","displayUrl":"https://a.example/', CAST(CAST(floor(doc_id / 4) AS BIGINT) AS STRING), '","snippet":"', CASE doc_id % 3 WHEN 0 THEN 'Residents must boil water' WHEN 1 THEN 'Boil Water Notice' ELSE 'road works' END, '","summary":"s', CAST(CAST(floor(doc_id / 4) AS BIGINT) AS STRING), '"},{"url":"https://b.example/x","displayUrl":"https://b.example/x","snippet":"please boil","summary":"t"}', CASE WHEN doc_id % 13 = 5 THEN ',"odd",null,7' ELSE '' END, ']}}}') END AS body FROM ${documents}
"""

# Flat-shape search bodies from ``documents`` (items[] of title/link/snippet).
FX_SEARCH_FLAT = r"""
SELECT doc_id, CASE WHEN doc_id % 23 = 0 THEN '{"kind":"customsearch#search"}' ELSE concat('{"items":[', CASE WHEN doc_id % 13 = 6 THEN '"odd",' ELSE '' END, '{"title":"Local ', CAST(doc_id AS STRING), '","link":"https://a.example/', CAST(CAST(floor(doc_id / 4) AS BIGINT) AS STRING), '","snippet":"', CASE doc_id % 4 WHEN 0 THEN 'City says boil your water' WHEN 1 THEN 'BOIL notice lifted' WHEN 2 THEN 'school news' ELSE 'boil order issued' END, ' in area ', CAST(CAST(floor(doc_id / 4) AS BIGINT) AS STRING), '"},{"title":"Other","link":"https://b.example/x","snippet":"weather"},{"title":"Third","link":"https://a.example/', CAST(CAST(floor((doc_id + 7) / 4) AS BIGINT) AS STRING), '","snippet":"boil advisory for area ', CAST(CAST(floor(doc_id / 4) AS BIGINT) AS STRING), '"}]}') END AS body FROM ${documents}
"""

# Model responses from ``documents``.
FX_LLM = r"""
SELECT doc_id, CASE WHEN doc_id % 77 = 20 THEN '{"advisories":[],"advisories":[{"type":"D","location":"Last"}]}' WHEN doc_id % 77 = 31 THEN '{"score":NaN,"advisories":[{"type":"N","location":"x, ]y","start_date":"a,}b"}]}' ELSE CASE doc_id % 7 WHEN 0 THEN 'Sure: {"advisories":[{"type":"E","location":"Richmond","start_date":"2024-01-02","end_date":null},{"type":"P","location":["Austin","Waco"],"start_date":"null","end_date":"2024-02-03"}]} done' WHEN 1 THEN '{"advisories":[]}' WHEN 2 THEN '{"advisories":"none"}' WHEN 3 THEN 'YES I cannot help' WHEN 4 THEN '{}' WHEN 5 THEN '{advisories:[{type:"P",location:"Ohio",}]}' ELSE '{"advisories":[{"type":"P","location":"Erie","start_date":"2024-05-06"},"none",null]}' END END AS response FROM ${documents}
"""

# Collected search responses keyed by request text, as a search service
# would have answered the utility x year requests; requests are logged more
# than once, with different answers.
FX_SEARCH_LOG = r"""
SELECT concat('Boil Water Advsiory in ', CAST(2020 + s.doc_id % 6 AS STRING), ' at ', u.county_name, ', ', u.state_code) AS query, s.body
FROM fx_search s JOIN fx_utilities u ON u.utility_id = CAST(floor(s.doc_id / 6) AS BIGINT)
"""

# Responses to the county news-site requests (nested shape, up to 5 results).
FX_NEWS_LOG = r"""
SELECT concat('boil water advisory warning from news sites ', u.county_name, ', ', left(u.pwsid, 2)) AS query, s.body
FROM fx_search s JOIN fx_utilities u ON u.utility_id = s.doc_id
"""

# Responses to the local-news and site-restricted requests (flat shape), from
# every document; requests have several stored answers.
FX_LOCAL_LOG = r"""
SELECT concat('local news in ', u.county_name, ', ', left(u.pwsid, 2)) AS query, f.body
FROM fx_search_flat f JOIN fx_utilities u ON u.county_fips = 10001 + f.doc_id % 700
"""
FX_SITE_LOG = r"""
SELECT concat('Boil Water Notice site:https://a.example/', CAST(CAST(floor(doc_id / 4) AS BIGINT) AS STRING), ' after:2025-01-01') AS query, body
FROM fx_search_flat
"""

# Model answers: yes/no verdicts keyed by the verdict prompt, extractions
# keyed by the article link.
FX_VERDICT_LOG = r"""
SELECT concat(CASE doc_id % 4 WHEN 0 THEN 'City says boil your water' WHEN 1 THEN 'BOIL notice lifted' WHEN 2 THEN 'school news' ELSE 'boil order issued' END,
  ' in area ', CAST(CAST(floor(doc_id / 4) AS BIGINT) AS STRING),
  ' Responding in either "YES" or "NO" do you think this news article is about a boil water advisory') AS prompt,
 CASE WHEN doc_id % 4 IN (0, 3) THEN 'YES, it is about an advisory.' ELSE 'NO' END AS response
FROM ${documents}
UNION ALL
SELECT concat('boil advisory for area ', CAST(CAST(floor(doc_id / 4) AS BIGINT) AS STRING),
  ' Responding in either "YES" or "NO" do you think this news article is about a boil water advisory') AS prompt, 'YES' AS response
FROM ${documents}
"""
FX_ARTICLE_LLM = r"""
SELECT c.url AS link, l.response FROM fx_crawl c JOIN fx_llm l ON l.doc_id = c.page_id * 3
"""

# Model answers about search-result summaries, keyed by the summary text.
FX_SUMMARY_LLM = r"""
SELECT concat('s', CAST(CAST(floor(doc_id / 4) AS BIGINT) AS STRING)) AS input_text, response FROM fx_llm
UNION ALL SELECT 't' AS input_text, response FROM fx_llm
"""

# Model answers stored as content parts (text and non-text blocks).
FX_LLM_PARTS = r"""
SELECT doc_id, CASE WHEN doc_id % 7 = 0 THEN '[]' WHEN doc_id % 5 = 0 THEN '{"error":"overloaded"}'
 ELSE concat('[{"type":"text","text":"Verdict for ', CAST(doc_id AS STRING), ': "},{"type":"tool_use","id":"t', CAST(doc_id AS STRING),
  '"},{"type":"text","text":"', CASE WHEN doc_id % 2 = 0 THEN 'YES' ELSE 'NO' END, '"}]') END AS content
FROM ${documents}
"""

# Crawled article pages for the news links (url rewritten onto the feed links).
FX_NEWS_CRAWL = r"""
SELECT page_id, concat('https://news', CAST(page_id % 20 AS STRING), '.example.com/Boil-Water-Advisory-', CAST(page_id AS STRING)) AS url,
 html, http_last_modified, status_code FROM fx_pages
"""

FIXTURES = {
    "fx_gkg": FX_GKG,
    "fx_utilities": FX_UTILITIES,
    "fx_crosswalk": FX_CROSSWALK,
    "fx_pages": FX_PAGES,
    "fx_crawl": FX_CRAWL,
    "fx_search": FX_SEARCH,
    "fx_search_flat": FX_SEARCH_FLAT,
    "fx_llm": FX_LLM,
    "fx_search_log": FX_SEARCH_LOG,
    "fx_news_log": FX_NEWS_LOG,
    "fx_local_log": FX_LOCAL_LOG,
    "fx_site_log": FX_SITE_LOG,
    "fx_verdict_log": FX_VERDICT_LOG,
    "fx_article_llm": FX_ARTICLE_LLM,
    "fx_news_crawl": FX_NEWS_CRAWL,
    "fx_summary_llm": FX_SUMMARY_LLM,
    "fx_llm_parts": FX_LLM_PARTS,
}

DEPENDS = {
    "fx_crawl": ["fx_pages"],
    "fx_search_log": ["fx_search", "fx_utilities"],
    "fx_news_log": ["fx_search", "fx_utilities"],
    "fx_local_log": ["fx_search_flat", "fx_utilities"],
    "fx_site_log": ["fx_search_flat"],
    "fx_article_llm": ["fx_crawl", "fx_llm"],
    "fx_news_crawl": ["fx_pages"],
    "fx_summary_llm": ["fx_llm"],
}

BASE_TABLES = {
    "fx_gkg": ["events"],
    "fx_utilities": ["customer"],
    "fx_crosswalk": ["customer"],
    "fx_pages": ["pages"],
    "fx_crawl": [],
    "fx_search": ["documents"],
    "fx_search_flat": ["documents"],
    "fx_llm": ["documents"],
    "fx_search_log": [],
    "fx_news_log": [],
    "fx_local_log": [],
    "fx_site_log": [],
    "fx_verdict_log": ["documents"],
    "fx_article_llm": [],
    "fx_news_crawl": [],
    "fx_summary_llm": [],
    "fx_llm_parts": ["documents"],
}


def duckdb_text(name: str) -> str:
    """The fixture text with driver table names (DuckDB views)."""
    return Template(FIXTURES[name]).substitute({t: t for t in BASE_TABLES[name]})


def duckdb_ctes(*names: str) -> str:
    """``WITH`` clause defining the given fixture views (dependencies first)."""
    order: list[str] = []

    def add(n):
        for d in DEPENDS.get(n, []):
            add(d)
        if n not in order:
            order.append(n)

    for n in names:
        add(n)
    return "WITH " + ",\n".join(f"{n} AS ({duckdb_text(n)})" for n in order)


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Spark DataFrame of a fixture view over the parquet tables in ``sf_dir``."""
    mapping = {t: f"parquet.`{table_path(sf_dir, t)}`" for t in BASE_TABLES[name]}
    text = Template(FIXTURES[name]).substitute(mapping)
    deps = DEPENDS.get(name, [])
    if deps:
        import re
        kwargs = {d: load(spark, sf_dir, d) for d in deps}
        for d in deps:
            text = re.sub(rf"\b{d}\b", "{" + d + "}", text)
        return spark.sql(text, **kwargs)
    return spark.sql(text)
