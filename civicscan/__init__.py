"""civicscan: Spark-native mining of public notices from news feeds and crawled pages.

Layout
------
sources/    table readers, fixture views over the driver tables, CSV sinks
functions/  column-expression helpers (dates, JSON, text, templates)
operators/  DataFrame -> DataFrame operators (feed, trends, utilities,
            responses, page dates, articles)
plans/      composite jobs and the query catalog used by ``__spark_entry__``
streaming/  incremental (Structured Streaming) form of the news-feed job
"""

__all__ = ["session"]
