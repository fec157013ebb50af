"""Plan-shape regressions: per-page jobs never shuffle, each Python UDF runs
once per row, response unpacking stays narrow."""

import re

import pytest
from pyspark.sql import functions as F

from civicscan.plans.catalog import QUERIES
from conftest import SF_SMALL

NARROW = ["pages_ok", "dates_jsonld", "dates_meta", "dates_time", "dates_text", "dates_last_modified",
          "date_candidates", "page_dates", "jsonld_articles", "visible_text", "markdown_text",
          "best_container", "article_records", "search_results", "search_flat", "search_top_n",
          "search_urls", "snippet_hits", "verdict_yes", "prompt_text", "advisories_strict",
          "advisories_lenient", "advisories_bad", "model_response_text", "feed_us_locations",
          "utilities_over_threshold", "utility_year_requests"]


def physical(spark, name):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        return QUERIES[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


@pytest.mark.parametrize("name", NARROW)
def test_narrow_jobs_do_not_shuffle(spark, name):
    plan = physical(spark, name)
    assert "Exchange" not in plan, name


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_python_runs_at_most_once(spark, name):
    # by function: the walk over pages and the reader of responses may both stand in a plan, each once
    steps = re.findall(r"ArrowEvalPython \[(\w+)\(", physical(spark, name))
    assert len(steps) == physical(spark, name).count("ArrowEvalPython [") and len(set(steps)) == len(steps) and set(steps) <= {"walk", "read"}, (name, steps)


@pytest.mark.parametrize("name", ["utility_notices", "summary_advisories", "sampled_advisories", "enriched_news"])
def test_crawl_is_cut_to_the_asked_urls_before_parsing(spark, name):
    plan = physical(spark, name)
    assert "LeftSemi" in plan and "scalar-subquery" in plan
    for line in plan.splitlines():
        assert "CartesianProduct" not in line and "BroadcastNestedLoopJoin" not in line


def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")


def usual(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760")
    spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_bloom_filter_stands_below_the_shuffle_of_the_pages(spark, tmp_path):
    from civicscan.operators.joins import keep_asked
    pages = spark.range(20_000).select(F.concat(F.lit("http://u/"), "id").alias("url"), F.repeat(F.lit("<p>text</p>"), 20).alias("html"))
    pages = pages.unionByName(spark.createDataFrame([(None, "x")], "url string, html string"))
    pages.write.parquet(str(tmp_path / "pages"))
    pages = spark.read.parquet(str(tmp_path / "pages"))
    keys = spark.range(300).select(F.concat(F.lit("http://u/"), F.col("id") * 7).alias("_url"))
    keys = keys.unionByName(spark.createDataFrame([(None,), ("http://elsewhere",)], "_url string"))
    no_broadcast(spark)
    try:
        got = keep_asked(pages, "url", keys)
        plan = got._jdf.queryExecution().executedPlan().toString().split("Subqueries")[0]
        depth = {line.index("+-") if "+-" in line else 0: line for line in plan.splitlines()}
        path = [line for line in plan.splitlines() if "Exchange" in line or "scalar-subquery" in line or "FileScan parquet" in line and "html" in line]
        exchange = next(i for i, line in enumerate(path) if "Exchange hashpartitioning(url" in line)
        test = next(i for i, line in enumerate(path) if "Filter" in line and "scalar-subquery" in line)
        scan = next(i for i, line in enumerate(path) if "FileScan" in line)
        assert depth and exchange < test < scan  # the scan is innermost, the filter directly above it
        assert sorted(r.url for r in got.collect()) == sorted(f"http://u/{7 * i}" for i in range(300))
        # the filter alone lets few other rows pass
        from civicscan.operators.joins import bloom_filter, may_hold
        n = keys.count()
        passed = pages.filter(may_hold(bloom_filter(keys, n).scalar(), F.col("url"), n)).count()
        assert 300 <= passed < 300 + 20_000 * 0.02
        assert keep_asked(pages, "url", keys.limit(0)).count() == 0
    finally:
        usual(spark)


def test_bloom_filter_size_is_bounded():
    from civicscan.operators.joins import LEAST_BITS, MOST_BITS, filter_bits
    assert filter_bits(0) == LEAST_BITS and filter_bits(10**12) == MOST_BITS == 8 * (8 << 20)
    assert filter_bits(1000) == 1 << 14


def skewed(spark, n=6000):
    rows = spark.range(n).select("id", F.when(F.col("id") % 4 < 3, "hot").otherwise(F.concat(F.lit("k"), "id")).alias("url"))
    return rows.unionByName(spark.createDataFrame([(-1, None), (-2, None)], "id long, url string"))


def test_salted_lookup_splits_a_hot_key_only(spark):
    from civicscan.operators.joins import SALTS, hot_keys, salted_lookup
    rows = skewed(spark)
    table = spark.range(3000).select(F.concat(F.lit("k"), "id").alias("url"), F.lit("d").alias("d")).unionByName(
        spark.createDataFrame([("hot", "d1"), ("unused", "d3")], "url string, d string"))
    assert hot_keys(rows, "url") == ["hot"]
    no_broadcast(spark)
    try:
        got = salted_lookup(rows, table, "url")
        want = rows.join(table, "url", "left")
        assert sorted(map(str, got.select("id", "url", "d").collect())) == sorted(map(str, want.select("id", "url", "d").collect()))
        sizes = sorted(r["count"] for r in got.groupBy(F.spark_partition_id().alias("p")).count().collect())
        assert len(sizes) == 8 and sizes[-1] < 0.4 * 6000      # the plain join puts over 75 % in one task
        # copies grow with the hot keys only
        plan = got._jdf.queryExecution().optimizedPlan()
        assert "Generate explode" in plan.toString()
        copies = table.withColumn("s", F.explode(F.when(F.col("url") == "hot", F.sequence(F.lit(1), F.lit(SALTS))).otherwise(F.array(F.lit(0)))))
        assert copies.count() == table.count() + SALTS - 1
        even = rows.filter("url <> 'hot'")
        assert hot_keys(even, "url") == [] and "Generate" not in salted_lookup(even, table, "url")._jdf.queryExecution().optimizedPlan().toString()
        assert hot_keys(rows.limit(0), "url") == [] and salted_lookup(rows.limit(0), table, "url").count() == 0
    finally:
        usual(spark)


def test_shared_folder_is_required_beyond_one_machine():
    import types

    import pytest as pt

    from civicscan.session import checkpoint_dir
    sc = types.SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: None)
    fake = types.SimpleNamespace(conf=types.SimpleNamespace(get=lambda k, d=None: None), sparkContext=sc)
    with pt.raises(ValueError):
        checkpoint_dir(fake)
