"""Responses, advisories, composite rows, CSV sinks and the feed stream."""

import os


from civicscan.operators import responses as R
from civicscan.sources import csvio
from conftest import SF_SMALL


def test_advisories_strict_and_lenient(spark):
    df = spark.createDataFrame([
        (1, 'ok {"advisories":[{"type":null,"location":["A","B"],"start_date":"null","end_date":"2024-01-01"}]} bye'),
        (2, '{"advisories": {"x": 1}}'),
        (3, 'no json at all'),
        (4, "{advisories:[{type:'E',location:'C',},],}"),
        (5, '{"a":1} and {"b":2}'),
    ], "doc_id long, response string")
    strict = R.advisories(df).collect()
    assert [(r.doc_id, r.type, r.location, r.start_date, r.end_date) for r in strict] == [(1, "", "A, B", "", "2024-01-01")]
    bad = {r.doc_id: r.reason for r in R.advisories_rejected(df).collect()}
    assert bad == {2: "no_advisories", 3: "no_json", 4: "invalid_json", 5: "invalid_json"}
    lenient = {(r.doc_id, r.location) for r in R.advisories(df, lenient=True).collect()}
    assert (4, "C") in lenient


def test_extras_override(spark):
    advs = spark.createDataFrame([(1, "E", "X", "", "", "from-model")],
                                 "doc_id long, type string, location string, start_date string, end_date string, publish_date string")
    extras = spark.createDataFrame([(1, "01/02/2024", "C", "S", "L")],
                                   "doc_id long, publish_date string, county string, state string, link string")
    r = R.advisory_rows(advs, extras, ["doc_id"]).collect()[0]
    assert r.publish_date == "01/02/2024" and r.summary == "" and r.doc_id == 1


def test_csv_round_trip_and_append(spark, tmp_path):
    from civicscan.plans.catalog import QUERIES
    df = QUERIES["utility_notices"](spark, SF_SMALL)
    path = str(tmp_path / "notices")
    csvio.write_csv(df, path)
    schema = "utility_id long, year long, county string, state string, link string, snippet string, publish_date string"
    back = csvio.read_csv(spark, path, schema).na.fill("")   # '' reads back as null
    want = csvio.for_csv(df)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, want.collect()))
    csvio.append_csv(df, path)
    assert csvio.read_csv(spark, path, schema).count() == 2 * df.count()


def test_write_by_year_replaces_only_present_years(spark, tmp_path):
    path = str(tmp_path / "years")
    a = spark.createDataFrame([(2020, "x"), (2021, "y")], "year int, v string")
    csvio.write_by_year(a, path)
    csvio.write_by_year(spark.createDataFrame([(2021, "z")], "year int, v string"), path)
    got = sorted((r.year, r.v) for r in spark.read.option("header", True).csv(path).collect())
    assert got == [(2020, "x"), (2021, "z")]


def test_utility_master_build(spark, tmp_path):
    from civicscan.plans.notices import build_utility_master
    from civicscan.sources import fixtures
    u = fixtures.load(spark, SF_SMALL, "fx_utilities").selectExpr(
        "pwsid AS PWSID", "state_code AS STATE_CODE", "county_fips AS COUNTYFIPS",
        "county_name AS `County Name`", "population_served_count AS POPULATION_SERVED_COUNT")
    x = fixtures.load(spark, SF_SMALL, "fx_crosswalk").selectExpr("county_fips AS COUNTYFIPS", "county_label", "county_class")
    u.write.option("header", True).csv(str(tmp_path / "u"))
    x.write.option("header", True).csv(str(tmp_path / "x"))
    master = build_utility_master(spark, str(tmp_path / "u"), str(tmp_path / "x"), str(tmp_path / "m"))
    want = u.join(x, "COUNTYFIPS").count()
    assert master.count() == want > 0
    back = spark.read.option("header", True).csv(str(tmp_path / "m"))
    assert back.count() == want and "County Name" in back.columns and "county_class" in back.columns


def test_final_url_wins(spark):
    from civicscan.operators import dates as X
    pages = spark.createDataFrame(
        [(1, "http://a", "http://b", 200, None, '<meta name="date" content="2020-02-03">')],
        "page_id long, url string, final_url string, status_code int, http_last_modified string, html string")
    r = X.page_dates(pages).collect()[0]
    assert r.url == "http://b" and str(r.published) == "2020-02-03"


def test_cli_runs_a_job_and_writes_csv(spark, tmp_path):
    from civicscan.__main__ import main
    out = str(tmp_path / "years")
    assert main(["run", "counts_by_year", "--data", SF_SMALL, "--out", out]) == 0
    back = spark.read.option("header", True).schema("year long, n long").csv(out)
    assert back.count() == 11
    assert main(["run", "no_such_job", "--data", SF_SMALL, "--out", out]) == 2


def test_news_csv_hand_off_to_trends(spark, tmp_path):
    """Feed report -> CSV -> trend job reads it back (S6 then S4), same counts."""
    from civicscan import schemas
    from civicscan.operators import feed, trends
    from civicscan.plans.catalog import QUERIES
    path = str(tmp_path / "news")
    news = QUERIES["feed_first_location"](spark, SF_SMALL)
    csvio.write_csv(news, path)
    back = csvio.read_news_csv(spark, path)
    assert back.count() == news.count()
    direct = [(r.year, r.n) for r in QUERIES["counts_by_year"](spark, SF_SMALL).collect()]
    via_csv = [(r.year, r.n) for r in trends.counts_by_year(
        trends.non_country_rows(feed.keyword_include(back))).collect()]
    assert via_csv == direct
    states = schemas.state_names(spark)
    assert trends.lookup_state(trends.non_country_rows(back), states).count() == \
        QUERIES["non_country_rows"](spark, SF_SMALL).count() + \
        feed.keyword_exclude(trends.non_country_rows(back)).count()


def test_page_dates_stream_matches_batch(spark, tmp_path):
    from pyspark.sql import functions as F

    from civicscan.plans.catalog import QUERIES
    from civicscan.sources import fixtures
    from civicscan.streaming.page_dates_stream import run_page_dates_stream
    src = str(tmp_path / "pages")
    pages = fixtures.load(spark, SF_SMALL, "fx_pages").withColumn("final_url", F.lit(None).cast("string"))
    pages.where("page_id % 2 = 0").write.parquet(src)
    sink, ckpt = str(tmp_path / "out"), str(tmp_path / "ckpt")
    run_page_dates_stream(spark, src, sink, ckpt).awaitTermination(300)
    pages.where("page_id % 2 = 1").write.mode("append").parquet(src)      # new files arrive
    run_page_dates_stream(spark, src, sink, ckpt).awaitTermination(300)
    got = sorted(map(tuple, spark.read.parquet(sink).collect()))
    want = sorted(map(tuple, QUERIES["page_dates"](spark, SF_SMALL).collect()))
    assert got == want


def test_notice_reports_share_one_materialized_date_table(spark):
    from civicscan.plans import notices
    from civicscan.plans.catalog import QUERIES, fx
    from tools.oracle_check import rows_of
    k5, k7 = notices.notice_reports(fx(spark, SF_SMALL, "fx_utilities"), fx(spark, SF_SMALL, "fx_search_log"),
                                    fx(spark, SF_SMALL, "fx_news_log"), fx(spark, SF_SMALL, "fx_crawl"),
                                    fx(spark, SF_SMALL, "fx_summary_llm"))
    for got, name in [(k5, "utility_notices"), (k7, "summary_advisories")]:
        want = QUERIES[name](spark, SF_SMALL)
        assert rows_of(got.columns, got.collect()) == rows_of(want.columns, want.collect())
        assert "html" not in got._jdf.queryExecution().executedPlan().toString()    # no page is read again


def test_url_dates_keyed_by_requested_url(spark):
    from civicscan.plans.notices import dates_by_url
    crawl = spark.createDataFrame(
        [(1, "http://asked", "http://redirected", 200, None, '<meta name="date" content="2020-02-03">')],
        "page_id long, url string, final_url string, status_code int, http_last_modified string, html string")
    r = dates_by_url(crawl).collect()[0]
    assert (r.url, r.published) == ("http://asked", "02/03/2020")


def test_text_with_quotes_commas_and_line_breaks_survives_every_sink(spark, tmp_path):
    from civicscan.sources import csvio
    rows = [(2020, 'say "hi", x', "a,b"), (2020, "two\nlines", '""'), (2021, "", "plain"), (2021, 'end"', "\\ back")]
    df = spark.createDataFrame(rows, "year int, v string, w string")
    csvio.write_csv(df, str(tmp_path / "all"))
    csvio.write_by_year(df, str(tmp_path / "years"))
    want = sorted(rows)
    for name, columns in (("all", "year int, v string, w string"), ("years", "v string, w string, year int")):
        back = csvio.read_csv(spark, str(tmp_path / name), columns, multi_line=True).na.fill("").select("year", "v", "w")
        assert sorted(tuple(r) for r in back.collect()) == want, name


def test_items_of_another_kind_are_quarantined(spark):
    from civicscan.operators import responses as R
    rows = [(1, '{"advisories":[{"type":"E","location":["a","b"]},"none"]}'), (2, '{"advisories":["x",null]}'), (3, '{"advisories":[]}'),
            (4, '{"advisories":{"type":"E"}}'), (5, "no json")]
    df = spark.createDataFrame(rows, "doc_id long, response string")
    for lenient in (False, True):
        got = R.advisories(df, lenient=lenient).collect()
        assert [(r.doc_id, r.adv_pos, r.type, r.location) for r in got] == [(1, 1, "E", "a, b")]
        bad = {(r.doc_id, r.reason) for r in R.advisories_rejected(df, lenient=lenient).collect()}
        assert bad == {(1, "item_not_object"), (2, "item_not_object"), (4, "no_advisories"), (5, "no_json")}
    body = '{"data":{"webPages":{"value":["odd",{"url":"u","snippet":"s"},null]}}}'
    found = R.nested_results(spark.createDataFrame([(1, body)], "doc_id long, body string")).collect()
    assert [(r.rank, r.url, r.snippet) for r in found] == [(2, "u", "s")]


def test_one_answer_per_request(spark):
    from civicscan.operators import responses as R
    log = spark.createDataFrame([("q", "<html>"), ("q", '{"items":[2]}'), ("q", '{"items":[1]}'), ("r", "<b>"), ("r", "<a>"), ("s", None)],
                                "query string, body string")
    got = {r.query: r.body for r in R.one_answer(log, "query", "body", R.FLAT_PATH).collect()}
    assert got == {"q": '{"items":[1]}', "r": "<a>", "s": None}


def test_state_geometry_input(spark, tmp_path):
    from civicscan import schemas
    from civicscan.operators import trends
    from civicscan.sources import tables
    geo = [("Virginia", -83.0, 36.5, -75.0, 39.5, -79.0, 38.0), ("Texas", -106.0, 25.8, -93.5, 36.5, -99.0, 31.0)]
    path = str(tmp_path / "geo")
    spark.createDataFrame(geo, tables.STATE_GEO_SCHEMA).write.parquet(path)
    table = tables.read_state_geo(spark, path)
    states = schemas.state_names(spark)
    counts = states.selectExpr("name AS state").crossJoin(spark.range(2020, 2021).withColumnRenamed("id", "year")).selectExpr("year", "state", "1L AS n")
    rows = {r.name: (r.cx, r.cy) for r in trends.state_map_table(counts, table, states).collect()}
    assert rows["Virginia"] == (-79.0, 38.0) and rows["Ohio"] == (None, None)
    assert trends.state_extent(table).first().minx == -106.0


def test_logs_keep_every_answer(spark):
    from pyspark.sql import functions as F

    from civicscan.plans.catalog import fx
    search = fx(spark, SF_SMALL, "fx_search").select("doc_id", "body")
    utilities = fx(spark, SF_SMALL, "fx_utilities").select("utility_id")
    asked = search.join(utilities, F.expr("utility_id = floor(doc_id / 6)"))
    assert fx(spark, SF_SMALL, "fx_search_log").count() == asked.count()
    assert fx(spark, SF_SMALL, "fx_news_log").count() == search.join(utilities, F.expr("utility_id = doc_id")).count()
    log = fx(spark, SF_SMALL, "fx_summary_llm")
    assert log.count() == 2 * search.count()
    assert log.filter("input_text = 't'").count() == search.count()


def _parts_on_disk(path):
    return [f for _, _, files in os.walk(path) for f in files if f.startswith("part-")]


def test_a_run_counts_once(spark, tmp_path):
    path, schema = str(tmp_path / "table"), "id long, v string"
    rows = [(i, f"two\nlines, {i}") for i in range(20)]
    df = spark.createDataFrame(rows, schema).repartition(4)
    assert csvio.read_runs(spark, path, schema).collect() == []
    assert csvio.append_run(df.where("id < 10"), path, "2025/01")
    assert not csvio.append_run(df.where("id < 10"), path, "2025/01")       # a retry after the end
    assert csvio.append_run(df.where("id >= 10"), path, "2025/02")
    assert sorted(map(tuple, csvio.read_runs(spark, path, schema, multi_line=True).collect())) == rows
    assert csvio.append_run(df.limit(0), path, "empty")                      # a run without rows is a run
    assert csvio.read_runs(spark, path, schema, multi_line=True).count() == 20


def test_an_attempt_that_dies_between_files_adds_nothing(spark, tmp_path, monkeypatch):
    import pytest

    from civicscan.sources import runs
    path, schema = str(tmp_path / "table"), "id long, v string"
    rows = [(i, "x") for i in range(8)]
    df = spark.createDataFrame(rows, schema).repartition(4)
    with monkeypatch.context() as m:                                         # all files written, the end not reached
        def lost(*_):
            raise ConnectionError("lost")
        m.setattr(runs, "commit", lost)
        with pytest.raises(ConnectionError):
            csvio.append_run(df, path, "a")
    dies = df.where("id < 7").selectExpr("id", "if(id = 5, raise_error('lost'), v) AS v")
    with pytest.raises(Exception, match="lost"):                             # some files written
        csvio.append_run(dies, path, "a")
    assert _parts_on_disk(path) and csvio.read_runs(spark, path, schema).count() == 0
    assert csvio.append_run(df, path, "a")
    assert sorted(map(tuple, csvio.read_runs(spark, path, schema).collect())) == rows


def test_of_two_attempts_at_once_the_first_to_end_counts(spark, tmp_path, monkeypatch):
    from civicscan.sources import runs
    path, schema = str(tmp_path / "table"), "id long, v string"
    df = spark.createDataFrame([(1, "x")], schema)
    monkeypatch.setattr(runs, "is_committed", lambda *_: False)              # neither sees the other
    assert csvio.append_run(df, path, "a") and not csvio.append_run(df, path, "a")
    assert csvio.read_runs(spark, path, schema).count() == 1
