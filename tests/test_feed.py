"""Golden micro-cases for the news-feed and trend operators."""

import datetime as dt


from civicscan import schemas
from civicscan.operators import feed, trends

GKG_SCHEMA = ("event_id long, gkg_date long, partition_date date, document_identifier string, "
              "source_common_name string, v2locations string")


def gkg(spark, rows):
    return spark.createDataFrame(rows, GKG_SCHEMA)


def test_unnest_edge_rows(spark):
    d = dt.date(2024, 1, 1)
    df = gkg(spark, [
        (1, 20240102030405, d, "https://x/Boil-Water", "x", None),                 # null list
        (2, 20240102030405, d, "https://x/boil-water", "x", ""),                   # empty list
        (3, 20240102030405, d, "https://x/boil-water", "x", "2#Short"),            # short record
        (4, 20240102030405, d, "https://x/boil-water", "x", "x#A#US#USOH##bad#1.5"),  # bad type/lat
        (5, 20240102030405, d, "https://x/water-boil", "x", "1#US#US#US##1#2"),    # wrong word order
        (6, 20240102030405, dt.date(2012, 12, 31), "https://x/boil-water", "x", "1#US#US#US##1#2"),
    ])
    out = feed.us_locations(df).collect()
    assert len(out) == 1
    r = out[0]
    assert r.location_type is None and r.latitude is None and r.longitude == 1.5
    assert r.adm1_code == "USOH" and r.publish_time == dt.datetime(2024, 1, 2, 3, 4, 5)


def test_keep_first_is_total_order(spark):
    d = dt.date(2024, 1, 1)
    df = gkg(spark, [
        (1, 20240102030405, d, "https://x/boil-water", "b", "3#B#US#USVA##1#2;2#A#US#USTX##1#2"),
        (2, 20230102030405, d, "https://x/boil-water", "a", "1#C#US#US##1#2"),
    ])
    first = feed.first_per_link(feed.us_locations(df)).collect()
    assert len(first) == 1 and first[0].location_fullname == "C"


def test_keyword_split_is_a_partition(spark):
    df = spark.createDataFrame([("a-BOIL-WATER",), ("plain",), (None,), ("x-Order",)], "link string")
    inc = {r.link for r in feed.keyword_include(df).collect()}
    exc = {r.link for r in feed.keyword_exclude(df).collect()}
    assert inc == {"a-BOIL-WATER", "x-Order"}
    assert exc == {"plain", None}


def test_non_country_keeps_null_types(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "location_type long")
    assert sorted(r.location_type or 0 for r in trends.non_country_rows(df).collect()) == [0, 2]


def test_state_lookup_and_quarantine(spark):
    df = spark.createDataFrame([("USPR",), ("US",), ("USZZ",), (None,)], "adm1_code string")
    st = schemas.state_names(spark)
    got = {(r.state_code, r.state) for r in trends.lookup_state(df, st).collect()}
    assert ("PR", "Puerto Rico PR") in got and ("", None) in got
    bad = {r.state_code for r in trends.unknown_states(df, st).collect()}
    assert bad == {"", "ZZ", None}


def test_dense_years(spark):
    df = spark.createDataFrame([(dt.datetime(2016, 5, 1),), (dt.datetime(2016, 7, 1),),
                                (dt.datetime(2013, 1, 1),)], "publish_time timestamp_ntz")
    out = [(r.year, r.n) for r in trends.counts_by_year(df).collect()]
    assert len(out) == 11 and out[1] == (2016, 2) and sum(n for _, n in out) == 2


def test_plan_shapes(spark):
    from civicscan.plans.catalog import QUERIES
    sf = "/root/testdata/sf0.001"
    k1 = QUERIES["feed_us_locations"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in k1 and "EvalPython" not in k1
    first = QUERIES["feed_first_location"](spark, sf)
    plan = first._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
    look = QUERIES["state_lookup"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in look


def test_partition_pruning(spark, tmp_path):
    d = dt.date
    df = gkg(spark, [(i, 20240102030405, d(2012 + i % 3, 1, 1), "https://x/boil-water", "x",
                      "1#US#US#US##1#2") for i in range(6)])
    path = str(tmp_path / "gkg")
    df.write.partitionBy("partition_date").parquet(path)
    from civicscan.sources.tables import read_partitioned
    scanned = feed.us_locations(read_partitioned(spark, path), end="2013-12-31")
    plan = scanned._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(partition_date" in plan
    assert scanned.count() == 2


def test_feed_and_trend_plans_stay_in_the_jvm(spark):
    from civicscan.plans.catalog import QUERIES
    names = ["feed_us_locations", "feed_first_location", "feed_keyword_include", "feed_keyword_exclude",
             "feed_excluded_count", "location_type_counts", "non_country_rows", "state_lookup",
             "state_lookup_unknown", "counts_by_year", "counts_by_state", "counts_by_state_year",
             "state_map_table", "state_extent", "news_head"]
    for n in names:
        plan = QUERIES[n](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
        assert "EvalPython" not in plan and "PythonUDF" not in plan, n


def test_hot_link_is_reduced_before_the_shuffle(spark):
    """One link holds a third of all rows: the result is still one row per
    link (the first in the total order), and the plan cuts each map task's
    share of the hot link to one row before the exchange."""
    d = dt.date(2024, 1, 1)
    rows = []
    for i in range(3000):
        link = "https://x/boil-water-HOT" if i % 3 == 0 else f"https://x/boil-water-{i}"
        rows.append((i, 20240101000000 + (i % 50), d, link, f"s{i % 7}", f"{1 + i % 3}#P{i % 11}#US#USVA##1#2"))
    df = spark.createDataFrame(rows, GKG_SCHEMA).repartition(6)
    first = feed.first_per_link(feed.us_locations(df))
    got = {r.link: r for r in first.collect()}
    assert len(got) == 1 + 2000
    hot = got["https://x/boil-water-HOT"]
    assert (hot.publish_time, hot.location_type, hot.location_fullname) == (
        dt.datetime(2024, 1, 1, 0, 0, 0), 1, "P0")
    plan = first._jdf.queryExecution().executedPlan().toString()
    partial = plan.index("WindowGroupLimit")            # the final limit sits above the exchange
    assert "Partial" in plan[plan.index("Exchange hashpartitioning(link"):] and partial >= 0
