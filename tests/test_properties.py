"""Property tests (hypothesis) against small Python models, and invariants."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from civicscan.functions import dates as D
from civicscan.operators import feed
from civicscan.plans.catalog import QUERIES
from conftest import SF_SMALL

SETTINGS = settings(max_examples=25, deadline=None, suppress_health_check=list(HealthCheck))

field = st.text(alphabet="abcUS#x0123456789.-", max_size=6)
record = st.lists(field, min_size=0, max_size=8).map(lambda xs: "#".join(xs))
loc_list = st.one_of(st.none(), st.lists(record, max_size=5).map(lambda rs: ";".join(rs)))


def model_unnest(v):
    if v is None:
        return []
    out = []
    for rec in v.split(";"):
        p = rec.split("#")
        get = lambda i: p[i] if i < len(p) else None
        if get(2) != "US":
            continue

        def num(x, kind):
            try:
                if kind is int:
                    return int(x) if x is not None and x.strip().lstrip("+-").isdigit() else None
                return float(x) if x not in (None, "") else None
            except ValueError:
                return None
        out.append((num(get(0), int), get(1), get(2), get(3), get(5), get(6)))
    return out


@SETTINGS
@given(st.lists(loc_list, min_size=1, max_size=6))
def test_unnest_matches_model(spark, lists):
    rows = [(i, 20240101000000, dt.date(2024, 1, 1), f"https://x/boil-water-{i}", "s", v)
            for i, v in enumerate(lists)]
    df = spark.createDataFrame(rows, "event_id long, gkg_date long, partition_date date, "
                                     "document_identifier string, source_common_name string, v2locations string")
    got = sorted((r.location_type, r.location_fullname, r.country_code, r.adm1_code)
                 for r in feed.us_locations(df).collect())
    want = sorted((t, n, c, a) for v in lists for (t, n, c, a, _, _) in model_unnest(v))
    assert got == want


@SETTINGS
@given(st.lists(st.one_of(st.none(), st.text(alphabet="abBOILwater-dvisoryNtce", max_size=20)), max_size=12))
def test_keyword_split_partitions_input(spark, links):
    df = spark.createDataFrame([(x,) for x in links], "link string")
    inc = feed.keyword_include(df).count()
    exc = feed.keyword_exclude(df).count()
    assert inc + exc == len(links)


MONTHS = ["January", "February", "March", "April", "May", "June", "July", "August", "September",
          "October", "November", "December"]


@SETTINGS
@given(st.dates(min_value=dt.date(1990, 1, 1), max_value=dt.date(2035, 12, 31)),
       st.sampled_from(["iso", "isotime", "compact", "us", "long", "abbr", "dmy", "rfc"]))
def test_date_ladder_round_trip(spark, d, style):
    text = {
        "iso": d.isoformat(),
        "isotime": f"{d.isoformat()}T10:20:30+02:00",
        "compact": d.strftime("%Y%m%d"),
        "us": f"{d.month}/{d.day}/{d.year}",
        "long": f"{MONTHS[d.month - 1]} {d.day}, {d.year}",
        "abbr": f"Updated {MONTHS[d.month - 1][:3]}. {d.day} {d.year} by staff",
        "dmy": f"{d.day} {MONTHS[d.month - 1]} {d.year}",
        "rfc": d.strftime("%a, %d %b %Y 07:28:00 GMT"),
    }[style]
    got = spark.createDataFrame([(text,)], "s string").select(D.parse_date("s").alias("d")).collect()[0].d
    assert got == d, text


def test_repartitioning_does_not_change_results(spark):
    from tools.oracle_check import rows_of
    for name in ["feed_first_location", "page_dates", "utility_notices", "advisories_strict"]:
        a = QUERIES[name](spark, SF_SMALL)
        spark.conf.set("spark.sql.shuffle.partitions", "3")
        try:
            b = QUERIES[name](spark, SF_SMALL)
            assert rows_of(a.columns, a.collect()) == rows_of(b.columns, b.collect()), name
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_year_counts_bounded_by_feed(spark):
    total = sum(r.n for r in QUERIES["counts_by_year"](spark, SF_SMALL).collect())
    assert 0 < total <= QUERIES["feed_first_location"](spark, SF_SMALL).count()


def test_at_most_one_best_date_per_page(spark):
    df = QUERIES["page_dates"](spark, SF_SMALL)
    assert df.count() == df.select("page_id").distinct().count()


WORDS = st.text(alphabet="abcdefghij ", min_size=0, max_size=90)


@st.composite
def html_tree(draw, depth=0):
    tags = ["div", "section", "article", "main", "p", "span", "a", "script", "form"]
    parts = []
    for _ in range(draw(st.integers(0, 3 if depth < 3 else 0))):
        if draw(st.booleans()):
            parts.append(draw(WORDS))
        else:
            tag = draw(st.sampled_from(tags))
            inner = draw(html_tree(depth + 1)) if tag not in ("script",) else draw(WORDS)
            attr = ' href="/x"' if tag == "a" else ""
            parts.append(f"<{tag}{attr}>{inner}</{tag}>")
    return "".join(parts)


@settings(max_examples=30, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(html_tree(), min_size=1, max_size=4))
def test_best_container_matches_tree_model(spark, bodies):
    import re

    from civicscan.operators import articles
    from test_articles import brute_best
    pages = [(i, f"u{i}", f"<html><body>{b}</body></html>", 200) for i, b in enumerate(bodies)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string, status_code int")
    got = {r.page_id: r.text for r in articles.best_containers(df).collect()}
    for i, _, html, _ in pages:
        want = brute_best(html)
        want = re.sub(r"\n{2,}", "\n\n", want).strip() if want else None
        assert got.get(i) == want, html


cand = st.tuples(st.sampled_from(["published", "updated"]), st.sampled_from([40, 50, 68, 70, 90, 100]),
                 st.dates(min_value=dt.date(2000, 1, 1), max_value=dt.date(2030, 12, 31)))


@SETTINGS
@given(st.lists(cand, max_size=8))
def test_best_date_matches_sort_model(spark, cands):
    from civicscan.operators import dates as X
    rows = [(k, w, str(d), d, "s", i) for i, (k, w, d) in enumerate(cands)]
    df = spark.createDataFrame([(rows,)], "c array<struct<kind:string,weight:int,raw:string,dt:date,source:string,ord:bigint>>")
    r = df.select(X.best(F.col("c"), "published").alias("p"), X.best(F.col("c"), "updated").alias("u"),
                  X.best(F.col("c"), "published", tie="lexical").alias("pl")).collect()[0]

    def pick(kind, key):
        mine = [x for x in rows if x[0] == kind]
        return min(mine, key=key)[3] if mine else None
    assert r.p == pick("published", lambda x: (-x[1], x[3], x[5]))
    assert r.u == pick("updated", lambda x: (-x[1], -x[3].toordinal(), x[5]))
    assert r.pl == pick("published", lambda x: (-x[1], x[3].strftime("%m/%d/%Y"), x[5]))


NOISE_KEYS = st.sampled_from(["x", "y", "@graph", "date", "published", "author"])
LEAF = st.one_of(st.none(), st.booleans(), st.integers(0, 9), st.text(alphabet="0123456789-", max_size=10))
NOISE = st.recursive(LEAF, lambda kids: st.one_of(st.lists(kids, max_size=3), st.dictionaries(NOISE_KEYS, kids, max_size=4)), max_leaves=10)
SPELLINGS = {"published": ["datePublished", "DATEPUBLISHED", "uploadDate"], "updated": ["dateModified", "Updated", "updated"]}


@settings(max_examples=200, deadline=None)
@given(st.data())
def test_jsonld_dates_are_found_where_they_were_put(data):
    """One hit per kind is put at a known place: below noise, beside noise,
    and ahead of later or deeper hits that must lose."""
    from civicscan.operators import dates as X
    want = {}
    item = {"head": data.draw(NOISE)}
    for kind, names in SPELLINGS.items():
        if data.draw(st.booleans()):
            value = data.draw(st.one_of(st.integers(1900, 2100), st.text(alphabet="0123456789-", min_size=1, max_size=10)))
            want[kind] = str(value)
            hit = {data.draw(st.sampled_from(names)): value}
            loser = {data.draw(st.sampled_from(names)): "late"}
            if data.draw(st.booleans()):  # own keys come before children, wherever they are written
                item = {"child": loser, "noise": data.draw(NOISE), **item, **hit} if item.keys().isdisjoint(hit) else {**hit, "rest": item}
            else:  # the first child in document order
                item = {"n": data.draw(NOISE), "a": [data.draw(NOISE), {"b": hit}], "c": loser, "rest": item}
    depth = data.draw(st.integers(0, 4))
    for i in range(depth):
        item = {"wrap": [item]} if i % 2 else {"p": data.draw(LEAF), "wrap": item}
    assert X.first_dates(item) == (want.get("published"), want.get("updated"))
