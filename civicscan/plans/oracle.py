"""DuckDB oracle texts, one per catalog entry that SQL can express.

Written independently of the Spark operators, over the driver tables
(pre-registered DuckDB views) through the same fixture views.  Column names
match the Spark outputs exactly.
"""

from __future__ import annotations

from .. import schemas
from ..sources.fixtures import duckdb_ctes, duckdb_text

ORACLE: dict[str, str] = {}


def _sql_str(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _values(rows, cols) -> str:
    body = ", ".join("(" + ", ".join(_sql_str(v) if isinstance(v, str) else str(v) for v in r) + ")"
                     for r in rows)
    return f"(SELECT * FROM (VALUES {body}) AS t({', '.join(cols)}))"


STATES_SQL = (f"(SELECT abbreviation, name, regexp_replace(name, ' [A-Z]{{2}}$', '') AS geo_name "
              f"FROM {_values(schemas.STATE_NAMES, ['abbreviation', 'name'])})")

KEYWORD_RE = "(?i)" + "|".join(schemas.NOTICE_KEYWORDS)

# ---------------------------------------------------------------- feed CTEs

FEED_CTES = duckdb_ctes("fx_gkg") + f""",
k1_candidates AS (
  SELECT CAST(try_strptime(CAST(gkg_date AS VARCHAR), '%Y%m%d%H%M%S') AS TIMESTAMP) AS publish_time,
         document_identifier AS link, source_common_name AS source, v2locations
  FROM fx_gkg
  WHERE partition_date BETWEEN DATE '2013-01-01' AND current_date
    AND lower(document_identifier) LIKE '%boil%water%'),
k1_expanded AS (
  SELECT publish_time, link, source, unnest(string_split(v2locations, ';')) AS loc_raw FROM k1_candidates),
k1_parsed AS (
  SELECT publish_time, link, source,
         try_cast(string_split(loc_raw, '#')[1] AS BIGINT) AS location_type,
         string_split(loc_raw, '#')[2] AS location_fullname,
         string_split(loc_raw, '#')[3] AS country_code,
         string_split(loc_raw, '#')[4] AS adm1_code,
         try_cast(string_split(loc_raw, '#')[6] AS DOUBLE) AS latitude,
         try_cast(string_split(loc_raw, '#')[7] AS DOUBLE) AS longitude
  FROM k1_expanded),
k1 AS (SELECT * FROM k1_parsed WHERE country_code = 'US'),
k1_first AS (
  SELECT publish_time, link, source, location_type, location_fullname, country_code, adm1_code, latitude, longitude
  FROM (SELECT *, row_number() OVER (PARTITION BY link ORDER BY publish_time NULLS LAST,
        location_type NULLS LAST, location_fullname NULLS LAST, source NULLS LAST, adm1_code NULLS LAST,
        latitude NULLS LAST, longitude NULLS LAST, country_code NULLS LAST) AS rn FROM k1) r
  WHERE rn = 1),
notice AS (SELECT * FROM k1_first WHERE coalesce(regexp_matches(link, '{KEYWORD_RE}'), false)),
nontype1 AS (SELECT * FROM notice WHERE location_type IS DISTINCT FROM 1),
located AS (
  SELECT n.*, substring(n.adm1_code, 3) AS state_code, s.name AS state
  FROM nontype1 n LEFT JOIN {STATES_SQL} s ON substring(n.adm1_code, 3) = s.abbreviation),
known AS (SELECT * FROM located WHERE state IS NOT NULL),
geo AS (
  SELECT s.geo_name AS name, min(k.longitude) AS minx, min(k.latitude) AS miny,
         max(k.longitude) AS maxx, max(k.latitude) AS maxy
  FROM known k JOIN {STATES_SQL} s ON k.state = s.name
  WHERE k.latitude IS NOT NULL AND k.longitude IS NOT NULL
    AND s.abbreviation NOT IN ({", ".join(_sql_str(x) for x in schemas.MAP_NO_GEOMETRY)})
  GROUP BY s.geo_name),
geo2 AS (SELECT *, (minx + maxx) / 2 AS cx, (miny + maxy) / 2 AS cy FROM geo),
years AS (SELECT CAST(range AS BIGINT) AS year FROM range({schemas.TREND_YEARS[0]}, {schemas.TREND_YEARS[1] + 1})),
state_year AS (
  SELECT y.year, s.name AS state,
         CAST(coalesce((SELECT count(*) FROM known k WHERE year(k.publish_time) = y.year AND k.state = s.name), 0) AS BIGINT) AS n
  FROM years y, {STATES_SQL} s)
"""

K1_COLS = ("publish_time, link, source, location_type, location_fullname, country_code, "
           "adm1_code, latitude, longitude")

ORACLE["feed_us_locations"] = FEED_CTES + f"SELECT {K1_COLS} FROM k1"
ORACLE["feed_first_location"] = FEED_CTES + f"SELECT {K1_COLS} FROM k1_first"
ORACLE["feed_keyword_include"] = FEED_CTES + f"SELECT {K1_COLS} FROM notice"
ORACLE["feed_keyword_exclude"] = FEED_CTES + (
    f"SELECT {K1_COLS} FROM k1_first WHERE NOT coalesce(regexp_matches(link, '{KEYWORD_RE}'), false)")
ORACLE["feed_excluded_count"] = FEED_CTES + (
    f"SELECT count(*) AS n_excluded FROM k1_first "
    f"WHERE NOT coalesce(regexp_matches(link, '{KEYWORD_RE}'), false)")

ORACLE["location_type_counts"] = FEED_CTES + (
    "SELECT count(*) FILTER (WHERE location_type = 1) AS n_type1, "
    "count(*) FILTER (WHERE location_type = 2) AS n_type2, "
    "count(*) FILTER (WHERE location_type = 3) AS n_type3 FROM notice")
ORACLE["non_country_rows"] = FEED_CTES + f"SELECT {K1_COLS} FROM nontype1"
ORACLE["state_lookup"] = FEED_CTES + f"SELECT state_code, {K1_COLS}, state FROM located"
ORACLE["state_lookup_unknown"] = FEED_CTES + (
    f"SELECT substring(adm1_code, 3) AS state_code, {K1_COLS} FROM nontype1 "
    f"WHERE substring(adm1_code, 3) IS NULL OR substring(adm1_code, 3) NOT IN "
    f"(SELECT abbreviation FROM {STATES_SQL} s)")
ORACLE["counts_by_year"] = FEED_CTES + (
    "SELECT y.year, CAST(count(n.link) AS BIGINT) AS n FROM years y "
    "LEFT JOIN nontype1 n ON year(n.publish_time) = y.year GROUP BY y.year ORDER BY y.year")
ORACLE["counts_by_state"] = FEED_CTES + (
    "SELECT state, count(*) AS n FROM known GROUP BY state ORDER BY n DESC, state NULLS LAST")
ORACLE["counts_by_state_year"] = FEED_CTES + "SELECT year, state, n FROM state_year"
ORACLE["state_map_table"] = FEED_CTES + (
    "SELECT sy.year, s.geo_name AS name, sy.n, CAST(sy.n AS VARCHAR) AS label, g.cx, g.cy "
    f"FROM state_year sy JOIN {STATES_SQL} s ON sy.state = s.name "
    "LEFT JOIN geo2 g ON g.name = s.geo_name "
    "WHERE s.geo_name NOT IN (" + ", ".join(_sql_str(x) for x in schemas.MAP_EXCLUDED_REGIONS) + ") "
    "AND s.abbreviation NOT IN (" + ", ".join(_sql_str(x) for x in schemas.MAP_NO_GEOMETRY) + ")")
ORACLE["state_extent"] = FEED_CTES + (
    "SELECT minx, miny, maxx, maxy, minx - (maxx - minx) * 0.03 AS xlim_lo, maxx + (maxx - minx) * 0.03 AS xlim_hi, "
    "miny - (maxy - miny) * 0.03 AS ylim_lo, maxy + (maxy - miny) * 0.03 AS ylim_hi FROM ("
    "SELECT min(minx) AS minx, min(miny) AS miny, max(maxx) AS maxx, max(maxy) AS maxy FROM geo2 "
    "WHERE name NOT IN (" + ", ".join(_sql_str(x) for x in schemas.MAP_EXCLUDED_REGIONS) + ")) b")


# ---------------------------------------------------------------- utilities

UTIL_CTES = duckdb_ctes("fx_utilities", "fx_crosswalk")
UTIL_COLS = "utility_id, pwsid, state_code, county_fips, county_name, population_served_count"

ORACLE["utilities_over_threshold"] = UTIL_CTES + f" SELECT {UTIL_COLS} FROM fx_utilities WHERE population_served_count > 5000"
ORACLE["utility_year_requests"] = UTIL_CTES + (
    " SELECT utility_id, county_name AS county, state_code AS state, CAST(y.range AS BIGINT) AS year,"
    " concat('Boil Water Advsiory in ', CAST(y.range AS VARCHAR), ' at ', county_name, ', ', state_code) AS query"
    " FROM fx_utilities, range(2020, 2026) y WHERE population_served_count > 5000")
ORACLE["utility_crosswalk"] = UTIL_CTES + (
    f" SELECT u.county_fips, utility_id, pwsid, state_code, county_name, population_served_count, county_label, county_class"
    f" FROM fx_utilities u JOIN fx_crosswalk c ON u.county_fips = c.county_fips")

_FIXED = ", ".join(str(c) for c in schemas.SAMPLE_FIXED_CODES)
SAMPLE_CTES = UTIL_CTES + f""",
pool AS (SELECT DISTINCT CAST(county_fips AS BIGINT) AS county_fips FROM fx_utilities
         WHERE county_fips BETWEEN 10000 AND 90000 AND county_fips NOT IN ({_FIXED})),
h0 AS (SELECT county_fips, (county_fips + 0 * 2654435761) % 4294967296 AS x FROM pool),
h1 AS (SELECT county_fips, (xor(x, x >> 16) * 73244475) % 4294967296 AS x FROM h0),
h2 AS (SELECT county_fips, (xor(x, x >> 16) * 73244475) % 4294967296 AS x FROM h1),
drawn AS (SELECT county_fips FROM h2 ORDER BY xor(x, x >> 16), county_fips
          LIMIT {schemas.SAMPLE_SIZE - len(schemas.SAMPLE_FIXED_CODES)}),
sample AS (SELECT CAST(c AS BIGINT) AS county_fips, 0 AS drawn FROM unnest([{_FIXED}]) t(c)
           UNION ALL SELECT county_fips, 1 AS drawn FROM drawn)
"""
ORACLE["county_sample"] = SAMPLE_CTES + " SELECT county_fips, drawn FROM sample"
ORACLE["county_first"] = SAMPLE_CTES + (
    " SELECT county_fips, utility_id, pwsid, county, state FROM ("
    " SELECT county_fips, utility_id, pwsid, county_name AS county, left(pwsid, 2) AS state,"
    " row_number() OVER (PARTITION BY county_fips ORDER BY utility_id NULLS LAST) AS rn"
    " FROM fx_utilities WHERE county_fips IN (SELECT county_fips FROM sample)) r WHERE rn = 1")

# ---------------------------------------------------------------- responses

NESTED_CTES = duckdb_ctes("fx_search") + """,
nested_ok AS (SELECT doc_id, CAST(json_extract(body, '$.data.webPages.value') AS JSON[]) AS arr
              FROM fx_search WHERE json_valid(body) AND json_type(body, '$.data.webPages.value') = 'ARRAY'),
nested AS (SELECT * FROM (SELECT doc_id, unnest(arr) AS r, CAST(generate_subscripts(arr, 1) AS BIGINT) AS rank FROM nested_ok) x WHERE json_type(r) = 'OBJECT'),
nested_rows AS (SELECT doc_id, rank, json_extract_string(r, '$.url') AS url,
  json_extract_string(r, '$.displayUrl') AS display_url, json_extract_string(r, '$.snippet') AS snippet,
  json_extract_string(r, '$.summary') AS summary FROM nested)
"""
FLAT_CTES = duckdb_ctes("fx_search_flat") + """,
flat_ok AS (SELECT doc_id, CAST(json_extract(body, '$.items') AS JSON[]) AS arr
            FROM fx_search_flat WHERE json_valid(body) AND json_type(body, '$.items') = 'ARRAY'),
flat AS (SELECT * FROM (SELECT doc_id, unnest(arr) AS r, CAST(generate_subscripts(arr, 1) AS BIGINT) AS rank FROM flat_ok) x WHERE json_type(r) = 'OBJECT'),
flat_rows AS (SELECT doc_id, rank, json_extract_string(r, '$.title') AS title,
  json_extract_string(r, '$.link') AS link, json_extract_string(r, '$.snippet') AS snippet FROM flat)
"""
ORACLE["search_results"] = NESTED_CTES + " SELECT * FROM nested_rows"
ORACLE["search_flat"] = FLAT_CTES + " SELECT * FROM flat_rows WHERE rank <= 5"
ORACLE["search_top_n"] = FLAT_CTES + " SELECT * FROM flat_rows WHERE rank <= 2"
ORACLE["search_urls"] = NESTED_CTES + (
    " SELECT doc_id, CAST(len(objects) AS BIGINT) AS n_urls,"
    " array_to_string([json_extract_string(x, '$.url') for x in objects], chr(10)) AS urls_text"
    " FROM (SELECT doc_id, list_filter(arr, lambda x: json_type(x) = 'OBJECT') AS objects FROM nested_ok) o")
ORACLE["snippet_hits"] = NESTED_CTES + " SELECT * FROM nested_rows WHERE contains(snippet, 'boil')"
ORACLE["verdict_yes"] = duckdb_ctes("fx_llm") + " SELECT doc_id, response FROM fx_llm WHERE contains(response, 'YES')"
ORACLE["prompt_text"] = ("SELECT doc_id, concat('Article text:', chr(10), text, chr(10), chr(10), "
                         "'Extract the advisories as per the schema.') AS prompt FROM documents")

ADV_CTES = duckdb_ctes("fx_llm", "fx_search", "fx_utilities") + """,
adv_j AS (SELECT doc_id, regexp_extract(response, '(?s)\\{.*\\}', 0) AS j FROM fx_llm),
adv_last AS (SELECT doc_id, arg_max(e.value, e.id) AS v FROM (SELECT doc_id, CASE WHEN json_valid(j) THEN j ELSE '{}' END AS j FROM adv_j) o, json_each(o.j) e
   WHERE e.key = 'advisories' GROUP BY doc_id),
adv_checked AS (SELECT a.doc_id, v, CASE WHEN j = '' THEN 'no_json' WHEN NOT json_valid(j) THEN 'invalid_json'
   WHEN coalesce(json_type(v) <> 'ARRAY', true) THEN 'no_advisories' END AS reason FROM adv_j a LEFT JOIN adv_last l ON a.doc_id = l.doc_id),
adv_arr AS (SELECT doc_id, CAST(v AS JSON[]) AS arr FROM adv_checked WHERE reason IS NULL),
adv_all AS (SELECT doc_id, unnest(arr) AS a, CAST(generate_subscripts(arr, 1) AS BIGINT) AS adv_pos FROM adv_arr),
adv_items AS (SELECT * FROM adv_all WHERE json_type(a) = 'OBJECT'),
adv AS (SELECT doc_id, adv_pos,
   coalesce(json_extract_string(a, '$.type'), '') AS type,
   coalesce(CASE WHEN json_type(a, '$.location') = 'ARRAY'
        THEN array_to_string(CAST(json_extract(a, '$.location') AS VARCHAR[]), ', ')
        ELSE json_extract_string(a, '$.location') END, '') AS location,
   CASE WHEN json_extract_string(a, '$.start_date') IS NULL OR json_extract_string(a, '$.start_date') = 'null' THEN '' ELSE json_extract_string(a, '$.start_date') END AS start_date,
   CASE WHEN json_extract_string(a, '$.end_date') IS NULL OR json_extract_string(a, '$.end_date') = 'null' THEN '' ELSE json_extract_string(a, '$.end_date') END AS end_date,
   CASE WHEN json_extract_string(a, '$.publish_date') IS NULL OR json_extract_string(a, '$.publish_date') = 'null' THEN '' ELSE json_extract_string(a, '$.publish_date') END AS publish_date
   FROM adv_items)
"""
ORACLE["advisories_strict"] = ADV_CTES + " SELECT * FROM adv"
ORACLE["advisories_bad"] = ADV_CTES + " SELECT doc_id, reason FROM adv_checked WHERE reason IS NOT NULL UNION ALL SELECT DISTINCT doc_id, 'item_not_object' AS reason FROM adv_all WHERE json_type(a) <> 'OBJECT'"
ORACLE["advisory_report"] = ADV_CTES.replace("WITH ", "WITH ", 1) + """,
nested_ok AS (SELECT doc_id, CAST(json_extract(body, '$.data.webPages.value') AS JSON[]) AS arr
              FROM fx_search WHERE json_valid(body) AND json_type(body, '$.data.webPages.value') = 'ARRAY'),
first_res AS (SELECT doc_id, json_extract_string(arr[1], '$.displayUrl') AS link,
              json_extract_string(arr[1], '$.summary') AS summary FROM nested_ok WHERE len(arr) >= 1),
extras AS (SELECT f.doc_id, f.link, f.summary, u.county_name AS county, u.state_code AS state
           FROM first_res f JOIN fx_utilities u ON u.utility_id = f.doc_id)
SELECT a.doc_id, a.type, a.location, a.start_date, a.end_date, a.publish_date, e.county, e.state, e.link, e.summary
FROM adv a JOIN extras e ON a.doc_id = e.doc_id
"""


# ---------------------------------------------------------------- page dates

from html.entities import html5 as _html5  # noqa: E402
from typing import NamedTuple as _NamedTuple  # noqa: E402

from ..operators import dates as _X  # noqa: E402

# The date twin knows dates by shapes, each a pattern searched for in the whole
# text; the engine folds over tokens.
MONTH_KEYS = "janfebmaraprmayjunjulaugsepoctnovdec"
MONTH_WORD = (r"(jan(?:uary)?|feb(?:ruary)?|mar(?:ch)?|apr(?:il)?|may|june?|july?|aug(?:ust)?"
              r"|sep(?:t(?:ember)?)?|oct(?:ober)?|nov(?:ember)?|dec(?:ember)?)")
_TH = "(?:st|nd|rd|th)?"


class Shape(_NamedTuple):
    pattern: str
    year: int          # groups of the pattern
    month: int
    day: int | None
    named: bool = False     # the month is a name
    either: bool = False    # month first, or day first where that can't be
    bounded: bool = False   # group 1 is what stands before the date


SHAPES = [
    # 2024-01-05, 2024/1/5, 2024.01.05, ISO date-times
    Shape(r"(\d{4})[-/.](\d{1,2})[-/.](\d{1,2})", 1, 2, 3),
    # 20240105, 202401051230, 20240105123000
    Shape(r"(^|[^0-9])(\d{4})(\d{2})(\d{2})(?:\d{4}|\d{6})?([^0-9]|$)", 2, 3, 4, bounded=True),
    # 1/5/2024, 01-05-2024, 1.5.2024, 25/12/2023
    Shape(r"(^|[^0-9])(\d{1,2})[-/.](\d{1,2})[-/.](\d{4})", 4, 2, 3, either=True, bounded=True),
    # 01/05/24
    Shape(r"(^|[^0-9./-])(\d{1,2})[-/](\d{1,2})[-/](\d{2})([^0-9/-]|$)", 4, 2, 3, either=True, bounded=True),
    # January 5, 2024 / Jan. 5th 2024 / Jan-05-2024
    Shape(rf"(?i)\b{MONTH_WORD}\.?[\s-]+(\d{{1,2}}){_TH}(?:,\s*|\s+|-)(\d{{4}})", 3, 1, 2, named=True),
    # Jan  5 12:30:00 2024
    Shape(rf"(?i)\b{MONTH_WORD}\.?\s+(\d{{1,2}})\s+\d{{1,2}}:\d{{2}}(?::\d{{2}})?\s+(?:[A-Z]{{3,4}}\s+)?(\d{{4}})", 3, 1, 2, named=True),
    # Jan 5 '24
    Shape(rf"(?i)\b{MONTH_WORD}\.?\s+(\d{{1,2}}){_TH},?\s+'(\d{{2}})([^0-9]|$)", 3, 1, 2, named=True),
    # 5 January 2024 / 5th of January 2024 / 5-Jan-2024 / Wed, 21 Oct 2015 07:28:00 GMT
    Shape(rf"(?i)\b(\d{{1,2}}){_TH}(?:\s+of)?[\s-]+{MONTH_WORD}\.?,?[\s-]+(\d{{4}})", 3, 2, 1, named=True),
    # Sunday, 06-Nov-94 08:49:37 GMT
    Shape(rf"(?i)\b(\d{{1,2}})[\s-]{MONTH_WORD}[\s-](\d{{2}})([^0-9:]|$)", 3, 2, 1, named=True),
    # Jan 5, 24
    Shape(rf"(?i)\b{MONTH_WORD}\.?\s+(\d{{1,2}}),\s+(\d{{2}})([^0-9:]|$)", 3, 1, 2, named=True),
    # 2024-Jan-05, 2024 January 5
    Shape(rf"(?i)(^|[^0-9])(\d{{4}})[\s-]+{MONTH_WORD}[\s-]+(\d{{1,2}})([^0-9:]|$)", 2, 3, 4, named=True, bounded=True),
    # 05JAN2024
    Shape(rf"(?i)(^|[^0-9])(\d{{1,2}}){MONTH_WORD}(\d{{4}})", 4, 3, 2, named=True, bounded=True),
    # 05.01.24
    Shape(r"(^|[^0-9./-])(\d{1,2})\.(\d{1,2})\.(\d{2})([^0-9./-]|$)", 4, 2, 3, either=True, bounded=True),
    # January 2024
    Shape(rf"(?i)\b{MONTH_WORD}\.?,?\s+(\d{{4}})", 2, 1, None, named=True),
    # 2024-03
    Shape(r"(^|[^0-9])(\d{4})-(\d{1,2})([^-0-9]|$)", 2, 3, None, bounded=True),
]


def parse_date_sql(expr: str) -> str:
    """DuckDB text of ``parse_date`` for the oracle."""
    def found(rank: int, shape: Shape) -> str:
        p = "'" + shape.pattern.replace("'", "''") + "'"
        group = lambda g: f"regexp_extract({expr}, {p}, {g})"
        y0 = f"try_cast({group(shape.year)} AS INTEGER)"
        y = f"(CASE WHEN length({group(shape.year)}) = 2 THEN {y0} + CASE WHEN {y0} < 69 THEN 2000 ELSE 1900 END ELSE {y0} END)"
        m = (f"CAST((instr('{MONTH_KEYS}', lower(substring({group(shape.month)}, 1, 3))) + 2) // 3 AS INTEGER)"
             if shape.named else f"try_cast({group(shape.month)} AS INTEGER)")
        d = f"try_cast({group(shape.day)} AS INTEGER)" if shape.day else "1"
        if shape.either:
            m, d = f"(CASE WHEN {m} > 12 AND {d} <= 12 THEN {d} ELSE {m} END)", f"(CASE WHEN {m} > 12 AND {d} <= 12 THEN {m} ELSE {d} END)"
        text = f"concat(lpad(CAST({y} AS VARCHAR), 4, '0'), '-', lpad(CAST({m} AS VARCHAR), 2, '0'), '-', lpad(CAST({d} AS VARCHAR), 2, '0'))"
        at = f"strpos({expr}, regexp_extract({expr}, {p}, 0))" + (f" + length({group(1)})" if shape.bounded else "")
        return f"{{'at': {at}, 'rank': {rank}, 'd': CASE WHEN {y0} IS NOT NULL THEN try_cast({text} AS DATE) END}}"

    shapes = ", ".join(found(i, s) for i, s in enumerate(SHAPES))
    return f"list_min(list_filter([{shapes}], lambda f: f.d IS NOT NULL)).d"


# The page twins tokenize HTML by patterns of their own.
_BODY = r"""(?:=\s*"[^"]*"|=\s*'[^']*'|=\s*[^\s"'>][^\s>]*|[^>=]|=)*?"""
_ANY_TAG = rf"<[/!?]?[A-Za-z]{_BODY}>"
_SPACE = "".join(c for c in map(chr, range(0x3001)) if c.isspace())
_WIDE_SPACE = "[\u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
_SKIPPED = ("script", "style", "template")
_ARTICLE_SKIPPED = ("script", "style", "template", "noscript", "form", "footer", "nav", "aside")


def _q(p: str) -> str:
    return _sql_str(p)


def _open(tag: str) -> str:
    return rf"<(?:{tag})(?:(?:\s|/){_BODY})?>"


def _element(tag: str) -> str:
    return rf"(?is){_open(tag)}.*?</{tag}\s*>"


def _uncommented(x: str, by: str = " ") -> str:
    raw = f"{_open('script')}.*?</script\\s*>|{_open('style')}.*?</style\\s*>"
    return f"regexp_replace({x}, {_q(f'(?is)({raw})|<!--.*?-->')}, '\\1{by}', 'g')"


def _decode_sql(x: str) -> str:
    """References decoded piece by piece after each '&'."""
    names = {n: t for n, t in _html5.items() if n.endswith(";")}
    table = "MAP {" + ", ".join(f"{_q(n[:-1])}: {_q(t)}" for n, t in sorted(names.items())) + "}"
    short = "MAP {" + ", ".join(f"{_q(n)}: {_q(t)}" for n, t in sorted(_html5.items()) if not n.endswith(";")) + "}"
    bare = "regexp_extract(p, '^[A-Za-z][A-Za-z0-9]*', 0)"
    number = "regexp_extract(p, '^#([0-9]{1,7});?', 1)"
    hexed = "regexp_extract(p, '^#[xX]([0-9a-fA-F]{1,6});?', 1)"
    word = "regexp_extract(p, '^([A-Za-z][A-Za-z0-9]*);', 1)"
    piece = (f"CASE WHEN {number} <> '' THEN concat(chr(CAST({number} AS INTEGER)), regexp_replace(p, '^#[0-9]+;?', '')) "
             f"WHEN {hexed} <> '' THEN concat(chr(CAST(concat('0x', {hexed}) AS INTEGER)), regexp_replace(p, '^#[xX][0-9a-fA-F]+;?', '')) "
             f"WHEN {word} <> '' AND map_contains(refs, {word}) THEN concat(refs[{word}], substring(p, length({word}) + 2)) "
             f"WHEN {bare} <> '' AND map_contains(bares, {bare}) THEN concat(bares[{bare}], substring(p, length({bare}) + 1)) "
             f"ELSE concat('&', p) END").replace("refs", table).replace("bares", short)
    return (f"CASE WHEN contains({x}, '&') THEN concat(string_split({x}, '&')[1], array_to_string(list_transform("
            f"string_split({x}, '&')[2:], lambda p: {piece}), '')) ELSE {x} END")


def _strip_sql(x: str) -> str:
    return f"trim({x}, {_q(_SPACE)})"


def _nodes_sql(x: str) -> str:
    return (f"list_filter(list_transform(regexp_split_to_array({x}, {_q(_ANY_TAG)}), "
            f"lambda t: {_strip_sql(_decode_sql('t'))}), lambda t: t <> '')")


def _without(x: str, tags, by: str = " ") -> str:
    x = _uncommented(x, by)
    for t in tags:
        x = f"regexp_replace({x}, {_q(_element(t))}, '{by}', 'g')"
    return x


def _get_text_sql(x: str, sep: str = " ", tags=_SKIPPED) -> str:
    return f"array_to_string({_nodes_sql(_without(x, tags))}, {_q(sep)})"


def _attr_sql(tag: str, name: str) -> str:
    """Value of an attribute: the tag's attributes are cut up first, so that a value never counts as one."""
    parts = f"regexp_extract_all(regexp_replace({tag}, '^<[^\\s/>]*', ''), {_q(_ATTR)})"
    mine = f"list_filter({parts}, lambda a: lower(regexp_extract(a, '^[^\\s=]*')) = {_q(name)})[1]"
    value = f"trim(regexp_replace({mine}, '(?s)^[^=]*=?\\s*', ''))"
    value = f"CASE WHEN contains({mine}, '=') THEN regexp_replace({value}, {_q(_QUOTES)}, '', 'g') ELSE '' END"
    return f"coalesce(list_transform([{value}], lambda v: {_decode_sql('v')})[1], '')"


_ATTR = r"""[^\s=>/]+(?:\s*=\s*(?:"[^"]*"|'[^']*'|[^\s>]+))?"""
_QUOTES = r"""^["']|["']$"""

_RULES = _values([(i, k, a, v, w, l) for i, (k, a, v, w, l) in enumerate(schemas.META_DATE_RULES)],
                 ["rule_ord", "kind", "attr", "value", "weight", "label"])
_S = _X.SIGNAL_STRIDE
_TIME_WORDS = " OR ".join(f"contains(ctx, {_q(w)})" for w in schemas.TIME_UPDATED_WORDS)
_PUB_KEYS = ", ".join(_q(k) for k in schemas.JSONLD_PUBLISHED_KEYS)
_UPD_KEYS = ", ".join(_q(k) for k in schemas.JSONLD_UPDATED_KEYS)

DATE_BODY = f""",
ok AS (SELECT page_id, url, html, http_last_modified FROM fx_pages WHERE status_code = 200),
script_els AS (SELECT page_id, url, unnest(s) AS el, generate_subscripts(s, 1) AS script_ord
            FROM (SELECT page_id, url, regexp_extract_all({_uncommented('html')}, {_q(_element('script'))}) AS s FROM ok) x),
scripts AS (SELECT page_id, url, script_ord, regexp_extract(el, {_q('(?is)^' + _open('script') + '(.*)</script')}, 1) AS txt
            FROM script_els WHERE lower(trim({_attr_sql("regexp_extract(el, '^<" + _BODY.replace("'", "''") + ">')", 'type')})) = 'application/ld+json'),
valid AS (SELECT * FROM scripts WHERE trim(txt) <> '' AND json_valid(txt)),
items AS (
  SELECT page_id, url, script_ord, 1 AS item_ord, CAST(txt AS JSON) AS item FROM valid WHERE json_type(txt) <> 'ARRAY'
  UNION ALL
  SELECT page_id, url, script_ord, item_ord, item FROM (
    SELECT page_id, url, script_ord, unnest(CAST(txt AS JSON[])) AS item,
           generate_subscripts(CAST(txt AS JSON[]), 1) AS item_ord FROM valid WHERE json_type(txt) = 'ARRAY') y),
items_n AS (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY script_ord, item_ord) - 1 AS gi FROM items),
tree AS (
  SELECT i.page_id, i.url, i.gi, t.id, t.parent, lower(t.key) AS k,
         CASE WHEN t.type = 'VARCHAR' THEN json_extract_string(t.value, '$') ELSE CAST(t.value AS VARCHAR) END AS v
  FROM items_n i, json_tree(i.item) t
  WHERE t.type NOT IN ('OBJECT', 'ARRAY', 'NULL') AND t.fullkey NOT LIKE '%]'),
jl_pub AS (SELECT page_id, url, gi, v FROM (SELECT *, row_number() OVER (PARTITION BY page_id, gi ORDER BY parent, id) AS rn
           FROM tree WHERE k IN ({_PUB_KEYS})) z WHERE rn = 1),
jl_upd AS (SELECT page_id, url, gi, v FROM (SELECT *, row_number() OVER (PARTITION BY page_id, gi ORDER BY parent, id) AS rn
           FROM tree WHERE k IN ({_UPD_KEYS})) z WHERE rn = 1),
raw_jsonld AS (
  SELECT page_id, url, 'published' AS kind, {schemas.JSONLD_PUBLISHED[0]} AS weight, v AS raw,
         {_q(schemas.JSONLD_PUBLISHED[1])} AS source, CAST({_S} + gi * 2 AS BIGINT) AS ord FROM jl_pub
  UNION ALL
  SELECT page_id, url, 'updated', {schemas.JSONLD_UPDATED[0]}, v, {_q(schemas.JSONLD_UPDATED[1])},
         CAST({_S} + gi * 2 + 1 AS BIGINT) FROM jl_upd),
meta_tags AS (SELECT page_id, url, unnest(t) AS tag, generate_subscripts(t, 1) AS tag_ord
              FROM (SELECT page_id, url, regexp_extract_all({_uncommented('html')}, {_q('(?i)' + _open('meta'))}) AS t FROM ok) x),
meta_attrs AS (SELECT page_id, url, tag_ord, {_attr_sql('tag', 'property')} AS property, {_attr_sql('tag', 'name')} AS name,
   {_attr_sql('tag', 'itemprop')} AS itemprop,
   coalesce(nullif({_attr_sql('tag', 'content')}, ''), nullif({_attr_sql('tag', 'value')}, ''),
            nullif({_attr_sql('tag', 'datetime')}, '')) AS val FROM meta_tags),
meta_first AS (SELECT * FROM (SELECT m.page_id, m.url, m.val, r.*, row_number() OVER (PARTITION BY m.page_id, r.rule_ord ORDER BY m.tag_ord) AS rn
   FROM meta_attrs m JOIN {_RULES} r ON (CASE r.attr WHEN 'property' THEN m.property WHEN 'name' THEN m.name ELSE m.itemprop END) = r.value) z
   WHERE rn = 1),
raw_meta AS (SELECT page_id, url, kind, CAST(weight AS INTEGER) AS weight, nullif({_strip_sql('val')}, '') AS raw, label AS source,
   CAST({2 * _S} + rule_ord AS BIGINT) AS ord FROM meta_first),
time_els AS (SELECT page_id, url, unnest(e) AS el, generate_subscripts(e, 1) - 1 AS i
   FROM (SELECT page_id, url, regexp_extract_all({_uncommented('html')}, {_q(_element('time'))}) AS e FROM ok) x),
time_p AS (SELECT page_id, url, i, regexp_extract(el, {_q('^<' + _BODY + '>')}) AS tag,
   regexp_extract(el, {_q('(?is)^' + _open('time') + '(.*)</time')}, 1) AS inner_html FROM time_els),
time_f AS (SELECT page_id, url, i, {_attr_sql('tag', 'datetime')} AS dt_attr, {_attr_sql('tag', 'id')} AS tid,
   {_attr_sql('tag', 'class')} AS cls, {_nodes_sql('inner_html')} AS nodes FROM time_p),
time_c AS (SELECT *, lower(array_to_string(list_filter(list_concat([array_to_string(nodes, ' ')],
     CASE WHEN tid <> '' THEN list_concat(regexp_split_to_array(cls, '\\s+'), [tid]) ELSE [] END), lambda x: x <> ''), ' ')) AS ctx
   FROM time_f),
raw_time AS (SELECT page_id, url, CASE WHEN {_TIME_WORDS} THEN 'updated' ELSE 'published' END AS kind,
   CAST(CASE WHEN {_TIME_WORDS} THEN {schemas.TIME_UPDATED_WEIGHT} ELSE {schemas.TIME_PUBLISHED_WEIGHT} END AS INTEGER) AS weight,
   coalesce(nullif(dt_attr, ''), nullif(array_to_string(nodes, ''), '')) AS raw, {_q(schemas.TIME_LABEL)} AS source,
   CAST({3 * _S} + i AS BIGINT) AS ord FROM time_c),
vis AS (SELECT page_id, url, regexp_replace({_get_text_sql('html')}, {_q(_WIDE_SPACE)}, ' ', 'g') AS text FROM ok),
raw_text AS (
  SELECT page_id, url, 'published' AS kind, {schemas.TEXT_LABEL_WEIGHT} AS weight,
    nullif(left(regexp_extract(text, {_q(_X.text_label_re(schemas.TEXT_PUBLISHED_PATTERN))}, 1), {schemas.TEXT_RAW_MAX}), '') AS raw,
    {_q('text:' + schemas.TEXT_PUBLISHED_PATTERN)} AS source, CAST({4 * _S} AS BIGINT) AS ord FROM vis
  UNION ALL
  SELECT page_id, url, 'updated', {schemas.TEXT_LABEL_WEIGHT},
    nullif(left(regexp_extract(text, {_q(_X.text_label_re(schemas.TEXT_UPDATED_PATTERN))}, 1), {schemas.TEXT_RAW_MAX}), ''),
    {_q('text:' + schemas.TEXT_UPDATED_PATTERN)}, CAST({4 * _S + 1} AS BIGINT) FROM vis),
raw_http AS (SELECT page_id, url, 'updated' AS kind, {schemas.HTTP_LAST_MODIFIED[0]} AS weight, http_last_modified AS raw,
   {_q(schemas.HTTP_LAST_MODIFIED[1])} AS source, CAST({5 * _S} AS BIGINT) AS ord FROM ok)
"""
DATE_CTES = duckdb_ctes("fx_pages") + DATE_BODY


def _dated(src: str) -> str:
    return (f"SELECT page_id, url, kind, CAST(weight AS INTEGER) AS weight, raw, {parse_date_sql('raw')} AS dt, "
            f"source, ord FROM {src}")


def _cands(*srcs: str) -> str:
    body = " UNION ALL ".join(_dated(s) for s in srcs)
    return f"SELECT * FROM ({body}) c WHERE raw IS NOT NULL AND dt IS NOT NULL"


ORACLE["pages_ok"] = duckdb_ctes("fx_pages") + (
    " SELECT page_id, url, status_code, http_last_modified FROM fx_pages WHERE status_code = 200")
ORACLE["dates_jsonld"] = DATE_CTES + _cands("raw_jsonld")
ORACLE["dates_meta"] = DATE_CTES + _cands("raw_meta")
ORACLE["dates_time"] = DATE_CTES + _cands("raw_time")
ORACLE["dates_text"] = DATE_CTES + _cands("raw_text")
ORACLE["dates_last_modified"] = DATE_CTES + _cands("raw_http")
ALL_CANDS = _cands("raw_jsonld", "raw_meta", "raw_time", "raw_text", "raw_http")
ORACLE["date_candidates"] = DATE_CTES + ALL_CANDS
PD_BODY = f""",
cands AS ({ALL_CANDS}),
bp AS (SELECT page_id, dt FROM (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY weight DESC, dt, ord) AS rn
       FROM cands WHERE kind = 'published') z WHERE rn = 1),
bu AS (SELECT page_id, dt FROM (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY weight DESC, dt DESC, ord) AS rn
       FROM cands WHERE kind = 'updated') z WHERE rn = 1)
"""
PAGE_DATES_SQL = DATE_CTES + PD_BODY + f"""
SELECT ok.page_id, ok.url, bp.dt AS published, bu.dt AS updated, {parse_date_sql('ok.http_last_modified')} AS http_last_modified
FROM ok LEFT JOIN bp ON ok.page_id = bp.page_id LEFT JOIN bu ON ok.page_id = bu.page_id
"""
ORACLE["page_dates"] = PAGE_DATES_SQL
ORACLE["page_date_lists"] = DATE_CTES + f""",
cands AS ({ALL_CANDS}),
lists AS (SELECT page_id, kind, string_agg(concat_ws('|', weight, raw, strftime(dt, '%m/%d/%Y'), source), chr(10) ORDER BY ord) AS listed
          FROM cands GROUP BY page_id, kind)
SELECT ok.page_id, ok.url, coalesce(p.listed, '') AS published_candidates, coalesce(u.listed, '') AS updated_candidates
FROM ok LEFT JOIN (SELECT * FROM lists WHERE kind = 'published') p ON ok.page_id = p.page_id
LEFT JOIN (SELECT * FROM lists WHERE kind = 'updated') u ON ok.page_id = u.page_id
"""


# ---------------------------------------------------------------- articles

_TYPES = "[" + ", ".join(_q(t) for t in schemas.ARTICLE_TYPES) + "]"


_LINES = ("p div br li ul ol tr table article section main header footer nav aside blockquote pre "
          "h1 h2 h3 h4 h5 h6 title hr").replace(" ", "|")


def _markdown_sql(x: str) -> str:
    def sub(x: str, pattern: str, by: str) -> str:
        return f"regexp_replace({x}, {_q(pattern)}, {by}, 'g')"

    def tags(names: str) -> str:
        return rf"(?i)</?(?:{names})(?:(?:\s|/){_BODY})?>"

    s = _without(x, ("script", "style", "template", "head"), "")
    s = sub(s, "(?i)" + _open("img"), "''")
    s = sub(s, rf"""(?is)<a\s(?:{_BODY}\s)?href\s*=\s*["']([^"']*)["']{_BODY}>(.*?)</a\s*>""", "'[\\2](\\1)'")
    for n in range(1, 7):
        s = sub(s, "(?i)" + _open(f"h{n}"), _q("\n\n" + "#" * n + " "))
    s = sub(s, "(?i)" + _open("li"), _q("\n* "))
    s = sub(s, tags("b|strong"), "'**'")
    s = sub(s, tags("i|em"), "'_'")
    s = sub(s, tags(_LINES), _q("\n"))
    s = _decode_sql(sub(s, _ANY_TAG, "''"))
    s = sub(s, "(?m)[ \t\u00a0]+$", "''")
    return _strip_sql(sub(s, "\n{3,}", _q("\n\n")))


JSONLD_CTES = DATE_CTES + f""",
art AS (SELECT page_id, item FROM (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY gi) AS rn FROM items_n
   WHERE json_type(item) = 'OBJECT' AND (
     (json_type(item, '$."@type"') = 'ARRAY' AND list_has_any(CAST(json_extract(item, '$."@type"') AS VARCHAR[]), {_TYPES}))
     OR (json_type(item, '$."@type"') = 'VARCHAR' AND list_contains({_TYPES}, json_extract_string(item, '$."@type"'))))) z
   WHERE rn = 1),
jsonld AS (SELECT page_id,
  coalesce(nullif(json_extract_string(item, '$.headline'), ''), nullif(json_extract_string(item, '$.name'), '')) AS title,
  CASE json_type(item, '$.author')
    WHEN 'ARRAY' THEN array_to_string(list_transform(CAST(json_extract(item, '$.author') AS JSON[]),
         lambda a: CASE WHEN json_type(a) = 'OBJECT' THEN json_extract_string(a, '$.name') ELSE json_extract_string(a, '$') END), ', ')
    WHEN 'OBJECT' THEN json_extract_string(item, '$.author.name')
    ELSE nullif(json_extract_string(item, '$.author'), '') END AS author,
  coalesce(nullif(json_extract_string(item, '$.datePublished'), ''), nullif(json_extract_string(item, '$.dateCreated'), '')) AS date,
  json_extract_string(item, '$.description') AS description,
  json_extract_string(item, '$.articleBody') AS article_body,
  CASE WHEN json_type(item, '$.publisher') = 'OBJECT' THEN json_extract_string(item, '$.publisher.name')
       ELSE json_extract_string(item, '$.publisher') END AS publisher,
  json_extract_string(item, '$.url') AS url
FROM art)
"""
ORACLE["jsonld_articles"] = JSONLD_CTES + " SELECT * FROM jsonld"

_ARTICLE_TEXT_SQL = _strip_sql(
    f"regexp_replace({_get_text_sql('html', chr(10), _ARTICLE_SKIPPED)}, {_q(chr(10) + '{2,}')}, {_q(chr(10) * 2)}, 'g')")
ORACLE["visible_text"] = duckdb_ctes("fx_pages") + (
    f" SELECT page_id, {_get_text_sql('html')} AS text_all, {_ARTICLE_TEXT_SQL} AS text_article FROM fx_pages")
ORACLE["markdown_text"] = duckdb_ctes("fx_pages") + f" SELECT page_id, {_markdown_sql('html')} AS markdown FROM fx_pages"

# ---------------------------------------------------------------- container tree
# The tree by nested intervals: a page is cut at its tags into numbered parts; an
# element runs to the first end tag of its name at a lesser depth of that name, or
# to the end of an element around it.  The engine keeps a stack instead.

_DENSE_SKIPPED = ("script", "style", "template", "noscript", "form")
_BOXES = "div article section main header footer nav aside body html ul ol li table tr td th blockquote".split()
_NEVER = "9223372036854775807"

TREE_CTES = f"""
cut AS (SELECT page_id, string_split(regexp_replace({_without('html', _DENSE_SKIPPED, '<i></i>')}, {_q('(' + _ANY_TAG + ')')}, concat(chr(1), '\\1', chr(1)), 'g'), chr(1)) AS a
  FROM fx_pages WHERE status_code BETWEEN 200 AND 299),
part AS (SELECT page_id, unnest(a) AS x, generate_subscripts(a, 1) AS p FROM cut),
tag AS (SELECT page_id, p, lower(regexp_extract(x, '^</?([A-Za-z][^\\s/>]*)', 1)) AS name, x[2] = '/' AS closing FROM part WHERE p % 2 = 0),
piece AS (SELECT * FROM (SELECT page_id, p, {_strip_sql(_decode_sql('x'))} AS t FROM part WHERE p % 2 = 1) WHERE t <> ''),
box AS (SELECT *, sum(CASE WHEN closing THEN -1 ELSE 1 END) OVER (PARTITION BY page_id, name ORDER BY p) AS depth
  FROM tag WHERE list_contains({_BOXES}, name)),
element AS (SELECT s.page_id, s.p, s.name, coalesce(min(e.p), {_NEVER}) AS e
  FROM box s LEFT JOIN box e ON e.page_id = s.page_id AND e.name = s.name AND e.closing AND e.p > s.p AND e.depth < s.depth
  WHERE NOT s.closing GROUP BY s.page_id, s.p, s.name),
span AS (SELECT s.page_id, s.p, s.name, least(s.e, coalesce(min(o.e), {_NEVER})) AS e
  FROM element s LEFT JOIN element o ON o.page_id = s.page_id AND o.p < s.p AND o.e > s.p
  GROUP BY s.page_id, s.p, s.name, s.e),
node AS (SELECT *, CAST(row_number() OVER (PARTITION BY page_id ORDER BY p) - 1 AS INTEGER) AS node_ord
  FROM span WHERE name IN ('article', 'section', 'div', 'main')),
node_text AS (SELECT n.page_id, n.node_ord, string_agg(t.t, chr(10) ORDER BY t.p) AS t
  FROM node n JOIN piece t ON t.page_id = n.page_id AND t.p > n.p AND t.p < n.e GROUP BY n.page_id, n.node_ord),
node_links AS (SELECT n.page_id, n.node_ord, CAST(count(*) AS INTEGER) AS n_links
  FROM node n JOIN tag a ON a.page_id = n.page_id AND a.name = 'a' AND NOT a.closing AND a.p > n.p AND a.p < n.e GROUP BY n.page_id, n.node_ord),
scored AS (SELECT n.page_id, n.node_ord, n.name AS tag, coalesce(l.n_links, 0) AS n_links,
    length(t.t) / CAST(coalesce(l.n_links, 0) + 1 AS DOUBLE) AS score, t.t
  FROM node n JOIN node_text t ON t.page_id = n.page_id AND t.node_ord = n.node_ord
  LEFT JOIN node_links l ON l.page_id = n.page_id AND l.node_ord = n.node_ord WHERE length(t.t) > {schemas.MIN_TEXT_CHARS}),
best AS (SELECT page_id, node_ord, tag, n_links, score, {_strip_sql(f"regexp_replace(t, {_q(chr(10) + '{2,}')}, {_q(chr(10) * 2)}, 'g')")} AS text
  FROM (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY score DESC, node_ord) AS rn FROM scored) WHERE rn = 1)"""
ORACLE["best_container"] = duckdb_ctes("fx_pages") + "," + TREE_CTES + " SELECT * FROM best"

_LINE_ENDS = "\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\u0085\u2028\u2029]"


def _clean_lines_sql(x: str) -> str:
    lines = f"list_transform(regexp_split_to_array({x}, {_q(_LINE_ENDS)}), lambda l: {_strip_sql('l')})"
    return f"array_to_string(list_filter({lines}, lambda l: l <> ''), chr(10))"


RECORD_CTES = JSONLD_CTES + "," + TREE_CTES + f""",
body AS (SELECT p.page_id, p.url AS request_url, p.html, p.status_code BETWEEN 200 AND 299 AS ok, j.title, j.author, j.date, j.publisher,
    j.url AS own_url, j.description, coalesce(nullif(j.article_body, ''), b.text, '') AS body
  FROM fx_pages p LEFT JOIN jsonld j ON j.page_id = p.page_id LEFT JOIN best b ON b.page_id = p.page_id),
reduced AS (SELECT *, CASE WHEN contains(body, '<') AND contains(body, '>') AND contains(body, '</')
    THEN {_get_text_sql('body', chr(10))} ELSE body END AS plain FROM body),
record AS (SELECT page_id, request_url, CASE WHEN ok THEN title END AS title, CASE WHEN ok THEN author END AS author,
    CASE WHEN ok THEN date END AS date, CASE WHEN ok THEN publisher END AS publisher,
    CASE WHEN ok THEN coalesce(nullif(own_url, ''), request_url) ELSE request_url END AS url,
    CASE WHEN ok THEN description END AS description,
    CASE WHEN ok THEN {_clean_lines_sql(f"CASE WHEN plain <> '' THEN plain ELSE {_markdown_sql('html')} END")} END AS text
  FROM reduced)"""
ORACLE["article_records"] = RECORD_CTES + " SELECT * FROM record"

_NEWS = ", ".join(f"f.{c.strip()}" for c in K1_COLS.split(","))
ORACLE["enriched_news"] = RECORD_CTES + "," + FEED_CTES.removeprefix("WITH ") + f""",
news_page AS (SELECT url, min(page_id) AS page_id FROM ({duckdb_text("fx_news_crawl")}) c GROUP BY url)
SELECT {_NEWS}, r.title AS article_title, r.text AS article_text, r.description AS article_summary
FROM k1_first f LEFT JOIN news_page n ON f.link = n.url LEFT JOIN record r ON n.page_id = r.page_id"""


# ---------------------------------------------------------------- composite K5

ORACLE["utility_notices"] = duckdb_ctes("fx_pages", "fx_crawl", "fx_utilities", "fx_search", "fx_search_log") \
    + DATE_BODY + PD_BODY + """,
pd AS (SELECT ok.page_id, bp.dt AS published FROM ok LEFT JOIN bp ON ok.page_id = bp.page_id),
crawl_pd AS (SELECT url, published FROM (SELECT c.url, pd.published,
    row_number() OVER (PARTITION BY c.url ORDER BY c.page_id) AS rn FROM fx_crawl c JOIN pd ON c.page_id = pd.page_id) z
  WHERE rn = 1),
reqs AS (SELECT utility_id, county_name AS county, state_code AS state, CAST(y.range AS BIGINT) AS year,
  concat('Boil Water Advsiory in ', CAST(y.range AS VARCHAR), ' at ', county_name, ', ', state_code) AS query
  FROM fx_utilities, range(2020, 2026) y WHERE population_served_count > 5000),
ans AS (SELECT r.*, CAST(json_extract(l.body, '$.data.webPages.value') AS JSON[]) AS arr FROM reqs r JOIN (SELECT query, CASE WHEN json_valid(body) THEN body END AS body FROM (SELECT query, body, row_number() OVER (PARTITION BY query ORDER BY CASE WHEN json_valid(body) THEN CASE WHEN json_type(body, '$.data.webPages.value') = 'ARRAY' THEN 0 ELSE 1 END ELSE 1 END, body) AS rn FROM fx_search_log) b WHERE rn = 1) l ON r.query = l.query
  WHERE json_valid(l.body) AND json_type(l.body, '$.data.webPages.value') = 'ARRAY'),
res AS (SELECT * FROM (SELECT utility_id, county, state, year, unnest(arr) AS r, generate_subscripts(arr, 1) AS rank FROM ans) x WHERE json_type(r) = 'OBJECT'),
hits AS (SELECT utility_id, county, state, year, json_extract_string(r, '$.displayUrl') AS display_url,
  json_extract_string(r, '$.snippet') AS snippet FROM res WHERE rank <= 2 AND contains(json_extract_string(r, '$.snippet'), 'boil'))
SELECT h.utility_id, h.year, h.county, h.state, h.display_url AS link, h.snippet,
  strftime(c.published, '%m/%d/%Y') AS publish_date
FROM hits h LEFT JOIN crawl_pd c ON h.display_url = c.url
"""


# ---------------------------------------------------------------- J9, O3, S14

ORACLE["site_chain"] = duckdb_ctes("fx_utilities", "fx_crosswalk", "fx_search_flat", "fx_local_log") + \
    SAMPLE_CTES[len(UTIL_CTES):] + """,
counties AS (SELECT county_fips, county, state FROM (
  SELECT county_fips, county_name AS county, left(pwsid, 2) AS state,
         row_number() OVER (PARTITION BY county_fips ORDER BY utility_id NULLS LAST) AS rn
  FROM fx_utilities WHERE county_fips IN (SELECT county_fips FROM sample)) r WHERE rn = 1),
local AS (SELECT c.county_fips, c.county, c.state, CAST(json_extract(l.body, '$.items') AS JSON[]) AS arr
  FROM counties c JOIN (SELECT query, CASE WHEN json_valid(body) THEN body END AS body FROM (SELECT query, body, row_number() OVER (PARTITION BY query ORDER BY CASE WHEN json_valid(body) THEN CASE WHEN json_type(body, '$.items') = 'ARRAY' THEN 0 ELSE 1 END ELSE 1 END, body) AS rn FROM fx_local_log) b WHERE rn = 1) l ON l.query = concat('local news in ', c.county, ', ', c.state)
  WHERE json_valid(l.body) AND json_type(l.body, '$.items') = 'ARRAY' AND len(CAST(json_extract(l.body, '$.items') AS JSON[])) >= 1)
SELECT county_fips, county, state, json_extract_string(arr[1], '$.link') AS link,
  concat('Boil Water Notice site:', json_extract_string(arr[1], '$.link'), ' after:2025-01-01') AS query
FROM local WHERE json_type(arr[1]) = 'OBJECT'
"""
ORACLE["news_head"] = FEED_CTES + f"SELECT {K1_COLS} FROM k1_first ORDER BY publish_time NULLS LAST, link LIMIT 100"
ORACLE["model_response_text"] = duckdb_ctes("fx_llm_parts") + """
SELECT doc_id, array_to_string(list_transform(CAST(content AS JSON[]),
  lambda p: coalesce(json_extract_string(p, '$.text'), '')), '') AS response
FROM fx_llm_parts WHERE json_valid(content) AND json_type(content) = 'ARRAY'
"""


# ---------------------------------------------------------------- composite K7, K6

def _adv_chain(src: str, ids: list[str], p: str) -> str:
    """CTEs ``{p}_adv`` (normalised advisories) over ``src`` (ids..., response)."""
    idl = ", ".join(ids)

    def norm(field):
        x = f"json_extract_string(a, '$.{field}')"
        return f"CASE WHEN {x} IS NULL OR {x} = 'null' THEN '' ELSE {x} END AS {field}"

    return f""",
{p}_j AS (SELECT {idl}, regexp_extract(response, '(?s)\\{{.*\\}}', 0) AS j FROM {src}),
{p}_last AS (SELECT {idl}, arg_max(e.value, e.id) AS v FROM (SELECT {idl}, CASE WHEN json_valid(j) THEN j ELSE '{{}}' END AS j FROM {p}_j) o, json_each(o.j) e
   WHERE e.key = 'advisories' GROUP BY {idl}),
{p}_ok AS (SELECT {idl}, CAST(v AS JSON[]) AS arr FROM {p}_last WHERE json_type(v) = 'ARRAY'),
{p}_items AS (SELECT * FROM (SELECT {idl}, unnest(arr) AS a FROM {p}_ok) x WHERE json_type(a) = 'OBJECT'),
{p}_adv AS (SELECT {idl}, coalesce(json_extract_string(a, '$.type'), '') AS type,
   coalesce(CASE WHEN json_type(a, '$.location') = 'ARRAY'
        THEN array_to_string(CAST(json_extract(a, '$.location') AS VARCHAR[]), ', ')
        ELSE json_extract_string(a, '$.location') END, '') AS location,
   {norm('start_date')}, {norm('end_date')} FROM {p}_items)"""


_CRAWL_PD = """,
pd AS (SELECT ok.page_id, bp.dt AS published FROM ok LEFT JOIN bp ON ok.page_id = bp.page_id),
crawl_pd AS (SELECT url, published FROM (SELECT c.url, pd.published,
    row_number() OVER (PARTITION BY c.url ORDER BY c.page_id) AS rn FROM fx_crawl c JOIN pd ON c.page_id = pd.page_id) z
  WHERE rn = 1)"""

ORACLE["summary_advisories"] = duckdb_ctes("fx_pages", "fx_crawl", "fx_utilities", "fx_search", "fx_news_log",
                                           "fx_llm", "fx_summary_llm") + DATE_BODY + PD_BODY + _CRAWL_PD + """,
u AS (SELECT utility_id, county_name AS county, left(pwsid, 2) AS state FROM fx_utilities WHERE population_served_count > 5000),
ans AS (SELECT u.*, CAST(json_extract(l.body, '$.data.webPages.value') AS JSON[]) AS arr FROM u
  JOIN (SELECT query, CASE WHEN json_valid(body) THEN body END AS body FROM (SELECT query, body, row_number() OVER (PARTITION BY query ORDER BY CASE WHEN json_valid(body) THEN CASE WHEN json_type(body, '$.data.webPages.value') = 'ARRAY' THEN 0 ELSE 1 END ELSE 1 END, body) AS rn FROM fx_news_log) b WHERE rn = 1) l ON l.query = concat('boil water advisory warning from news sites ', u.county, ', ', u.state)
  WHERE json_valid(l.body) AND json_type(l.body, '$.data.webPages.value') = 'ARRAY'),
res AS (SELECT * FROM (SELECT utility_id, county, state, unnest(arr) AS r, generate_subscripts(arr, 1) AS rank FROM ans) x WHERE json_type(r) = 'OBJECT'),
hits AS (SELECT utility_id, county, state, CAST(rank AS BIGINT) AS rank, json_extract_string(r, '$.displayUrl') AS link,
  json_extract_string(r, '$.summary') AS summary FROM res
  WHERE rank <= 5 AND contains(json_extract_string(r, '$.snippet'), 'boil')),
extras AS (SELECT h.*, coalesce(strftime(c.published, '%m/%d/%Y'), '') AS publish_date
  FROM hits h LEFT JOIN crawl_pd c ON h.link = c.url),
answers AS (SELECT e.utility_id, e.rank, s.response FROM extras e JOIN (SELECT input_text, min(response) AS response FROM fx_summary_llm GROUP BY input_text) s ON e.summary = s.input_text)""" \
    + _adv_chain("answers", ["utility_id", "rank"], "k7") + """
SELECT a.utility_id, a.rank, a.type, a.location, a.start_date, a.end_date, e.publish_date, e.county, e.state, e.link, e.summary
FROM k7_adv a JOIN extras e ON a.utility_id = e.utility_id AND a.rank = e.rank
"""

ORACLE["sampled_advisories"] = duckdb_ctes("fx_pages", "fx_crawl", "fx_utilities", "fx_crosswalk", "fx_search_flat",
                                           "fx_local_log", "fx_site_log", "fx_verdict_log", "fx_llm",
                                           "fx_article_llm") + DATE_BODY + \
    SAMPLE_CTES[len(UTIL_CTES):] + f""",
counties AS (SELECT county_fips, county, state FROM (
  SELECT county_fips, county_name AS county, left(pwsid, 2) AS state,
         row_number() OVER (PARTITION BY county_fips ORDER BY utility_id NULLS LAST) AS rn
  FROM fx_utilities WHERE county_fips IN (SELECT county_fips FROM sample)) r WHERE rn = 1),
local AS (SELECT c.county_fips, c.county, c.state, CAST(json_extract(l.body, '$.items') AS JSON[]) AS arr
  FROM counties c JOIN (SELECT query, CASE WHEN json_valid(body) THEN body END AS body FROM (SELECT query, body, row_number() OVER (PARTITION BY query ORDER BY CASE WHEN json_valid(body) THEN CASE WHEN json_type(body, '$.items') = 'ARRAY' THEN 0 ELSE 1 END ELSE 1 END, body) AS rn FROM fx_local_log) b WHERE rn = 1) l ON l.query = concat('local news in ', c.county, ', ', c.state)
  WHERE json_valid(l.body) AND json_type(l.body, '$.items') = 'ARRAY' AND len(CAST(json_extract(l.body, '$.items') AS JSON[])) >= 1),
site_q AS (SELECT county_fips, county, state,
  concat('Boil Water Notice site:', json_extract_string(arr[1], '$.link'), ' after:2025-01-01') AS query FROM local WHERE json_type(arr[1]) = 'OBJECT'),
found AS (SELECT q.county_fips, q.county, q.state, CAST(json_extract(l.body, '$.items') AS JSON[]) AS arr
  FROM site_q q JOIN (SELECT query, CASE WHEN json_valid(body) THEN body END AS body FROM (SELECT query, body, row_number() OVER (PARTITION BY query ORDER BY CASE WHEN json_valid(body) THEN CASE WHEN json_type(body, '$.items') = 'ARRAY' THEN 0 ELSE 1 END ELSE 1 END, body) AS rn FROM fx_site_log) b WHERE rn = 1) l ON l.query = q.query
  WHERE json_valid(l.body) AND json_type(l.body, '$.items') = 'ARRAY'),
site_items AS (SELECT * FROM (SELECT county_fips, county, state, unnest(arr) AS r, generate_subscripts(arr, 1) AS rank FROM found) x WHERE json_type(r) = 'OBJECT'),
hits AS (SELECT county_fips, county, state, CAST(rank AS BIGINT) AS rank, json_extract_string(r, '$.link') AS link,
  json_extract_string(r, '$.snippet') AS snippet FROM site_items WHERE rank <= 2 AND contains(json_extract_string(r, '$.snippet'), 'boil')),
judged AS (SELECT h.* FROM hits h JOIN (SELECT prompt, min(response) AS response FROM fx_verdict_log GROUP BY prompt) v
  ON concat(h.snippet, ' Responding in either "YES" or "NO" do you think this news article is about a boil water advisory') = v.prompt
  WHERE contains(v.response, 'YES')),
art AS (SELECT page_id, item FROM (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY gi) AS rn FROM items_n
   WHERE json_type(item) = 'OBJECT' AND (
     (json_type(item, '$."@type"') = 'ARRAY' AND list_has_any(CAST(json_extract(item, '$."@type"') AS VARCHAR[]), {_TYPES}))
     OR (json_type(item, '$."@type"') = 'VARCHAR' AND list_contains({_TYPES}, json_extract_string(item, '$."@type"'))))) z
   WHERE rn = 1),
art_date AS (SELECT page_id, coalesce(nullif(json_extract_string(item, '$.datePublished'), ''),
   nullif(json_extract_string(item, '$.dateCreated'), '')) AS d FROM art),
first_page AS (SELECT url, page_id, status_code FROM (SELECT c.url, c.page_id, c.status_code,
   row_number() OVER (PARTITION BY c.url ORDER BY c.page_id) AS rn FROM fx_crawl c) z WHERE rn = 1),
link_date AS (SELECT f.url, CASE WHEN f.status_code BETWEEN 200 AND 299 THEN ad.d END AS article_date
   FROM first_page f LEFT JOIN art_date ad ON f.page_id = ad.page_id),
enriched AS (SELECT j.county_fips, j.rank, j.county, j.state, j.link, ld.article_date
   FROM judged j LEFT JOIN link_date ld ON j.link = ld.url),
answers AS (SELECT e.county_fips, e.rank, l.response FROM enriched e JOIN (SELECT link, min(response) AS response FROM fx_article_llm GROUP BY link) l ON e.link = l.link)""" \
    + _adv_chain("answers", ["county_fips", "rank"], "k6") + f"""
SELECT a.county_fips, a.rank, a.type, a.location, a.start_date, a.end_date,
  strftime({parse_date_sql('e.article_date')}, '%m/%d/%Y') AS publish_date, e.county, e.state, e.link
FROM k6_adv a JOIN enriched e ON a.county_fips = e.county_fips AND a.rank = e.rank
"""


# ---------------------------------------------------------------- X13 lenient (F16)
# Independent of the engine's scanner: a text that is no JSON is rewritten by
# patterns (trailing commas dropped, bare keys quoted, single quotes made double).

ORACLE["advisories_lenient"] = duckdb_ctes("fx_llm") + r"""
, lj AS (SELECT doc_id, regexp_extract(response, '(?s)\{.*\}', 0) AS j FROM fx_llm),
lj2 AS (SELECT doc_id, CASE WHEN json_valid(j) THEN j ELSE regexp_replace(regexp_replace(regexp_replace(j,
   ',\s*([}\]])', '\1', 'g'),
   '([{,]\s*)([A-Za-z_][A-Za-z0-9_]*)\s*:', '\1"\2":', 'g'),
   '''([^'']*)''', '"\1"', 'g') END AS j FROM lj WHERE j <> ''),
llast AS (SELECT doc_id, arg_max(e.value, e.id) AS v FROM (SELECT doc_id, CASE WHEN json_valid(j) THEN j ELSE '{}' END AS j FROM lj2) o, json_each(o.j) e
   WHERE e.key = 'advisories' GROUP BY doc_id),
lok AS (SELECT doc_id, CAST(v AS JSON[]) AS arr FROM llast WHERE json_type(v) = 'ARRAY'),
litems AS (SELECT * FROM (SELECT doc_id, unnest(arr) AS a, CAST(generate_subscripts(arr, 1) AS BIGINT) AS adv_pos FROM lok) x WHERE json_type(a) = 'OBJECT')
SELECT doc_id, adv_pos,
   coalesce(json_extract_string(a, '$.type'), '') AS type,
   coalesce(CASE WHEN json_type(a, '$.location') = 'ARRAY'
        THEN array_to_string(CAST(json_extract(a, '$.location') AS VARCHAR[]), ', ')
        ELSE json_extract_string(a, '$.location') END, '') AS location,
   CASE WHEN json_extract_string(a, '$.start_date') IS NULL OR json_extract_string(a, '$.start_date') = 'null' THEN '' ELSE json_extract_string(a, '$.start_date') END AS start_date,
   CASE WHEN json_extract_string(a, '$.end_date') IS NULL OR json_extract_string(a, '$.end_date') = 'null' THEN '' ELSE json_extract_string(a, '$.end_date') END AS end_date,
   CASE WHEN json_extract_string(a, '$.publish_date') IS NULL OR json_extract_string(a, '$.publish_date') = 'null' THEN '' ELSE json_extract_string(a, '$.publish_date') END AS publish_date
FROM litems
"""


# ---------------------------------------------------------------- CSV hand-offs
# A report keeps every row; empty text is read back as null.

ORACLE["documents_csv"] = ("SELECT doc_id, nullif(lang, '') AS lang, nullif(source, '') AS source, "
                           "nullif(text, '') AS text FROM documents")
ORACLE["news_report_csv"] = FEED_CTES + (
    " SELECT publish_time, nullif(link, '') AS link, nullif(source, '') AS source, location_type, "
    "nullif(location_fullname, '') AS location_fullname, nullif(country_code, '') AS country_code, "
    "nullif(adm1_code, '') AS adm1_code, latitude, longitude FROM k1_first")
ORACLE["appended_advisories"] = ORACLE["advisories_strict"]
ORACLE["counts_csv_by_year"] = ORACLE["counts_by_state_year"]
ORACLE["state_map_stored"] = ORACLE["state_map_table"]
