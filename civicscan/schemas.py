"""Schemas and fixed values.

Everything in the FIXED VALUES block must equal the behaviour being matched
(lookup rows, word lists, weights, labels); it is kept as plain data in
natural order.  The state rows become a small DataFrame (``state_names``)
that is joined by broadcast (its size is fixed).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# FIXED VALUES
# ---------------------------------------------------------------------------

# State / territory abbreviation -> name (50 states, DC, 5 territories).
# Two territory names carry their code as a suffix; they are kept verbatim.
STATE_NAMES = [
    ("AK", "Alaska"),
    ("AL", "Alabama"),
    ("AR", "Arkansas"),
    ("AZ", "Arizona"),
    ("CA", "California"),
    ("CO", "Colorado"),
    ("CT", "Connecticut"),
    ("DE", "Delaware"),
    ("FL", "Florida"),
    ("GA", "Georgia"),
    ("HI", "Hawaii"),
    ("IA", "Iowa"),
    ("ID", "Idaho"),
    ("IL", "Illinois"),
    ("IN", "Indiana"),
    ("KS", "Kansas"),
    ("KY", "Kentucky"),
    ("LA", "Louisiana"),
    ("MA", "Massachusetts"),
    ("MD", "Maryland"),
    ("ME", "Maine"),
    ("MI", "Michigan"),
    ("MN", "Minnesota"),
    ("MO", "Missouri"),
    ("MS", "Mississippi"),
    ("MT", "Montana"),
    ("NC", "North Carolina"),
    ("ND", "North Dakota"),
    ("NE", "Nebraska"),
    ("NH", "New Hampshire"),
    ("NJ", "New Jersey"),
    ("NM", "New Mexico"),
    ("NV", "Nevada"),
    ("NY", "New York"),
    ("OH", "Ohio"),
    ("OK", "Oklahoma"),
    ("OR", "Oregon"),
    ("PA", "Pennsylvania"),
    ("RI", "Rhode Island"),
    ("SC", "South Carolina"),
    ("SD", "South Dakota"),
    ("TN", "Tennessee"),
    ("TX", "Texas"),
    ("UT", "Utah"),
    ("VA", "Virginia"),
    ("VT", "Vermont"),
    ("WA", "Washington"),
    ("WI", "Wisconsin"),
    ("WV", "West Virginia"),
    ("WY", "Wyoming"),
    ("DC", "District of Columbia"),
    ("AS", "American Samoa"),
    ("GU", "Guam GU"),
    ("MP", "Northern Mariana Islands"),
    ("PR", "Puerto Rico PR"),
    ("VI", "U.S. Virgin Islands"),
]

# Link keywords that mark a notice (matched case-insensitively, any of).
NOTICE_KEYWORDS = [
    "boil-water", "boilwater", "advisory", "advisories", "notice", "alert",
    "drinking-water", "order", "water-quality", "contamination", "bwa",
    "continue-boiling",
]

# Default slug words, in order, for the news-feed scan.
SLUG_WORDS = ["boil", "water"]

# Regions left out of the contiguous-states map.
MAP_EXCLUDED_REGIONS = ["Alaska", "Hawaii", "Puerto Rico"]
# Lookup entries with no shape in the state geometry set (which holds the 50
# states, DC and Puerto Rico).
MAP_NO_GEOMETRY = ["AS", "GU", "MP", "VI"]
MAP_PAD_FRACTION = 0.03

# Trend years and request years (inclusive ranges).
TREND_YEARS = (2015, 2025)
REQUEST_YEARS = (2020, 2025)
POPULATION_THRESHOLD = 5000

# County sample: fixed codes first, then codes drawn from a range up to a size.
SAMPLE_FIXED_CODES = [20203, 51540, 51121, 51159, 51113]
SAMPLE_CODE_RANGE = (10000, 90000)
SAMPLE_SIZE = 15

# JSON-LD @type values that mark an article.
ARTICLE_TYPES = ["NewsArticle", "Article", "ReportageNewsArticle"]

# Minimum text length for a body / container.
MIN_TEXT_CHARS = 200

# Meta-tag date rules: (kind, attribute, value, weight, label), in rule order.
META_DATE_RULES = [
    ("published", "property", "article:published_time", 90, "meta[property=article:published_time]"),
    ("updated", "property", "article:modified_time", 88, "meta[property=article:modified_time]"),
    ("updated", "property", "og:updated_time", 85, "meta[property=og:updated_time]"),
    ("published", "name", "pubdate", 70, "meta[name=pubdate]"),
    ("published", "name", "publish_date", 70, "meta[name=publish_date]"),
    ("published", "name", "date", 65, "meta[name=date]"),
    ("published", "name", "dcterms.date", 75, "meta[name=dcterms.date]"),
    ("published", "name", "dc.date.issued", 75, "meta[name=DC.date.issued]"),
    ("published", "itemprop", "datePublished", 92, "meta[itemprop=datePublished]"),
    ("updated", "itemprop", "dateModified", 90, "meta[itemprop=dateModified]"),
    ("updated", "name", "last-modified", 60, "meta[name=last-modified]"),
    ("updated", "name", "modified", 60, "meta[name=modified]"),
]

# Other date-evidence weights and source labels.
JSONLD_PUBLISHED = (100, "jsonld.datePublished/uploadDate")
JSONLD_UPDATED = (95, "jsonld.dateModified/updated")
JSONLD_PUBLISHED_KEYS = ["datepublished", "uploaddate"]
JSONLD_UPDATED_KEYS = ["datemodified", "updated"]
TIME_PUBLISHED_WEIGHT = 70
TIME_UPDATED_WEIGHT = 68
TIME_LABEL = "time element"
TIME_UPDATED_WORDS = ["updated", "modified", "last updated"]
TEXT_LABEL_WEIGHT = 50
TEXT_PUBLISHED_PATTERN = r"(?:published|posted)\s*[:\-–]\s*([A-Za-z0-9,\s:/\-+.]+)"
TEXT_UPDATED_PATTERN = r"(?:updated|last updated|modified)\s*[:\-–]\s*([A-Za-z0-9,\s:/\-+.]+)"
TEXT_RAW_MAX = 80
HTTP_LAST_MODIFIED = (40, "http.Last-Modified")

# Query-text templates.
UTILITY_YEAR_QUERY = "Boil Water Advsiory in {year} at {county}, {state}"
COUNTY_NEWS_QUERY = "boil water advisory warning from news sites {county}, {state}"
LOCAL_NEWS_QUERY = "local news in {county}, {state}"
SITE_NOTICE_QUERY = "Boil Water Notice site:{link} after:{after}"
SITE_NOTICE_AFTER = "2025-01-01"
VERDICT_PROMPT_SUFFIX = ' Responding in either "YES" or "NO" do you think this news article is about a boil water advisory'
VERDICT_WORD = "YES"
SNIPPET_WORD = "boil"
EXTRACTION_PROMPT_HEAD = "Article text:\n"
EXTRACTION_PROMPT_TAIL = "\n\nExtract the advisories as per the schema."

# Results per request.
NESTED_RESULTS_PER_REQUEST = 2
FLAT_RESULTS_DEFAULT = 5

# ---------------------------------------------------------------------------
# Schemas
# ---------------------------------------------------------------------------

ADVISORY_SCHEMA = T.StructType([
    T.StructField("advisories", T.ArrayType(T.StructType([
        T.StructField("type", T.StringType()),
        T.StructField("location", T.StringType()),
        T.StructField("start_date", T.StringType()),
        T.StructField("end_date", T.StringType()),
        T.StructField("publish_date", T.StringType()),
    ]))),
])

UTILITY_CSV_SCHEMA = T.StructType([
    T.StructField("PWSID", T.StringType()),
    T.StructField("STATE_CODE", T.StringType()),
    T.StructField("COUNTYFIPS", T.LongType()),
    T.StructField("County Name", T.StringType()),
    T.StructField("POPULATION_SERVED_COUNT", T.LongType()),
])

ADVISORY_CSV_FIELDS_A = ["type", "location", "start_date", "end_date", "publish_date",
                         "county", "state", "link", "summary"]
ADVISORY_CSV_FIELDS_B = ["type", "location", "start_date", "end_date", "publish_date",
                         "county", "state", "link"]
SNIPPET_CSV_FIELDS = ["county", "state", "link", "snippet", "publish_date"]
ARTICLE_FIELDS = ["title", "author", "date", "publisher", "url", "description", "text"]


def state_names(spark: SparkSession) -> DataFrame:
    """56-row dimension: abbreviation, name, and geo_name (suffix-free name)."""
    df = spark.createDataFrame(STATE_NAMES, "abbreviation string, name string")
    from pyspark.sql import functions as F
    return df.withColumn("geo_name", F.regexp_replace("name", r" [A-Z]{2}$", ""))

