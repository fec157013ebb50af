"""News-feed operators: partition-ranged scan, slug filter, location unnest/parse,
country filter, keep-first dedupe per link, keyword split.

Plan shape of ``us_locations``: FileScan (partition filter, 4 columns) ->
Filter(slug) -> Generate(explode of pre-filtered, pre-split records) ->
Project.  No shuffle.  ``first_per_link`` adds one Exchange on ``link`` with a
partial WindowGroupLimit before it, so a link holding a third of all rows is
cut to one row per map task before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import schemas

# Field offsets of a '#'-delimited location record.
LOC_TYPE, LOC_FULLNAME, LOC_COUNTRY, LOC_ADM1, LOC_LAT, LOC_LON = 0, 1, 2, 3, 5, 6

def scan_range(df: DataFrame, start: str = "2013-01-01", end: str | None = None,
               partition_col: str = "partition_date") -> DataFrame:
    """Keep partitions in [start, end]; ``end`` defaults to today.

    On a ``partitionBy(partition_col)`` layout this becomes a PartitionFilter
    (directory pruning); on a flat table it is a pushed-down row filter.
    """
    hi = F.current_date() if end is None else F.lit(end).cast("date")
    return df.where(F.col(partition_col).between(F.lit(start).cast("date"), hi))


def slug_pattern(words: Sequence[str]) -> str:
    return "%" + "%".join(w.lower() for w in words) + "%"


def slug_filter(df: DataFrame, column: str = "document_identifier",
                words: Sequence[str] = tuple(schemas.SLUG_WORDS)) -> DataFrame:
    """Case-insensitive ordered-words LIKE match."""
    return df.where(F.lower(F.col(column)).like(slug_pattern(words)))


def parse_gkg_date(c: Column) -> Column:
    """14-digit yyyyMMddHHmmss integer -> wall-clock timestamp (no zone)."""
    return F.try_to_timestamp(c.cast("string"), F.lit("yyyyMMddHHmmss")).cast("timestamp_ntz")


def candidates(gkg: DataFrame, start: str = "2013-01-01", end: str | None = None,
               words: Sequence[str] = tuple(schemas.SLUG_WORDS)) -> DataFrame:
    """S1 + P1 + R1 + F1: the scanned, slug-matched, renamed news rows."""
    df = slug_filter(scan_range(gkg, start, end), "document_identifier", words)
    return df.select(
        parse_gkg_date(F.col("gkg_date")).alias("publish_time"),
        F.col("document_identifier").alias("link"),
        F.col("source_common_name").alias("source"),
        F.col("v2locations"),
    )


def _record_parts(loc_list: Column, country: str | None) -> Column:
    """Split the ';' list once and each record once; keep matching records.

    Filtering inside the array (before the generator) is the pushdown the
    optimizer cannot do through Generate.
    """
    parts = F.transform(F.split(loc_list, ";"), lambda r: F.split(r, "#"))
    if country is None:
        return parts
    return F.filter(parts, lambda p: F.get(p, LOC_COUNTRY) == F.lit(country))


def unnest_locations(cands: DataFrame, country: str | None = "US") -> DataFrame:
    """J1 + R2 + P2 + F3–F5: one typed row per location record of the country.

    A null list yields no rows; short records give nulls (then fail P2).
    """
    # explode_outer + null filter: a plain explode makes the optimizer push an
    # inferred size(...) > 0 filter below the projection, evaluating the
    # split/filter expression twice per row.
    exploded = (cands.select("publish_time", "link", "source",
                             F.explode_outer(_record_parts(F.col("v2locations"), country)).alias("p"))
                .where(F.col("p").isNotNull()))
    p = F.col("p")
    return exploded.select(
        "publish_time", "link", "source",
        F.get(p, LOC_TYPE).try_cast("bigint").alias("location_type"),
        F.get(p, LOC_FULLNAME).alias("location_fullname"),
        F.get(p, LOC_COUNTRY).alias("country_code"),
        F.get(p, LOC_ADM1).alias("adm1_code"),
        F.get(p, LOC_LAT).try_cast("double").alias("latitude"),
        F.get(p, LOC_LON).try_cast("double").alias("longitude"),
    )


def us_locations(gkg: DataFrame, start: str = "2013-01-01", end: str | None = None,
                 words: Sequence[str] = tuple(schemas.SLUG_WORDS),
                 country: str = "US") -> DataFrame:
    """K1 before dedupe: scan -> slug -> unnest -> parse -> country."""
    return unnest_locations(candidates(gkg, start, end, words), country)


def first_order() -> list[Column]:
    """Total order that makes keep-first deterministic (every column takes part)."""
    return [F.col(c).asc_nulls_last() for c in
            ["publish_time", "location_type", "location_fullname", "source", "adm1_code",
             "latitude", "longitude", "country_code"]]


def keep_first(df: DataFrame, key: str | Sequence[str], order: list[Column]) -> DataFrame:
    """One row per key, the first under ``order``.

    row_number()=1 plans as WindowGroupLimit(Partial) -> Exchange ->
    WindowGroupLimit(Final): hot keys are reduced map-side.
    """
    keys = [key] if isinstance(key, str) else list(key)
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def first_per_link(parsed: DataFrame) -> DataFrame:
    """A1: keep-first row per link."""
    return keep_first(parsed, "link", first_order())


def keyword_regex(words: Sequence[str] = tuple(schemas.NOTICE_KEYWORDS)) -> str:
    return "(?i)" + "|".join(words)


def keyword_match(c: Column, words: Sequence[str] = tuple(schemas.NOTICE_KEYWORDS)) -> Column:
    """P6 predicate: any keyword, case-insensitive; null -> false."""
    return F.coalesce(c.rlike(keyword_regex(words)), F.lit(False))


def keyword_include(df: DataFrame, column: str = "link",
                    words: Sequence[str] = tuple(schemas.NOTICE_KEYWORDS)) -> DataFrame:
    """P6."""
    return df.where(keyword_match(F.col(column), words))


def keyword_exclude(df: DataFrame, column: str = "link",
                    words: Sequence[str] = tuple(schemas.NOTICE_KEYWORDS)) -> DataFrame:
    """The complement of P6 (null links land here)."""
    return df.where(~keyword_match(F.col(column), words))


def excluded_count(df: DataFrame, column: str = "link",
                   words: Sequence[str] = tuple(schemas.NOTICE_KEYWORDS)) -> DataFrame:
    """One-row count of the excluded side (partial + final aggregate)."""
    return keyword_exclude(df, column, words).agg(F.count(F.lit(1)).alias("n_excluded"))
