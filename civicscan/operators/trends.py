"""Trend operators over parsed news rows: location-type counts, state lookup,
dense counts per year / state / (year, state), state map table and extent.

All counts are partial + final hash aggregates; dimension tables (states,
years) have a fixed size and are broadcast.  Dense outputs are built from the
dimension side (generator over the year range), never by a cross join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas


def location_type_counts(df: DataFrame, types: Sequence[int] = (1, 2, 3)) -> DataFrame:
    """Rows per location type, one pass, one row."""
    return df.agg(*[F.count_if(F.col("location_type") == t).cast("bigint").alias(f"n_type{t}")
                    for t in types])


def non_country_rows(df: DataFrame, country_type: int = 1) -> DataFrame:
    """location_type <> 1, keeping null types."""
    return df.where(~F.col("location_type").eqNullSafe(country_type))


def with_state_code(df: DataFrame) -> DataFrame:
    """state abbreviation = adm1_code from its third character."""
    return df.withColumn("state_code", F.substr("adm1_code", F.lit(3)))


def lookup_state(df: DataFrame, states: DataFrame) -> DataFrame:
    """Abbreviation -> name by broadcast left join (unknown -> null name)."""
    dim = F.broadcast(states.select(F.col("abbreviation").alias("state_code"),
                                    F.col("name").alias("state")))
    return with_state_code(df).join(dim, "state_code", "left")


def unknown_states(df: DataFrame, states: DataFrame) -> DataFrame:
    """Quarantine for J5: rows whose abbreviation has no name."""
    dim = F.broadcast(states.select(F.col("abbreviation").alias("state_code")))
    return with_state_code(df).join(dim, "state_code", "left_anti")


def year_dim(spark: SparkSession, years: tuple[int, int] = schemas.TREND_YEARS) -> DataFrame:
    return spark.range(years[0], years[1] + 1).select(F.col("id").alias("year"))


def counts_by_year(df: DataFrame, years: tuple[int, int] = schemas.TREND_YEARS) -> DataFrame:
    """A4 + O1: dense counts per year in the range, zero years included."""
    counts = (df.where(F.year("publish_time").between(years[0], years[1]))
              .groupBy(F.year("publish_time").cast("bigint").alias("year"))
              .agg(F.count(F.lit(1)).alias("n")))
    dim = year_dim(df.sparkSession, years)
    return (dim.join(F.broadcast(counts), "year", "left")
            .select("year", F.coalesce("n", F.lit(0)).cast("bigint").alias("n"))
            .orderBy("year"))


def counts_by_state(df: DataFrame) -> DataFrame:
    """A5: rows per state name, most frequent first."""
    return (df.groupBy("state").agg(F.count(F.lit(1)).alias("n"))
            .orderBy(F.desc("n"), F.asc_nulls_last("state")))


def counts_by_state_year(df: DataFrame, states: DataFrame,
                         years: tuple[int, int] = schemas.TREND_YEARS) -> DataFrame:
    """Dense (year, state) counts over every state name and year."""
    counts = (df.where(F.year("publish_time").between(years[0], years[1]))
              .groupBy(F.year("publish_time").cast("bigint").alias("year"), "state")
              .agg(F.count(F.lit(1)).alias("n")))
    dense = states.select(F.col("name").alias("state"),
                          F.explode(F.sequence(F.lit(years[0]).cast("bigint"),
                                               F.lit(years[1]).cast("bigint"))).alias("year"))
    # counts has at most (#years x #states) rows: a proven bound, so broadcast
    return (dense.join(F.broadcast(counts), ["year", "state"], "left")
            .select("year", "state", F.coalesce("n", F.lit(0)).cast("bigint").alias("n")))


def state_geo_from_points(located: DataFrame, states: DataFrame) -> DataFrame:
    """S13 stand-in: per-state extent and centre of the observed coordinates.

    ``located`` carries ``state`` (looked-up name), latitude and longitude.
    Output: name (suffix-free), minx, miny, maxx, maxy, cx, cy.
    """
    regions = states.where(~F.col("abbreviation").isin(list(schemas.MAP_NO_GEOMETRY)))
    named = located.join(F.broadcast(regions.select(F.col("name").alias("state"), "geo_name")),
                         "state")
    return (named.where(F.col("latitude").isNotNull() & F.col("longitude").isNotNull())
            .groupBy(F.col("geo_name").alias("name"))
            .agg(F.min("longitude").alias("minx"), F.min("latitude").alias("miny"),
                 F.max("longitude").alias("maxx"), F.max("latitude").alias("maxy"))
            .withColumn("cx", (F.col("minx") + F.col("maxx")) / 2)
            .withColumn("cy", (F.col("miny") + F.col("maxy")) / 2))


def state_map_table(state_year_counts: DataFrame, geo: DataFrame, states: DataFrame,
                    excluded: Sequence[str] = tuple(schemas.MAP_EXCLUDED_REGIONS)) -> DataFrame:
    """J4 + P12 + F30: every region of the state geometry set per year with
    its count (0 if none) and the count as label text; excluded regions
    dropped."""
    dim = (states.where(~F.col("abbreviation").isin(list(schemas.MAP_NO_GEOMETRY)))
           .select(F.col("name").alias("state"), F.col("geo_name").alias("name")))
    merged = (state_year_counts.join(F.broadcast(dim), "state")
              .join(F.broadcast(geo), "name", "left"))
    return (merged.where(~F.col("name").isin(list(excluded)))
            .select("year", "name", F.coalesce("n", F.lit(0)).cast("bigint").alias("n"),
                    F.coalesce("n", F.lit(0)).cast("bigint").cast("string").alias("label"),
                    "cx", "cy"))


def state_extent(geo: DataFrame, excluded: Sequence[str] = tuple(schemas.MAP_EXCLUDED_REGIONS),
                 pad: float = schemas.MAP_PAD_FRACTION) -> DataFrame:
    """A7 + A8: bounds of the mapped states and the padded extent."""
    b = (geo.where(~F.col("name").isin(list(excluded)))
         .agg(F.min("minx").alias("minx"), F.min("miny").alias("miny"),
              F.max("maxx").alias("maxx"), F.max("maxy").alias("maxy")))
    px = (F.col("maxx") - F.col("minx")) * F.lit(pad)
    py = (F.col("maxy") - F.col("miny")) * F.lit(pad)
    return b.select("minx", "miny", "maxx", "maxy",
                    (F.col("minx") - px).alias("xlim_lo"), (F.col("maxx") + px).alias("xlim_hi"),
                    (F.col("miny") - py).alias("ylim_lo"), (F.col("maxy") + py).alias("ylim_hi"))
