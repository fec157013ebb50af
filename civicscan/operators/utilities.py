"""Utility operators: size threshold, utility x year requests, crosswalk join,
seeded county sample, keep-first per county, query-text templates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from .feed import keep_first

# Seeded sample order: a 32-bit integer mix (add seed, then xor-shift /
# multiply rounds), written with arithmetic both Spark and SQL engines share.
SAMPLE_SEED_MULT = 2654435761
SAMPLE_MIX_MULT = 73244475
SAMPLE_HASH_MOD = 1 << 32


def over_threshold(df: DataFrame, threshold: int = schemas.POPULATION_THRESHOLD,
                   column: str = "population_served_count") -> DataFrame:
    """Strictly above the threshold; null populations drop out."""
    return df.where(F.col(column) > F.lit(threshold))


def template(fmt: str, **cols: Column) -> Column:
    """``{name}`` placeholders of ``fmt`` filled from columns (concat)."""
    import re
    parts: list[Column] = []
    pos = 0
    for m in re.finditer(r"\{(\w+)\}", fmt):
        if m.start() > pos:
            parts.append(F.lit(fmt[pos:m.start()]))
        parts.append(cols[m.group(1)].cast("string"))
        pos = m.end()
    if pos < len(fmt):
        parts.append(F.lit(fmt[pos:]))
    return F.concat(*parts)


def year_requests(utilities: DataFrame, years: tuple[int, int] = schemas.REQUEST_YEARS,
                  fmt: str = schemas.UTILITY_YEAR_QUERY) -> DataFrame:
    """J2 + F11: one search request per utility and year (generator, no join)."""
    ex = utilities.select("utility_id", F.col("county_name").alias("county"),
                          F.col("state_code").alias("state"),
                          F.explode(F.sequence(F.lit(years[0]).cast("bigint"),
                                               F.lit(years[1]).cast("bigint"))).alias("year"))
    return ex.withColumn("query", template(fmt, year=F.col("year"), county=F.col("county"),
                                           state=F.col("state")))


def with_crosswalk(utilities: DataFrame, crosswalk: DataFrame, key: str = "county_fips") -> DataFrame:
    """Inner equi-join on the county code; the planner broadcasts the
    crosswalk where its size is under the session's limit."""
    return utilities.join(crosswalk, key, "inner")


def sample_rank(code: Column, seed: int) -> Column:
    x = (code + F.lit(seed) * F.lit(SAMPLE_SEED_MULT)) % F.lit(SAMPLE_HASH_MOD)
    for _ in range(2):
        x = (x.bitwiseXOR(F.shiftright(x, 16)) * F.lit(SAMPLE_MIX_MULT)) % F.lit(SAMPLE_HASH_MOD)
    return x.bitwiseXOR(F.shiftright(x, 16))


def county_sample(spark: SparkSession, utilities: DataFrame, seed: int = 0,
                  fixed: Sequence[int] = tuple(schemas.SAMPLE_FIXED_CODES),
                  code_range: tuple[int, int] = schemas.SAMPLE_CODE_RANGE,
                  size: int = schemas.SAMPLE_SIZE, key: str = "county_fips") -> DataFrame:
    """O4 + U3: the fixed codes plus (size - len(fixed)) distinct codes present
    in the data and inside the range, drawn in a seeded hash order.

    The draw is a global top-k (TakeOrderedAndProject: per-partition top-k,
    then a merge of k rows per partition), bounded by ``size``.
    """
    fixed_df = spark.createDataFrame([(int(c), 0) for c in fixed], f"{key} long, drawn int")
    pool = (utilities.select(F.col(key).cast("bigint").alias(key))
            .where(F.col(key).between(code_range[0], code_range[1]))
            .where(~F.col(key).isin([int(c) for c in fixed]))
            .distinct())
    drawn = (pool.orderBy(sample_rank(F.col(key), seed), F.col(key))
             .limit(max(size - len(fixed), 0))
             .select(key, F.lit(1).alias("drawn")))
    return fixed_df.unionByName(drawn)


def county_first(utilities: DataFrame, codes: DataFrame, key: str = "county_fips") -> DataFrame:
    """P11 + A2 + F10: utilities in the sampled codes (left semi join against a
    table bounded by the sample size), first utility per county, state taken
    from the first two characters of the system id."""
    picked = utilities.join(F.broadcast(codes.select(key)), key, "left_semi")
    first = keep_first(picked, key, [F.col("utility_id").asc_nulls_last()])
    return first.select(key, "utility_id", "pwsid", F.col("county_name").alias("county"),
                        F.left(F.col("pwsid"), F.lit(2)).alias("state"))


def county_requests(counties: DataFrame, fmt: str) -> DataFrame:
    """F11 over a county table (county, state columns)."""
    return counties.withColumn("query", template(fmt, county=F.col("county"), state=F.col("state")))
