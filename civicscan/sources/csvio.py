"""CSV sources and sinks.

Readers always take an explicit schema (no inference).  Sinks write
directories of part files through the DataFrame writer: overwrite for
reports, append for incremental advisory lists (a header per part file, read
back transparently with ``header=True``), append by run for jobs that may be
retried (``runs``), and dynamic partition overwrite for per-year folders.  No index column is ever written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import csv_split, runs

NEWS_SCHEMA = ("publish_time timestamp_ntz, link string, source string, location_type bigint, "
               "location_fullname string, country_code string, adm1_code string, "
               "latitude double, longitude double")
READ_OPTIONS = {"mode": "PERMISSIVE", "escape": '"', "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]"}


def read_csv(spark: SparkSession, path: str | list[str], schema: T.StructType | str, multi_line: bool = False) -> DataFrame:
    """Header row, explicit schema, malformed rows kept as nulls.

    ``multi_line`` reads fields with line breaks, still as many tasks per file
    (``csv_split``); it scans the text up to three times, so it is off unless
    asked for."""
    if multi_line:
        return csv_split.read(spark, path, schema, READ_OPTIONS)
    return spark.read.schema(schema).option("header", True).options(**READ_OPTIONS).csv(path)


def read_news_csv(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """A news report written by ``write_csv`` (parsed rows, one per link)
    read back with its schema; empty text fields come back as null."""
    return read_csv(spark, path, NEWS_SCHEMA, multi_line)


def for_csv(df: DataFrame) -> DataFrame:
    """Sink view: dates as MM/DD/YYYY text, nulls in text columns as ''."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DateType):
            c = F.coalesce(F.date_format(c, "MM/dd/yyyy"), F.lit(""))
        elif isinstance(f.dataType, T.StringType):
            c = F.coalesce(c, F.lit(""))
        cols.append(c.alias(f.name))
    return df.select(*cols)


def _writer(df: DataFrame, mode: str):
    return (df.write.mode(mode).option("header", True).option("escape", '"')
            .option("emptyValue", "").option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False))


def write_csv(df: DataFrame, path: str) -> None:
    """Overwrite a report directory."""
    _writer(for_csv(df), "overwrite").csv(path)


def append_csv(df: DataFrame, path: str) -> None:
    """Append rows; the header is written with every part file and
    skipped on read.  A retried job appends again: see ``append_run``."""
    _writer(for_csv(df), "append").csv(path)


def append_run(df: DataFrame, path: str, run_id: str) -> bool:
    """S7 / S8 for jobs that are retried: the rows of ``run_id`` count once,
    those of its first attempt that ends; false if that was an earlier one,
    whose rows stay.  Read back with ``read_runs``."""
    spark = df.sparkSession
    if runs.is_committed(spark, path, run_id):
        return False
    attempt, folder = runs.new_attempt(path)
    _writer(for_csv(df), "errorifexists").csv(folder)
    return runs.commit(spark, path, run_id, attempt)


def read_runs(spark: SparkSession, path: str, schema: T.StructType | str, multi_line: bool = False) -> DataFrame:
    """The rows of all runs that ended; none if there is no such run."""
    folders = runs.committed(spark, path)
    return read_csv(spark, folders, schema, multi_line) if folders else spark.createDataFrame([], schema)


def write_by_year(df: DataFrame, path: str, column: str = "year") -> None:
    """One folder per year, replacing only the years present in ``df``."""
    (_writer(for_csv(df), "overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(column).csv(path))


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Default table sink (columnar, pushdown-friendly)."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
