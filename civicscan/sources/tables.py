"""Readers for the parquet tables of a data directory."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

DRIVER_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
                 "events", "documents", "embeddings", "pages", "benchmark", "labels",
                 "conversations"]


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Lazy parquet scan; Catalyst prunes columns and pushes filters into it."""
    return spark.read.parquet(table_path(sf_dir, name))


def read_partitioned(spark: SparkSession, path: str) -> DataFrame:
    """Scan of a ``partitionBy`` layout; filters on partition columns prune directories."""
    return spark.read.option("basePath", path).parquet(path)


STATE_GEO_SCHEMA = ("name string, minx double, miny double, maxx double, maxy double, "
                    "cx double, cy double")
PAGE_SCHEMA = ("page_id long, url string, final_url string, status_code int, "
               "http_last_modified string, html string")


def read_state_geo(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """State extent / centre dimension (name, minx, miny, maxx, maxy, cx, cy)."""
    r = spark.read.schema(STATE_GEO_SCHEMA)
    return r.option("header", True).csv(path) if fmt == "csv" else r.parquet(path)
