"""Appends that a retried job doesn't repeat.

A table is a folder with ``parts/<attempt>/`` (what one attempt to append
wrote) and ``runs/<run id>`` (a small file that names the attempt which counts).
An attempt's files count from the moment its run's file gets its name: that
rename happens as a whole and fails if the name is taken, so a run counts once
however often it is tried, and an attempt that dies, between files or before
the rename, adds nothing.  Readers take only the attempts that runs name.
"""

from __future__ import annotations

import uuid
from urllib.parse import quote

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _path(*parts: str, spark: SparkSession):
    return spark._jvm.org.apache.hadoop.fs.Path("/".join(parts))


def _files(spark: SparkSession, path: str):
    return _path(path, spark=spark).getFileSystem(spark._jsc.hadoopConfiguration())


def _run_file(spark: SparkSession, path: str, run_id: str):
    if not run_id:
        raise ValueError("a run needs an id")
    return _path(path, "runs", "run-" + quote(run_id, safe=""), spark=spark)


def new_attempt(path: str) -> tuple[str, str]:
    """The name of an attempt, and the folder for its files."""
    attempt = uuid.uuid4().hex
    return attempt, f"{path}/parts/{attempt}"


def is_committed(spark: SparkSession, path: str, run_id: str) -> bool:
    return _files(spark, path).exists(_run_file(spark, path, run_id))


def commit(spark: SparkSession, path: str, run_id: str, attempt: str) -> bool:
    """Let ``attempt`` count as ``run_id``; false if another attempt does already."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    files, target = _files(spark, path), _run_file(spark, path, run_id)
    waiting = _path(path, "waiting", attempt, spark=spark)
    out = files.create(waiting, False)
    try:
        out.write(bytearray(attempt, "utf-8"))
    finally:
        out.close()
    files.mkdirs(target.getParent())
    context = hadoop.FileContext.getFileContext(files.getUri(), spark._jsc.hadoopConfiguration())
    keep_existing = spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 0)
    try:
        context.rename(waiting, target, keep_existing)
    except Py4JJavaError:
        files.delete(waiting, False)
        if not files.exists(target):
            raise
        return False
    return True


def committed(spark: SparkSession, path: str) -> list[str]:
    """The folders that count, one per run (as many names as the table has runs)."""
    if not _files(spark, path).exists(_path(path, "runs", spark=spark)):
        return []
    named = spark.read.text(f"{path}/runs").sort("value").collect()
    return [f"{path}/parts/{r.value}" for r in named]
