import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    s = (SparkSession.builder.master("local[*]")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.ui.enabled", "false")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    from civicscan.session import checkpoint_dir
    checkpoint_dir(s)
    yield s


@pytest.fixture(scope="session")
def duck():
    from tools.oracle_check import duck as make
    return make


def rows(df):
    """Order-insensitive, column-name-sorted rows of a Spark DataFrame."""
    from tools.oracle_check import rows_of
    return rows_of(df.columns, df.collect())
