"""Page dates as pages arrive.

The crawler drops new page files (``sources.tables.PAGE_SCHEMA``) into a
folder; each trigger runs the batch page-date operator over the new files
only and appends one row per HTTP-200 page to a parquet table.  The job is
stateless per page (no shuffle, no state store); the checkpoint makes each
file count exactly once across restarts.  ``trigger(availableNow=True)``
turns it into an incremental batch run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators import dates
from ..sources.tables import PAGE_SCHEMA


def page_dates_stream(spark: SparkSession, source_dir: str, max_files_per_trigger: int = 1000) -> DataFrame:
    pages = (spark.readStream.schema(PAGE_SCHEMA).option("maxFilesPerTrigger", max_files_per_trigger)
             .parquet(source_dir))
    return dates.page_dates(pages)


def run_page_dates_stream(spark: SparkSession, source_dir: str, sink_dir: str,
                          checkpoint_dir: str, **kwargs) -> StreamingQuery:
    from ..session import ship_package
    ship_package(spark)
    return (page_dates_stream(spark, source_dir, **kwargs).writeStream.format("parquet")
            .option("path", sink_dir).option("checkpointLocation", checkpoint_dir)
            .outputMode("append").trigger(availableNow=True).start())
