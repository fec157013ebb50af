"""Two-pass external shuffle into shards.

Pass 1 scatters records into buckets of a size that fits a task's memory, by a
seeded hash of the record's place in the input, so no key or text can fill a
bucket.  Pass 2 shuffles each bucket (Fisher-Yates, Spark's ``shuffle``) and
writes it.  The written buckets, one after the other, are one random order of
all records; shards deal that order round.  Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from civicscan.llm.common import fresh, materialize

SHARDS = 40
SEED = 20240229
BUCKET_BYTES = 8 << 20
ROW_BYTES = 16
#: Buckets whose counts are summed together before the sums themselves are.
_GROUP = 1024


def size_of(text_col: str = "text"):
    return F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long") + ROW_BYTES


def bucket_count(df: DataFrame, text_col: str = "text", bucket_bytes: int = BUCKET_BYTES) -> int:
    """Buckets of ``bucket_bytes`` at most on average; a small table gets more, to keep all tasks busy."""
    total = df.agg(F.sum(size_of(text_col))).first()[0] or 0
    return max(-(-total // bucket_bytes), 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def shuffled(df: DataFrame, text_col: str = "text", seed: int = SEED, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """Both passes: all columns of ``df`` as struct ``record``, with ``bucket`` and ``at``
    (its place in the shuffled bucket), written to the shared folder: a task
    that is run again later reads the same order."""
    n = bucket_count(df, text_col, bucket_bytes)
    place = fresh(df, "__bucket")
    scattered = (df.withColumn(place, F.pmod(F.xxhash64(F.lit(seed), F.monotonically_increasing_id()), F.lit(n)).cast("int"))
                 .select(F.col(place).alias("bucket"), F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("record")))
    # a fixed order before the shuffle: the same task draws the same permutation
    buckets = (scattered.groupBy("bucket").agg(F.collect_list("record").alias("records"))
               .sortWithinPartitions("bucket"))
    rows = buckets.select("bucket", F.posexplode(F.shuffle("records", seed)).alias("at", "record"))
    return materialize(rows, "shards")


def shard(df: DataFrame, text_col: str = "text", shards: int = SHARDS, seed: int = SEED,
          bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """``record, shard, slot``: every record of ``df`` in a shard, at a slot that counts from 0 without gaps.

    Law ``rows``: shard sizes in rows differ by at most one.  Records are
    placed one by one, so equal texts, repeated rows, null ids and null texts
    (size ``ROW_BYTES``) need no special case; an empty table gives an empty
    result.
    """
    rows = shuffled(df, text_col, seed, bucket_bytes)
    count = rows.groupBy("bucket").agg(F.count("*").alias("n")).withColumn("g", (F.col("bucket") / _GROUP).cast("int"))
    count = materialize(count, "shards-count")
    # prefix sums in two levels: inside groups of buckets, then over the groups
    inner = Window.partitionBy("g").orderBy("bucket")
    outer = Window.orderBy("g")
    groups = count.groupBy("g").agg(F.sum("n").alias("m")).select("g", (F.sum("m").over(outer) - F.col("m")).alias("before"))
    base = (count.withColumn("inside", F.sum("n").over(inner) - F.col("n")).join(groups, "g")
            .select("bucket", (F.col("before") + F.col("inside")).alias("base")))
    base = materialize(base, "shards-base")
    place = F.col("base") + F.col("at")
    return rows.join(base, "bucket").select(
        "record", (place % shards).cast("int").alias("shard"), F.floor(place / shards).cast("long").alias("slot"))


def write_shards(df: DataFrame, path: str, **options) -> None:
    """Write every record into its shard's folder, in slot order within a file."""
    (shard(df, **options).select("record.*", "shard", "slot").repartition("shard")
     .sortWithinPartitions("shard", "slot").write.mode("overwrite").partitionBy("shard").parquet(path))
