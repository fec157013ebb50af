"""Join helpers: a Bloom filter that cuts a wide table in its scan stage, and
a lookup that salts only the keys that are hot."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of a Bloom filter for each key, the bounds of its size, and the bits a key sets.
BITS_PER_KEY = 12
LEAST_BITS, MOST_BITS = 1 << 12, 1 << 26
HASHES = 4

#: A key is hot if it stands behind more than one row in so many; there are fewer such keys than that.
HOT_SHARE = 128
#: Keys that the counting sketch tracks at a time.
TRACKED = 8192
#: Tasks over which a hot key's rows are dealt.
SALTS = 16


def filter_bits(n: int) -> int:
    """Size of a filter for ``n`` keys, a power of two between the bounds: at
    most 8 MB.  With more keys than that is made for it lets more rows pass."""
    return min(MOST_BITS, max(LEAST_BITS, 1 << math.ceil(math.log2(max(2, n * BITS_PER_KEY)))))


def _places(key: Column, bits: int) -> list[Column]:
    return [F.xxhash64(key, F.lit(i)).bitwiseAND(F.lit(bits - 1)) for i in range(HASHES)]


def bloom_filter(keys: DataFrame, n: int) -> DataFrame:
    """One row with the filter of the column of ``keys`` as an array of longs.

    Each key sets its bits in 64-bit words; words are or-ed in every map task
    before the shuffle, so what is gathered is at most the filter's own size."""
    bits = filter_bits(n)
    place = F.explode(F.array(*_places(F.col(keys.columns[0]), bits))).alias("p")
    words = (keys.select(place).groupBy(F.shiftright("p", 6).alias("id"))
             .agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("p").bitwiseAND(F.lit(63)).cast("int"))).alias("w")))
    dense = keys.sparkSession.range(bits // 64).join(words, "id", "left").select("id", F.coalesce("w", F.lit(0)).alias("w"))
    return dense.agg(F.array_sort(F.collect_list(F.struct("id", "w"))).getField("w").alias("words"))


def may_hold(words: Column, key: Column, n: int) -> Column:
    """Whether the filter may hold ``key``: never false for a key that it holds."""
    def bit(p: Column) -> Column:
        word = F.get(words, F.shiftright(p, 6).cast("int"))
        return F.call_function("shiftrightunsigned", word, p.bitwiseAND(F.lit(63)).cast("int")).bitwiseAND(F.lit(1).cast("long")) == 1
    found = [bit(p) for p in _places(key, filter_bits(n))]
    out = found[0]
    for b in found[1:]:
        out = out & b
    return key.isNotNull() & out


def keep_asked(table: DataFrame, column: str, keys: DataFrame) -> DataFrame:
    """The rows of ``table`` whose ``column`` is among ``keys`` (one column, no
    repeats, stored).

    A Bloom filter of the keys is tested where the table is scanned, so only
    its hits reach the semi-join that decides, and a shuffle if that needs one."""
    n = keys.count()
    words = bloom_filter(keys, n).scalar()
    hits = table.filter(may_hold(words, F.col(column), n))
    return hits.join(keys, hits[column] == keys[keys.columns[0]], "left_semi")


def hot_keys(rows: DataFrame, key: str) -> list:
    """The keys behind more than one in ``HOT_SHARE`` of the rows, by a counting
    sketch that is kept per map task and merged; it names every such key and
    may name some that are a little rarer."""
    top = rows.agg(F.count(key).alias("n"), F.expr(f"approx_top_k(`{key}`, {HOT_SHARE}, {TRACKED})").alias("top")).first()
    return sorted(t["item"] for t in top["top"] if t["item"] is not None and t["count"] * HOT_SHARE > top["n"])


def salted_lookup(rows: DataFrame, table: DataFrame, key: str, salts: int = SALTS, like: DataFrame | None = None) -> DataFrame:
    """Left join of ``rows`` with a narrow ``table`` that has one row per ``key``.

    A key may stand behind a large share of ``rows`` (a site's landing page
    behind most results).  The rows of hot keys are dealt over ``salts`` values
    and those keys' table rows copied for each of them; all other keys keep one
    row.  ``like`` is a stored table with the same keys to count instead of
    ``rows``.  The result is that of the plain left join.
    """
    hot = hot_keys(rows if like is None else like, key)
    if not hot:
        return rows.join(table, key, "left")
    is_hot = F.coalesce(F.col(key).isin(hot), F.lit(False))
    deal = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in rows.columns]), F.lit(salts))
    copies = F.when(is_hot, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0))).cast("array<bigint>")
    dealt = rows.withColumn("_salt", F.when(is_hot, deal).otherwise(F.lit(0).cast("long")))
    return dealt.join(table.withColumn("_salt", F.explode(copies)), [key, "_salt"], "left").drop("_salt")
