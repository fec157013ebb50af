"""Order MinHash fingerprints of whole texts.

Each k-mer of a text (k code points) is numbered by its occurrence, so a text
is a set of (k-mer, occurrence) pairs.  Each of m hash functions picks the l
pairs with the smallest values; their hashes, in text order, form a tuple, and
the tuple's hash is one component of the signature.  Components agree when the
same k-mers stand in the same order, so the share of equal components falls
with edit distance, not only with the sets' difference.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicscan.llm.common import ship_package

K = 8
L = 2
M = 48
SEED = 2024
_ONE = np.uint64(1)
_BASE = 0x100000001B3


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer (multiply and shift rounds)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _factors(m: int, seed: int) -> np.ndarray:
    """m odd 32-bit multipliers: each makes one order of the 32-bit values."""
    at = np.uint64(seed * 0x9E3779B97F4A7C15 % (1 << 64))
    return _mix(np.arange(1, m + 1, dtype=np.uint64) + at).astype(np.uint32) | np.uint32(1)


def numbered_kmers(points: np.ndarray, k: int = K) -> np.ndarray:
    """64-bit hashes of the (k-mer, occurrence) pairs of a text, in text order.
    A shorter text that isn't empty is one k-mer."""
    k = min(k, len(points))
    if not k:
        return np.zeros(0, np.uint64)
    n = len(points) - k + 1
    # polynomial hashes of 1, 2, 4, ... code points, joined to k by the bits of k
    power, step, width, h, done = points, _BASE, 1, None, 0
    while width <= k:
        if k & width:
            part = power[done:done + n]
            h = part if h is None else h * np.uint64(step) + part
            done += width
        power = power[:-width] * np.uint64(step) + power[width:] if 2 * width <= len(points) else power
        step, width = step * step % (1 << 64), 2 * width
    h = _mix(h + np.uint64(k))
    # sort with the position in the low bits: equal k-mers stand together in text order
    bits = np.uint64(int(n).bit_length())
    s = np.sort((h >> bits << bits) | np.arange(n, dtype=np.uint64))
    at = (s & ((_ONE << bits) - _ONE)).astype(np.int64)
    kmer = s >> bits
    first = np.flatnonzero(np.concatenate([[True], kmer[1:] != kmer[:-1]]))
    run = np.diff(np.append(first, n))
    number = np.empty(n, np.uint64)
    number[at] = np.arange(n) - np.repeat(first, run)
    return np.where(number == 0, h, _mix(h + number * np.uint64(0x9E3779B97F4A7C15)))


def signature(points: np.ndarray, k: int = K, l: int = L, m: int = M, seed: int = SEED) -> np.ndarray:  # noqa: E741
    """m components of 32 bits.  With fewer than l pairs a tuple holds what there is."""
    h = numbered_kmers(points, k)
    if not len(h):
        return np.zeros(m, np.uint32)
    small = (h >> np.uint64(32)).astype(np.uint32)
    out = np.full(m, 7, np.uint64)
    rows = max(1, (1 << 18) // len(h))
    for a in range(0, m, rows):
        v = _factors(m, seed)[a:a + rows, None] * small[None, :]
        at = np.arange(len(v))
        picks = np.empty((min(l, len(h)), len(v)), np.int64)
        for i in range(len(picks)):
            picks[i] = p = v.argmin(axis=1)
            v[at, p] = np.iinfo(np.uint32).max
        picks.sort(axis=0)
        for p in picks:
            out[a:a + rows] = _mix(out[a:a + rows] * np.uint64(0x100000001B3) + h[p])
    return (out >> np.uint64(32)).astype(np.uint32)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    return float((a == b).mean())


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)


def edited(text: str, following: str) -> str:
    """``text`` with its last half (rounded down) replaced by as much of the start of ``following`` as there is."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def with_next(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows ``(bucket, id, t, extra)`` such that, in a bucket in order of
    (id, t), each row's successor by ascending id follows it; a bucket ends
    with extra rows, the first of the next bucket (of the last: the first).

    Buckets are ranges of ids between quantiles (one bound per bucket goes
    through the driver).  The table is shuffled once.
    """
    spark = df.sparkSession
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("binary").alias("t"))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    got = rows.select("id").agg(F.percentile_approx("id", [i / n for i in range(1, n)], 10_000).alias("q"),
                                F.min("id").alias("low"), F.count(F.when(F.col("id").isNull(), 1)).alias("nulls")).first()
    bounds = sorted({x for x in (got.q or []) if x != got.low})
    lows = ([None] if got.nulls else []) + ([got.low] if got.low is not None else []) + bounds
    # the smallest id of each bucket; nulls come first
    known = F.array(*[F.lit(x).cast("long") for x in lows if x is not None])
    bucket = F.when(F.col("id").isNull(), F.lit(0)).otherwise(
        F.size(F.filter(known, lambda x: x <= F.col("id"))) - F.lit(0 if got.nulls else 1))
    rows = rows.withColumn("bucket", bucket)
    # bounds are ids that occur, so a bucket's first rows are known by their id
    first = F.col("id").eqNullSafe(F.element_at(F.array(*[F.lit(x).cast("long") for x in lows]), F.col("bucket") + 1))
    before = F.pmod(F.col("bucket") - 1, F.lit(max(1, len(lows))))
    to = F.when(first, F.array(F.struct(F.col("bucket").alias("bucket"), F.lit(False).alias("extra")),
                               F.struct(before.alias("bucket"), F.lit(True).alias("extra")))
                ).otherwise(F.array(F.struct(F.col("bucket").alias("bucket"), F.lit(False).alias("extra"))))
    rows = rows.select("id", "t", F.explode(to).alias("to")).select("to.bucket", "to.extra", "id", "t")
    return rows.repartitionById(len(lows) or 1, F.col("bucket")).sortWithinPartitions("bucket", "extra", "id", "t")


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K, l: int = L,  # noqa: E741
                 m: int = M, seed: int = SEED) -> DataFrame:
    """One row per document: id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint (hex signatures), near_edited, near_next (0 to 1).

    The next document is the next row in order of (id, text); after the last
    comes the first, and a lone document follows itself.  A null text is
    empty; an empty text's signature is all zeros.  Null ids come first.
    Repeated rows each get a row.  Other columns are not looked at.
    """
    ship_package(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib
        out: list[tuple] = []
        held = None  # the row whose successor is awaited

        def done(row, text, sig):
            mixed = edited(row[2], text)
            own = row[3]
            other = signature(_points(mixed), k, l, m, seed) if mixed != row[2] else own
            out.append((row[1], len(row[2]), hashlib.sha256(mixed.encode("utf-8", "surrogatepass")).hexdigest(),
                        own.tobytes().hex(), other.tobytes().hex(), likeness(own, other), likeness(own, sig)))

        for batch in batches:
            c = [batch.column(i).to_pylist() for i in range(4)]
            for bucket, extra, key, t in zip(*c):
                text = t.decode("utf-8", "replace") if t else ""
                if extra and (held is None or held[0] != bucket):
                    continue  # only the first extra row of a bucket is needed
                same = held is not None and text == held[2]
                sig = held[3] if same else signature(_points(text), k, l, m, seed)
                if held is not None and held[0] == bucket:
                    done(held, text, sig)
                held = None if extra else (bucket, key, text, sig)
                if len(out) >= 256:
                    yield _batch(out)
                    out = []
        yield _batch(out)

    schema = "id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return with_next(df, id_col, text_col).mapInArrow(run, schema)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    types = [("id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
             ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, (_, t) in enumerate(types)],
                                      names=[n for n, _ in types])
