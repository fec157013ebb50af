"""SimHash near-dedup by covering locality-sensitive hashing.

Fingerprint: 64 bits, bit b is 1 when it is set in over half of the XXH64
values of the text's word shingles.  Candidate pairs come from 2^(r+1) - 1
tables (r = maximum bit distance).  Each bit position gets a non-zero vector
of r + 1 bits; the table of a non-zero vector q keeps the positions whose
vector has an odd inner product with q.  Any r positions span at most r
dimensions, so some q is orthogonal to all of them: in that table none of the
differing bits is kept, and the pair collides.  No pair within the radius is
missed.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from civicscan.llm.common import Forest, as_long, components, fresh, map_arrow, materialize, signed

SHINGLE_WORDS = 3
MAX_DISTANCE = 2
SEED = 42
#: A bucket up to this many distinct fingerprints is compared inside one task
#: (32 KB of fingerprints); larger ones are split by one-bit variants.
BUCKET_LIMIT = 4096
_BLOCK = 1 << 15


def _majority(hashes: np.ndarray) -> int:
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), _BLOCK):
        part = hashes[at:at + _BLOCK]
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.uint32)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprint(text: bytes | None, k: int = SHINGLE_WORDS) -> int:
    """64-bit SimHash of UTF-8 ``text``: ASCII letters lower-cased, words split
    at ASCII white space, ``k``-word shingles with repeats.  A text with fewer
    words is one shingle; a null text or one without words gives zero."""
    words = text.lower().split() if text else []
    if not words:
        return 0
    joined = b" ".join(words)
    digest = xxhash.xxh64_intdigest
    if len(words) < k:
        return digest(joined, SEED)
    size = np.fromiter(map(len, words), np.int64, len(words))
    end = np.cumsum(size + 1) - 1
    first, last = (end - size)[:len(words) - k + 1].tolist(), end[k - 1:].tolist()
    return _majority(np.fromiter([digest(joined[a:b], SEED) for a, b in zip(first, last)], np.uint64, len(first)))


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 k: int = SHINGLE_WORDS) -> DataFrame:
    """``(id, text_hash, fp long)`` of every row (``fp`` holds the unsigned bits)."""

    def run(c):
        return {"id": pa.array(c["id"], pa.int64()), "text_hash": pa.array(c["text_hash"], pa.int64()),
                "fp": as_long(np.array([fingerprint(t, k) for t in c["t"]], np.uint64))}

    rows = df.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text_col).alias("text_hash"),
                     F.col(text_col).cast("binary").alias("t"))
    return map_arrow(rows, run, "id long, text_hash long, fp long")


def covering_masks(radius: int) -> list[int]:
    """The bits each table keeps.  Position vectors go round the non-zero vectors, so tables keep equal shares."""
    n = (1 << (radius + 1)) - 1
    vector = [1 + b % n for b in range(64)]
    return [sum(1 << b for b in range(64) if (vector[b] & q).bit_count() % 2) for q in range(1, n + 1)]


def _bucket_edges(buckets: DataFrame, radius: int) -> DataFrame:
    """Links inside buckets that fit a task: a spanning forest of each bucket, never all its pairs."""

    def run(c):
        us, vs = [], []
        for members in c["members"]:
            x = np.sort(np.array(members, np.int64).view(np.uint64))
            f = Forest()
            for i in range(len(x) - 1):
                near = np.flatnonzero(np.bitwise_count(x[i + 1:] ^ x[i]) <= radius)
                for j in near.tolist():
                    f.link(i, i + 1 + j)
            a, b = f.stars()
            us.append(x[a]), vs.append(x[b])
        cat = lambda z: as_long(np.concatenate(z).astype(np.uint64)) if z else pa.array([], pa.int64())
        return {"u": cat(us), "v": cat(vs)}

    return map_arrow(buckets, run, "u long, v long")


def _variant_edges(members: DataFrame, masks: list[int], radius: int) -> DataFrame:
    """Links inside buckets of any size, exactly and with rows linear in the members.

    Two fingerprints of a bucket within ``radius`` bits share a variant: each
    with up to half of the radius flipped among the bits its table drops.  A
    variant's members are linked to its smallest one where the distance
    allows.  For an even radius all members of a variant are within the radius
    of each other, so the star keeps every connection; an odd radius flips one
    more bit on the side with the smaller value."""
    rows = []
    for t, mask in enumerate(masks):
        free = [b for b in range(64) if not mask >> b & 1]
        flips = [0] + [sum(1 << b for b in c) for n in range(1, radius // 2 + 1) for c in combinations(free, n)]
        rows.append(F.array(*[F.lit(signed(x)) for x in flips]))
    picked = F.element_at(F.array(*rows), F.col("t") + 1)
    v = members.select("t", "key", "fp", F.explode(picked).alias("flip")).select(
        "t", "key", "fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("variant"))
    # a variant has at most 1 + (dropped bits) members
    low = v.groupBy("t", "key", "variant").agg(F.min("fp").alias("v"), F.collect_set("fp").alias("us"))
    return low.filter(F.size("us") > 1).select(F.explode("us").alias("u"), "v").filter("u <> v")


def links(fps: DataFrame, radius: int = MAX_DISTANCE, bucket_limit: int = BUCKET_LIMIT) -> DataFrame:
    """Edges ``(u, v)`` that connect exactly the distinct fingerprints of ``fps(fp)`` within ``radius`` bits."""
    if radius % 2 and bucket_limit < 1 << 62:
        bucket_limit = 1 << 62  # variants are exact for even radii only
    masks = covering_masks(radius)
    cells = F.array(*[F.struct(F.lit(t).alias("t"), F.col("fp").bitwiseAND(F.lit(signed(m))).alias("key"))
                      for t, m in enumerate(masks)])
    cells = fps.select("fp", F.explode(cells).alias("c")).select("c.*", "fp")
    # two distinct members are the smallest and the largest: most buckets need no join
    size = cells.groupBy("t", "key").agg(F.count("*").alias("n"), F.min("fp").alias("lo"), F.max("fp").alias("hi")).filter("n > 1")
    size = materialize(size, "simhash-buckets")
    pairs = (size.filter("n = 2").filter(F.bit_count(F.col("lo").bitwiseXOR(F.col("hi"))) <= radius)
             .select(F.col("hi").alias("u"), F.col("lo").alias("v")))
    more = cells.join(size.filter("n > 2").select("t", "key", "n"), ["t", "key"])
    inside = _bucket_edges(more.filter(F.col("n") <= bucket_limit).groupBy("t", "key")
                           .agg(F.collect_list("fp").alias("members")).select("members"), radius)
    out = pairs.unionByName(inside)
    if radius % 2 == 0:
        out = out.unionByName(_variant_edges(more.filter(F.col("n") > bucket_limit), masks, radius))
    return out


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = SHINGLE_WORDS,
                    radius: int = MAX_DISTANCE, bucket_limit: int = BUCKET_LIMIT) -> DataFrame:
    """``(id, fp, component_id)`` for every row: ``component_id`` is the
    smallest id reachable through fingerprints that differ in at most
    ``radius`` bits.

    Null or wordless texts have fingerprint zero and link like any other.
    Equal texts always share a component.  Repeated rows are all returned.  A
    null id never becomes a component id unless a component has no other.  An
    empty table gives an empty result.  Other columns are not looked at.
    """
    fp, groups = _grouped(df, id_col, text_col, k, radius, bucket_limit)
    return fp.join(groups, "fp", "left").select("id", "fp", "component_id")


def _grouped(df: DataFrame, id_col: str, text_col: str, k: int, radius: int, bucket_limit: int):
    """Fingerprints of the rows, and of each distinct one its component's smallest id and first row."""
    fp = materialize(fingerprints(df, id_col, text_col, k), "simhash-fp")
    row = F.struct(F.col("id").isNull().alias("none"), "id", "text_hash")
    classes = materialize(fp.groupBy("fp").agg(F.min("id").alias("low"), F.min(row).alias("first")), "simhash-classes")
    comp = components(links(classes.select("fp"), radius, bucket_limit), "simhash-cc")
    joined = classes.join(comp.withColumnRenamed("node", "fp"), "fp")
    best = joined.groupBy("component").agg(F.min("low").alias("low"), F.min("first").alias("first"))
    linked = joined.select("fp", "component").join(best, "component").select("fp", "low", "first")
    alone = classes.join(linked.select("fp"), "fp", "left_anti").select("fp", "low", "first")
    return fp, linked.unionByName(alone).withColumnRenamed("low", "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = SHINGLE_WORDS,
             radius: int = MAX_DISTANCE) -> DataFrame:
    """The rows of ``docs`` with one document of each near-duplicate group: the
    one with the smallest id, ties by the hash of the text.  Rows that repeat
    both id and text are copies.  All columns are kept as they are."""
    _, groups = _grouped(docs, id_col, text_col, k, radius, BUCKET_LIMIT)
    key, text_hash, rank = fresh(docs, "__id"), fresh(docs, "__text_hash"), fresh(docs, "__rank")
    kept = groups.select(F.col("first.id").alias(key), F.col("first.text_hash").alias(text_hash)).distinct().hint("merge")
    same = docs[id_col].cast("long").eqNullSafe(kept[key]) & (F.xxhash64(docs[text_col]) == kept[text_hash])
    rows = docs.join(kept, same, "left_semi")
    w = Window.partitionBy(F.col(id_col), F.xxhash64(text_col)).orderBy(text_col)
    return rows.withColumn(rank, F.row_number().over(w)).filter(F.col(rank) == 1).select(*docs.columns)
