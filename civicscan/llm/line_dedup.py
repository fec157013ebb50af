"""Line dedup by winnowing over line hashes.

A repeated passage is a run of lines with over ``OVER_WORDS`` words that
occurs twice.  A text is its sequence of lines that aren't blank, each hashed
with white space squeezed.  A shingle is the shortest run of lines from a line
on that has at least ``MIN_WORDS`` words.  Of the shingles that start within
``WINDOW_WORDS`` words of each other the one with the smallest hash is selected
(the last of equals).  Which one that is depends on the window's lines alone.
The shingles that start in a passage's first WINDOW_WORDS words all end inside
it, as MIN_WORDS + WINDOW_WORDS is no more than OVER_WORDS + 1, so both copies
of every passage select the same one.

A selected shingle may be shorter than a passage, and then its first occurrence
says nothing about longer runs.  So the fingerprints are the runs of over
OVER_WORDS words that hold it and are the shortest ones from their first line
on or up to their last line.  Every line of a passage lies in one of these that
lies in the passage: those from a line on cover it up to the last that fits,
and the one that ends with the passage begins no later than that.  Occurrences
of a fingerprint are joined with its first one, in order of document id and
line; the match is extended both ways over equal lines; the later run is
deleted.  Each deleted line stands, in the same order, in an earlier place, in
a run of over OVER_WORDS words.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicscan.llm.common import fresh, map_arrow, materialize, ship_package

#: Repeated passages of more words are deleted.
OVER_WORDS = 50
#: Words of a shingle and of a window: together no more than OVER_WORDS + 1.
MIN_WORDS = 39
WINDOW_WORDS = 12


def line_hashes(text: str) -> tuple[list[int], np.ndarray, np.ndarray]:
    """Line numbers, hashes and word counts of the lines that aren't blank."""
    at, hashes, words = [], [], []
    for i, line in enumerate(text.split("\n")):
        w = line.split()
        if w:
            at.append(i)
            words.append(len(w))
            hashes.append(xxhash.xxh64_intdigest(" ".join(w)))
    return at, np.array(hashes, np.uint64), np.array(words, np.int64)


def shingles(hashes: np.ndarray, words: np.ndarray, least: int = MIN_WORDS, window: int = WINDOW_WORDS) -> list[tuple[int, int]]:
    """First and last line of the selected shingles."""
    end = np.cumsum(words)
    begin = end - words
    last = np.searchsorted(end, begin + least)  # the line that completes the shingle
    n = int(np.searchsorted(last, len(words)))  # shingles that the text completes
    raw = hashes.tobytes()
    value = [xxhash.xxh64_intdigest(raw[8 * i:8 * int(last[i]) + 8]) for i in range(n)]
    reach = np.minimum(np.searchsorted(begin, begin[:n] + window), n).tolist()
    picked: dict[int, None] = {}
    for i in range(n):
        picked[min(range(i, reach[i]), key=lambda j: (value[j], -j))] = None
    return [(i, int(last[i])) for i in picked]


def winnow(hashes: np.ndarray, words: np.ndarray, least: int = MIN_WORDS, window: int = WINDOW_WORDS,
           over: int = OVER_WORDS) -> list[tuple[int, int]]:
    """``(fingerprint, first line)`` of the runs of over ``over`` words that
    hold a selected shingle and are shortest from their first line, or up to
    their last one."""
    end = np.cumsum(words).tolist()
    begin = [0, *end]  # words before each line
    found: dict[tuple[int, int], None] = {}
    for i, last in shingles(hashes, words, least, window):
        for a in range(i, -1, -1):
            b = bisect_right(end, begin[a] + over)
            if b < last:
                break
            if b < len(end):
                found[a, b] = None
        for b in range(last, len(end)):
            a = bisect_left(begin, end[b] - over) - 1
            if a > i:
                break
            if a >= 0:
                found[a, b] = None
    raw = hashes.tobytes()
    return [(xxhash.xxh64_intdigest(raw[8 * a:8 * b + 8]), a) for a, b in found]


def extend(later: np.ndarray, earlier: np.ndarray, matches: list[tuple[int, int]], same: bool) -> list[tuple[int, int]]:
    """Runs ``[from, to)`` of ``later`` that extend the matched lines (later, earlier)."""
    runs: list[tuple[int, int]] = []
    done: dict[int, int] = {}  # by distance, where the last run ends
    for c, a in sorted(matches):
        if done.get(c - a, -1) > c:
            continue
        n = min(len(later) - c, len(earlier) - a)
        differs = np.flatnonzero(later[c:c + n] != earlier[a:a + n])
        to = c + (int(differs[0]) if len(differs) else n)
        m = min(c, a)
        differs = np.flatnonzero(later[c - m:c] != earlier[a - m:a])
        start = c - m + int(differs[-1]) + 1 if len(differs) else c - m
        done[c - a] = to
        if to > start:
            runs.append((start, to))
    return runs


def _signed(h: int) -> int:
    return h - (1 << 64) if h >= 1 << 63 else h


def _lines(df: DataFrame, id_col: str, text_col: str, least: int, window: int, over: int) -> DataFrame:
    def run(c):
        out: dict[str, list] = {"id": c["id"], "th": c["th"], "at": [], "hashes": [], "prints": [], "pos": []}
        for t in c["t"]:
            at, hashes, words = line_hashes(t.decode("utf-8", "replace") if t else "")
            picked = winnow(hashes, words, least, window, over)
            out["at"].append(np.array(at, "<i4").tobytes())
            out["hashes"].append(hashes.tobytes())
            out["prints"].append([_signed(h) for h, _ in picked])
            out["pos"].append([i for _, i in picked])
        return {"id": pa.array(out["id"], pa.int64()), "th": pa.array(out["th"], pa.int64()), "at": pa.array(out["at"], pa.binary()),
                "hashes": pa.array(out["hashes"], pa.binary()), "prints": pa.array(out["prints"], pa.list_(pa.int64())),
                "pos": pa.array(out["pos"], pa.list_(pa.int32()))}

    rows = df.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text_col).alias("th"),
                     F.col(text_col).cast("binary").alias("t")).filter("t is not null")
    out = map_arrow(rows, run, "id long, th long, at binary, hashes binary, prints array<long>, pos array<int>")
    return materialize(out, "line-hashes")


def removals(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = MIN_WORDS,
             window: int = WINDOW_WORDS, over: int = OVER_WORDS) -> DataFrame:
    """``(id, th, lines)`` of each text that loses lines: their numbers from 0, ascending; ``th`` is the text's hash."""
    # rows equal in id and text are one document
    lines = _lines(df, id_col, text_col, least, window, over)
    name = F.struct(F.coalesce("id", F.lit(0)).alias("id"), F.col("id").isNull().alias("none"), "th")
    lines = lines.withColumn("doc", name)
    seen = (lines.select("doc", F.explode(F.arrays_zip("prints", "pos")).alias("p"))
            .select(F.col("p.prints").alias("print"), "doc", F.col("p.pos").alias("pos")))
    place = F.struct("doc.none", "doc.id", "doc.th", "pos")
    first = (seen.groupBy("print").agg(F.min(place).alias("f"), F.max(place).alias("l")).filter("f <> l")
             .select("print", F.struct(F.col("f.id").alias("id"), F.col("f.none").alias("none"), F.col("f.th").alias("th")).alias("source"),
                     F.col("f.pos").alias("source_pos")))
    first = materialize(first, "line-first")
    later = seen.join(first, "print").filter("doc <> source or pos <> source_pos")
    # a pair of documents is matched once, at all its common fingerprints
    pairs = later.groupBy("doc", "source").agg(F.collect_set(F.struct("pos", "source_pos")).alias("places"))
    texts = lines.filter(F.size("prints") > 0).select("doc", "at", "hashes").dropDuplicates(["doc"])
    texts = materialize(texts, "line-texts")
    both = (pairs.join(texts.select(F.col("doc").alias("source"), F.col("hashes").alias("earlier")), "source")
            .join(texts.select("doc", "at", F.col("hashes").alias("later")), "doc"))

    def run(c):
        out = []
        for doc, source, at, later_, earlier, places in zip(c["doc"], c["source"], c["at"], c["later"], c["earlier"], c["places"]):
            x, y, n = np.frombuffer(later_, np.uint64), np.frombuffer(earlier, np.uint64), np.frombuffer(at, "<i4")
            runs = extend(x, y, [(p["pos"], p["source_pos"]) for p in places], doc == source)
            out.append(sorted({int(i) for a, b in runs for i in n[a:b]}))
        doc = c["doc"]
        return {"id": pa.array([None if d["none"] else d["id"] for d in doc], pa.int64()), "th": pa.array([d["th"] for d in doc], pa.int64()),
                "lines": pa.array(out, pa.list_(pa.int32()))}

    found = map_arrow(both.select("doc", "source", "at", "later", "earlier", "places"), run, "id long, th long, lines array<int>", rows=64)
    found = found.groupBy("id", "th").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("lines")))).alias("lines"))
    return materialize(found, "line-removals")


def dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = MIN_WORDS,
          window: int = WINDOW_WORDS, removed: str | None = None, over: int = OVER_WORDS) -> DataFrame:
    """``df`` with the later repeated runs deleted from the text column.

    All columns and rows are kept (a text whose lines all go is empty); with
    ``removed``, a column of that name lists the deleted line numbers.  Null
    texts stay null.  Blank lines are never deleted.  Order is by id, nulls
    last, then by the text's hash; rows equal in both are one document and get
    the same result.  An empty table stays empty.
    """
    gone = removals(df, id_col, text_col, least, window, over)
    key, th, lines = fresh(df, "__line_id"), fresh(df, "__line_text"), fresh(df, "__line_gone")
    gone = gone.select(F.col("id").alias(key), F.col("th").alias(th), F.col("lines").alias(lines))
    # what is deleted grows with the input, so the plan is the same at every size: no broadcast
    gone = gone.hint("merge")
    same = df[id_col].cast("long").eqNullSafe(gone[key]) & (F.xxhash64(df[text_col]) == gone[th])
    joined = df.join(gone, same, "left").select(*[df[c] for c in df.columns], lines)
    names, at = df.columns, df.columns.index(text_col)
    ship_package(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in range(0, batch.num_rows, 256):
                part = batch.slice(b, 256)
                columns = [part.column(i) for i in range(len(names))]
                drop = part.column(len(names))
                if drop.null_count < part.num_rows:
                    texts = columns[at].to_pylist()
                    for i, d in enumerate(drop.to_pylist()):
                        if d:
                            d = set(d)
                            texts[i] = "\n".join(x for k, x in enumerate(texts[i].split("\n")) if k not in d)
                    columns[at] = pa.array(texts, columns[at].type)
                if removed:
                    columns.append(drop)
                yield pa.RecordBatch.from_arrays(columns, names=names + [removed] * bool(removed))

    from pyspark.sql import types as T
    schema = T.StructType(list(df.schema.fields) + ([T.StructField(removed, T.ArrayType(T.IntegerType()))] if removed else []))
    return joined.mapInArrow(run, schema)


def digest(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, the lines it has, those deleted, and the digest of what stays."""
    out = dedup(df.select(id_col, text_col), id_col, text_col, removed="removed_lines")
    gone = F.coalesce("removed_lines", F.array().cast("array<int>"))
    left = F.coalesce(F.col(text_col), F.lit(""))
    return out.select(F.col(id_col).alias("doc_id"), gone.alias("removed_lines"), F.size(gone).cast("long").alias("n_removed"),
                      F.length(left).cast("long").alias("n_chars"), F.sha2(left, 256).alias("text_sha256"))


def drop_emptied(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``dedup`` without the documents of which no word stays; texts that had none before are kept."""
    gone = fresh(df, "__gone")
    out = dedup(df, id_col, text_col, removed=gone)
    emptied = F.col(gone).isNotNull() & ~F.coalesce(F.col(text_col), F.lit("")).rlike(r"\S")
    return out.filter(~emptied).select(*df.columns)
