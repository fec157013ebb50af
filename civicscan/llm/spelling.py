"""Spelling variants by permuterm rotations.

A word gets a terminator, and its rotations are sorted.  For a word ``a x b``
the rotation that ends in the character ``x`` reads ``b $ a x``; whatever
replaces ``x`` shares its prefix ``b $ a``, and that prefix is a whole rotation
of the word ``a b``, which lacks the character.  So the words within one
replacement, insertion or deletion at a place stand together under one prefix.
Every word enters under its whole rotations and under its rotations without
their last character; the rows are sorted by that key, groups of equal keys are
scanned, and each member gets the number of its neighbours in the group and the
best of them.

A group holds the one word that equals the key and at most one word for each
character of the alphabet, so groups are small whatever the words.  A pair that
differs by a replacement meets in one group only.  One that differs by a
deletion meets at every character of a run of equal ones; it counts at the
run's first.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from civicscan.llm.common import materialize, ship_package

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LETTER = "[a-zÀ-ÿ]"
TERMINATOR = "$"
LEAST_LENGTH = 7
LEAST_COUNT = 2
#: A form occurs so many times as often as the word.
RATIO = 10
#: One run in so many, chosen by its hash, loses a character.
EVERY = 31
#: Keys of more code points are written as their first ``HEAD`` ones and four
#: hashes of the whole, so a word's rows stay linear in its length.
PLAIN = 64
HEAD = 32

#: Whole rotations (they stand for the shorter word of a deletion), rotations
#: without their last character, and those of them whose character is the first
#: of a run of equal ones.
WHOLE, SKIP, SKIP_FIRST = 0, 1, 2

# the four largest primes under 2^32 and a base for each
_PRIMES = [4294967291, 4294967279, 4294967231, 4294967197]
_BASES = [2654435761, 1640531527, 2246822519, 3266489917]


def word_counts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_length: int = LEAST_LENGTH,
                least_count: int = LEAST_COUNT, every: int = EVERY) -> DataFrame:
    """``word, n``: the words of all texts and their occurrences.

    Runs of letters are lower-cased (A-Z only); a run loses a character where
    ``every`` divides the hash of ``<id>:<run>`` (a null id is empty).  Runs
    too short to give a word are passed over in the pattern.
    """
    low = F.translate(F.col(text_col), UPPER, LOWER)
    runs = df.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("d"),
                     F.explode(F.regexp_extract_all(low, F.lit(f"{LETTER}{{{least_length},}}"), F.lit(0))).alias("w"))
    hashed = runs.select("w", F.crc32(F.concat("d", F.lit(":"), "w").cast("binary")).alias("h"), F.length("w").alias("size"))
    cut = F.expr("concat(substring(w, 1, cast(h % size as int)), substring(w, cast(h % size as int) + 2))")
    words = hashed.select(F.when(F.col("h") % every == 0, cut).otherwise(F.col("w")).alias("word"))
    return (words.filter(F.length("word") >= least_length).groupBy("word").agg(F.count("*").alias("n"))
            .filter(F.col("n") >= least_count))


def _powers(base: int, prime: int, n: int) -> np.ndarray:
    out = np.ones(n, np.uint64)
    done = 1
    while done < n:
        more = min(done, n - done)
        out[done:done + more] = out[:more] * np.uint64(pow(base, done, prime)) % np.uint64(prime)
        done += more
    return out


def rotation_hashes(word: str, skip: int) -> np.ndarray:
    """Four hashes of each rotation of the marked word without the ``skip`` (0
    or 1) characters after its place: row i reads ``word[i+skip:] $ word[:i]``."""
    x = np.frombuffer(word.encode("utf-32-le"), "<u4").astype(np.uint64)
    n = len(x)
    i = np.arange(n + 1 - skip)
    out = np.empty((len(i), len(_PRIMES)), np.uint64)
    for j, (p, b) in enumerate(zip(_PRIMES, _BASES)):
        prime, up, down = np.uint64(p), _powers(b, p, n + 2), _powers(pow(b, -1, p), p, n + 2)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(x * up[:n] % prime)]) % prime
        tail = (sums[n] + prime - sums[i + skip]) % prime * down[i + skip] % prime
        after = n - i - skip
        out[:, j] = (tail + np.uint64(ord(TERMINATOR)) * up[after] + sums[i] * up[after + 1] % prime) % prime
    return out


def long_rotations(word: str, rows: int = 16384) -> Iterator[tuple[list[str], np.ndarray]]:
    """Keys of over ``PLAIN`` code points and their kinds, ``rows`` at a time."""
    n = len(word)
    ring = word + TERMINATOR + word
    for skip in (0, 1):
        size = n + 1 - skip
        if size <= PLAIN:
            continue
        kinds = np.full(size, WHOLE, np.int8)
        if skip:
            x = np.frombuffer(word.encode("utf-32-le"), "<u4")
            kinds[:] = np.where(np.concatenate([[True], x[1:] != x[:-1]]), SKIP_FIRST, SKIP)
        hashes = rotation_hashes(word, skip)
        for at in range(0, size, rows):
            some = hashes[at:at + rows].tolist()
            keys = [f"{ring[i + skip:i + skip + HEAD]}#{size}#{a:08x}{b:08x}{c:08x}{d:08x}" for i, (a, b, c, d) in enumerate(some, at)]
            yield keys, kinds[at:at + rows]


def rotations(words: DataFrame) -> DataFrame:
    """``key, kind, node, n`` of all rotations of ``node, word, n``."""
    whole = (f"IF(length(word) < {PLAIN}, transform(sequence(0, length(word)), i -> struct("
             f"concat(substring(word, i + 1), '{TERMINATOR}', substring(word, 1, i)) AS key, {WHOLE} AS kind)), array())")
    skip = (f"IF(length(word) BETWEEN 1 AND {PLAIN}, transform(sequence(0, length(word) - 1), i -> struct("
            f"concat(substring(word, i + 2), '{TERMINATOR}', substring(word, 1, i)) AS key, "
            f"IF(i > 0 AND substring(word, i, 1) = substring(word, i + 1, 1), {SKIP}, {SKIP_FIRST}) AS kind)), array())")
    short = (words.filter(F.length("word") <= PLAIN)
             .select("node", "n", F.inline_outer(F.expr(f"concat({whole}, {skip})"))).filter("key is not null"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for node, n, word in zip(*(batch.column(i).to_pylist() for i in range(3))):
                for keys, kinds in long_rotations(word):
                    yield pa.RecordBatch.from_pydict({
                        "node": pa.array([node] * len(keys), pa.int64()), "n": pa.array([n] * len(keys), pa.int64()),
                        "key": pa.array(keys, pa.string()), "kind": pa.array(kinds, pa.int32())})

    ship_package(words.sparkSession)
    long = (words.filter(F.length("word") >= PLAIN).select("node", "n", "word")
            .mapInArrow(run, "node long, n long, key string, kind int"))
    return short.unionByName(long)


def neighbours(words: DataFrame) -> DataFrame:
    """``node, n_near, best_n, best``: the number of words near each word that
    has any, and the most frequent of them (of equals the smallest node)."""
    group = Window.partitionBy("key")
    rows = rotations(words).withColumn("members", F.collect_list(F.struct((-F.col("n")).alias("m"), "node", "kind")).over(group))
    # a replacement joins two skips, a deletion the whole rotation and a run's first skip
    near = F.filter("members", lambda o: (o["node"] != F.col("node")) & F.when(F.col("kind") == WHOLE, o["kind"] == SKIP_FIRST)
                    .when(F.col("kind") == SKIP, o["kind"] != WHOLE).otherwise(F.lit(True)))
    found = rows.filter(F.size("members") > 1).select("node", near.alias("near")).filter(F.size("near") > 0)
    best = F.array_min(F.transform("near", lambda o: F.struct(o["m"].alias("m"), o["node"].alias("node"))))
    return (found.select("node", F.size("near").alias("k"), best.alias("b"))
            .groupBy("node").agg(F.sum("k").alias("n_near"), F.min("b").alias("b"))
            .select("node", "n_near", (-F.col("b.m")).alias("best_n"), F.col("b.node").alias("best")))


def roots(forms: DataFrame, steps: int) -> DataFrame:
    """``node, root`` of ``node, form``: the end of each chain of at most ``steps`` forms, by pointer doubling."""
    up = forms.select("node", F.col("form").alias("root"))
    for _ in range(max(0, math.ceil(math.log2(max(1, steps))))):
        on = up.select(F.col("node").alias("root"), F.col("root").alias("next"))
        up = materialize(up.join(on, "root", "left").select("node", F.coalesce("next", "root").alias("root")), "spelling-roots")
    return up


def variants(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_length: int = LEAST_LENGTH,
             least_count: int = LEAST_COUNT, ratio: int = RATIO, every: int = EVERY) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every word.

    Null and empty texts and texts without long enough runs add no words; a
    null id hashes as an empty one; repeated rows count as often as they stand.
    Of near words equally frequent the smallest in code-point order is the
    form.  Other columns are not looked at.  An empty table gives no words.
    """
    counted = word_counts(df, id_col, text_col, least_length, least_count, every)
    # nodes are numbered in code-point order, so ties are decided by number
    words = materialize(counted.orderBy("word").withColumn("node", F.monotonically_increasing_id()), "spelling-words")
    near = materialize(neighbours(words), "spelling-near")
    most = words.agg(F.max("n")).first()[0] or 1
    linked = near.join(words.select("node", "n"), "node")
    forms = materialize(linked.filter(F.col("best_n") >= ratio * F.col("n")).select("node", F.col("best").alias("form"), F.col("best_n").alias("form_n")),
                        "spelling-forms")
    # frequencies grow by the ratio along a chain, which bounds its length
    top = roots(forms, steps=1 + int(math.log(most, max(2, ratio))))
    name = words.select(F.col("node").alias("of"), "word")
    named = (forms.join(top, "node")
             .join(name.select(F.col("of").alias("form"), F.col("word").alias("form_word")), "form")
             .join(name.select(F.col("of").alias("root"), F.col("word").alias("root_word")), "root")
             .select("node", "form_word", "root_word", "form_n"))
    out = words.join(near.select("node", "n_near"), "node", "left").join(named, "node", "left")
    return out.select("word", F.col("form_word").alias("form"), F.coalesce("root_word", "word").alias("root"), "n",
                      F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n")
