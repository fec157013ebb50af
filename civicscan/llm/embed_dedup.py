"""Embedding near-duplicates by sorted projection passes.

Each pass gives every vector a key of concatenated random hashes (bits telling
on which side of random hyperplanes it lies), puts the vectors of a label in
lexicographic order of the keys, and compares each with a bounded window of
neighbours in that order.  Pairs whose cosine, in double precision, reaches
the threshold are links; the links of all passes are united into components.

How many bits of a key single out a window depends on how the vectors of a
label lie.  A first round makes the passes that evenly spread vectors need.
What it joined counts as one vector; where more of a label's vectors than a
window takes still agree in that many bits, the bits are measured and the label
gets the further passes that they call for.

A window bounds how many partners a pass can show a vector, so in dense groups
it finds enough links to connect them but not all.  All links of a vector lie
in its component; there they are counted exactly, block against block, without
writing pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicscan.llm.common import Forest, components, map_arrow, materialize, ship_package

THRESHOLD = 0.98
WINDOW = 128
KEY_BITS = 62
SEED = 11
#: Probability of missing a pair at the threshold in every pass.
MISS = 1e-4
#: Lengths of key prefixes that are measured, and the share of a label's vectors that may be in a crowd beyond a window.
PREFIXES = range(0, 61, 4)
CROWDED = 0.01
#: Vectors of a component compared in one block.
PART = 2048


def passes_by_bits(bits: float, threshold: float = THRESHOLD, miss: float = MISS) -> int:
    """Passes that leave a pair at the threshold unseen with probability
    ``miss``, if a pass shows it when their keys agree in ``bits`` bits."""
    agree = 1 - math.acos(min(1.0, max(-1.0, threshold))) / math.pi
    seen = min(agree ** bits, 1 - 1e-9)
    return max(2, math.ceil(math.log(miss) / math.log1p(-seen)))


def passes_for(rows: int, threshold: float = THRESHOLD, window: int = WINDOW, miss: float = MISS) -> int:
    """Passes for ``rows`` vectors of a label that point evenly in all
    directions, so that each bit halves them."""
    return passes_by_bits(max(1.0, math.log2(max(1, rows) / window) + 1), threshold, miss)


def crowding(reps: DataFrame, first: int, threshold: float, window: int, miss: float, seed: int, kind: str) -> DataFrame:
    """``label, dim, passes`` of the labels that need more than ``first``
    passes: those of the shortest key prefix that leaves all but ``CROWDED`` of
    the label's vectors in groups that half a window holds."""
    keyed = _keyed(reps, 0, 1, seed, kind).select("label", "dim", "key")
    prefix = F.transform(F.array(*[F.lit(b) for b in PREFIXES]), lambda b: F.struct(
        b.alias("bits"), F.call_function("shiftright", F.col("key"), F.lit(KEY_BITS) - b).alias("p")))
    groups = keyed.select("label", "dim", F.inline(prefix)).groupBy("label", "dim", "bits", "p").agg(F.count("*").alias("c"))
    crowded = F.sum(F.when(F.col("c") > window // 2, F.col("c")).otherwise(0)) / F.sum("c")
    shares = groups.groupBy("label", "dim", "bits").agg(crowded.alias("share"))
    bits = shares.groupBy("label", "dim").agg(F.coalesce(F.min(F.when(F.col("share") <= CROWDED, F.col("bits"))), F.lit(KEY_BITS)).alias("bits"))
    needed = F.array(*[F.lit(passes_by_bits(b, threshold, miss)) for b in range(KEY_BITS + 1)])
    return bits.select("label", "dim", F.get(needed, F.col("bits")).alias("passes")).filter(F.col("passes") > first)


def _planes(dim: int, p: int, seed: int) -> np.ndarray:
    return np.random.default_rng([seed, p, dim]).standard_normal((dim, KEY_BITS))


def _matrix(raw: list[bytes], dim: int, kind: str) -> np.ndarray:
    """Vectors as rows of length one, in double precision."""
    x = np.frombuffer(b"".join(raw), kind).reshape(len(raw), dim).astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def _rows(df: DataFrame, id_col: str, vec_col: str, label_col: str, kind: str) -> DataFrame:
    """``id, label, dim, vec`` of every row; ``vec`` (raw components) is null where nothing may link."""

    def run(c):
        vecs = []
        for v, y in zip(c["v"], c["label"]):
            x = np.array(v, kind) if v and y is not None and None not in v else np.zeros(0, kind)
            vecs.append(x.tobytes() if len(x) and np.isfinite(x).all() and x.any() else None)
        return {"id": pa.array(c["id"], pa.int64()), "label": pa.array(c["label"], pa.string()),
                "dim": pa.array([len(v or ()) for v in c["v"]], pa.int32()), "vec": pa.array(vecs, pa.binary())}

    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("string").alias("label"),
                     F.col(vec_col).alias("v"))
    return map_arrow(rows, run, "id long, label string, dim int, vec binary", rows=2048)


def _keyed(reps: DataFrame, first: int, end: int, seed: int, kind: str) -> DataFrame:
    """One row per vector and pass from ``first`` up to ``end``: ``pass, key`` and the vector."""

    def run(c):
        n = len(c["node"])
        keys = np.zeros((end - first, n), np.int64)
        dims = np.array(c["dim"])
        for d in np.unique(dims):
            at = np.flatnonzero(dims == d)
            x = _matrix([c["vec"][i] for i in at], int(d), kind)
            for p in range(first, end):
                bits = x @ _planes(int(d), p, seed) > 0
                keys[p - first, at] = bits @ (1 << np.arange(KEY_BITS, dtype=np.int64))
        return {"node": c["node"], "label": pa.array(c["label"], pa.string()), "dim": pa.array(c["dim"], pa.int32()),
                "vec": pa.array(c["vec"], pa.binary()), "keys": pa.array(list(keys.T), pa.list_(pa.int64()))}

    keyed = map_arrow(reps.select("node", "label", "dim", "vec"), run,
                      "node long, label string, dim int, vec binary, keys array<long>", rows=2048)
    return (keyed.select("node", "label", "dim", "vec", F.posexplode("keys").alias("at", "key"))
            .select("node", "label", "dim", "vec", (F.col("at") + first).alias("pass"), "key"))


def _window_links(keyed: DataFrame, rows: int, window: int, threshold: float, kind: str) -> DataFrame:
    """Links between neighbours in the order of (pass, label, dim, key).

    The order is range-partitioned, so partitions are even whatever the
    labels.  A partition compares its rows and passes on its first and last
    ``window`` rows; those of neighbouring partitions are compared next.
    """
    spark = keyed.sparkSession
    ship_package(spark)
    n = max(1, min(int(spark.conf.get("spark.sql.shuffle.partitions")), rows // (8 * window)))
    order = ["pass", "label", "dim", "key", "node"]
    ranged = keyed.repartitionByRange(n, *order).sortWithinPartitions(*order).select(
        F.spark_partition_id().alias("part"), *order, "vec")

    def links(t: pa.Table, split: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Pairs up to ``window`` apart; with ``split``, those across it only."""
        nodes, dims = t["node"].to_numpy(), t["dim"].to_numpy()
        group = t["pass"].to_numpy(), np.array(t["label"].to_pylist(), object), dims
        us, vs = [], []
        for d in np.unique(dims):
            at = np.flatnonzero(dims == d)
            x = _matrix(t["vec"].take(pa.array(at)).to_pylist(), int(d), kind)
            for s in range(1, min(window, len(at) - 1) + 1):
                hit = np.flatnonzero(np.einsum("ij,ij->i", x[s:], x[:-s]) >= threshold)
                a, b = at[hit + s], at[hit]
                same = np.ones(len(hit), bool)
                for g in group:
                    same &= g[a] == g[b]
                if split is not None:
                    same &= split[a] != split[b]
                us.append(nodes[a[same]]), vs.append(nodes[b[same]])
        none = np.zeros(0, np.int64)
        return np.concatenate([none, *us]), np.concatenate([none, *vs])

    names = ["part", *order, "vec"]

    def inside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, head, seen = None, None, 0
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                new = pa.Table.from_batches([batch.slice(at, 4096)])
                if head is None or seen < window:
                    more = new.slice(0, window - seen)
                    head = more if head is None else pa.concat_tables([head, more])
                seen += new.num_rows
                t = new if held is None else pa.concat_tables([held, new])
                f = Forest()  # a spanning star per local group: rows linear in the vectors
                for a, b in zip(*(x.tolist() for x in links(t))):
                    f.link(a, b)
                yield out(*f.stars())
                held = t.slice(max(0, t.num_rows - window))
        if held is not None:
            yield edge(head, 0)
            yield edge(held, 1)

    def out(u, v) -> pa.RecordBatch:
        n = len(u)
        empty = {c: pa.nulls(n, k) for c, k in kinds.items()}
        return pa.RecordBatch.from_pydict({"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64()), "side": pa.nulls(n, pa.int32()), **empty})

    def edge(t: pa.Table, side: int) -> pa.RecordBatch:
        n = t.num_rows
        cols = {c: t[c].combine_chunks().cast(k) for c, k in kinds.items()}
        return pa.RecordBatch.from_pydict({"u": pa.nulls(n, pa.int64()), "v": pa.nulls(n, pa.int64()), "side": pa.array([side] * n, pa.int32()), **cols})

    kinds = {"part": pa.int32(), "pass": pa.int32(), "label": pa.string(), "dim": pa.int32(), "key": pa.int64(),
             "node": pa.int64(), "vec": pa.binary()}
    found = materialize(ranged.mapInArrow(inside, "u long, v long, side int, part int, pass int, label string, dim int, key long, node long, vec binary"), "embed-windows")

    def across(t: pa.Table) -> pa.Table:
        t = t.sort_by([(c, "ascending") for c in order])
        f = Forest()  # a spanning star per group here too
        for a, b in zip(*(x.tolist() for x in links(t, t["part"].to_numpy()))):
            f.link(a, b)
        u, v = f.stars()
        return pa.table({"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64())})

    seam = (found.filter("side is not null").select((F.col("part") + F.col("side")).alias("seam"), *names)
            .groupBy("seam").applyInArrow(across, "u long, v long"))
    return found.filter("side is null").select("u", "v").unionByName(seam)


def _linked(reps: DataFrame, first: int, end: int, rows: int, window: int, threshold: float, seed: int, kind: str,
            known: DataFrame | None = None) -> DataFrame:
    """``node, component`` after the passes from ``first`` up to ``end`` (up to
    a row's own ``passes`` if it has that), joined to what is ``known``."""
    keyed = _keyed(reps, first, end, seed, kind)
    if "passes" in reps.columns:
        keyed = keyed.join(reps.select("node", "passes"), "node").filter(F.col("pass") < F.col("passes")).drop("passes")
    links = _window_links(keyed, rows, window, threshold, kind)
    if known is not None:
        links = links.unionByName(known.select(F.col("node").alias("u"), F.col("component").alias("v")))
    return materialize(components(links, "embed-cc"), "embed-linked")


def _counts(members: DataFrame, sizes: DataFrame, threshold: float, kind: str, part: int) -> DataFrame:
    """``node, linked``: copies of other vectors linked to each node, exactly.

    A component is cut into parts; each pair of its parts is a cell, compared
    in one task.  Components of one part share tasks.
    """
    ship_package(members.sparkSession)
    rows = members.join(sizes, "component").withColumn("parts", F.ceil(F.col("m") / part).cast("int"))
    rows = rows.withColumn("i", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
    cells = F.transform(F.sequence(F.lit(0), F.col("parts") - 1),
                        lambda j: F.struct(F.least(F.col("i"), j).alias("a"), F.greatest(F.col("i"), j).alias("b")))
    rows = rows.select("component", "node", "n", "dim", "vec", "parts", "i", F.explode(cells).alias("cell"))
    # components of one part are dealt into as many groups as there are shuffle partitions
    shared = F.pmod(F.xxhash64("component"), F.lit(4 * int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    rows = rows.withColumn("task", F.when(F.col("parts") > 1, F.xxhash64("component", "cell.a", "cell.b")).otherwise(shared))

    def run(t: pa.Table) -> pa.Table:
        t = t.sort_by([("component", "ascending"), ("a", "ascending"), ("b", "ascending")])
        cell = np.stack([t[c].to_numpy() for c in ("component", "a", "b")], 1)
        cut = np.flatnonzero(np.concatenate([[True], (cell[1:] != cell[:-1]).any(1)])).tolist() + [len(cell)]
        nodes, n, i = t["node"].to_numpy(), t["n"].to_numpy(), t["i"].to_numpy()
        dims, vecs = t["dim"].to_numpy(), t["vec"].to_pylist()
        linked = np.zeros(len(nodes), np.int64)
        for lo, hi in zip(cut, cut[1:]):
            x = _matrix(vecs[lo:hi], int(dims[lo]), kind)
            a, b = cell[lo][1], cell[lo][2]
            left = lo + np.flatnonzero(i[lo:hi] == a)
            right = lo + np.flatnonzero(i[lo:hi] == b)
            for at in range(0, len(left), 256):
                l = left[at:at + 256]  # noqa: E741
                near = x[l - lo] @ x[right - lo].T >= threshold
                near &= nodes[l][:, None] != nodes[right][None, :]
                linked[l] += near @ n[right]
                if a != b:
                    linked[right] += near.T @ n[l]
        return pa.table({"node": pa.array(nodes, pa.int64()), "linked": pa.array(linked, pa.int64())})

    cellwise = (rows.select("task", "component", F.col("cell.a").alias("a"), F.col("cell.b").alias("b"), "node", "n", "dim", "vec", "i")
                .groupBy("task").applyInArrow(run, "node long, linked long"))
    return cellwise.groupBy("node").agg(F.sum("linked").alias("linked"))


def near_duplicates(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
                    threshold: float = THRESHOLD, window: int = WINDOW, passes: int | None = None, seed: int = SEED,
                    part: int = PART) -> DataFrame:
    """``(id, n_links, component_id, kept)`` of every row.

    Vectors of equal, non-null label link when their cosine reaches the
    threshold; exact copies always do, and are counted without being compared.
    Null, empty and zero vectors, and those with null or non-finite components,
    link with nothing and are their own component, as are vectors with a null
    label.  Vectors of different lengths don't link.  Repeated rows count as
    copies.  Rows with a null id have a null component if it holds no other.
    An empty table gives an empty result.
    """
    kind = "<f4" if df.schema[vec_col].dataType.elementType.typeName() == "float" else "<f8"
    rows = materialize(_rows(df, id_col, vec_col, label_col, kind), "embed-rows").withColumns(
        {"h1": F.xxhash64("vec"), "h2": F.xxhash64("vec", F.lit(1))})
    key = ["label", "dim", "h1", "h2"]
    live = rows.filter("vec is not null")
    reps = (live.groupBy(*key).agg(F.min("id").alias("low"), F.count("*").alias("n"), F.first("vec").alias("vec"))
            .withColumn("node", F.monotonically_increasing_id()))
    reps = materialize(reps, "embed-vectors")
    largest = reps.groupBy("label").agg(F.count("*").alias("n")).agg(F.max("n").alias("m"), F.sum("n").alias("s")).first()
    given = passes is not None
    if not given:
        passes = passes_for(largest["m"] or 0, threshold, window)
    comp = _linked(reps, 0, passes, (largest["s"] or 0) * passes, window, threshold, seed, kind)
    if not given:
        # what is joined counts as one vector, so that copies are no crowd
        joined = comp.filter("node <> component").select("node")
        more = materialize(crowding(reps.join(joined, "node", "left_anti"), passes, threshold, window, MISS, seed, kind), "embed-crowds")
        need = more.agg(F.max("passes")).first()[0]
        if need:
            crowd = reps.join(more, ["label", "dim"])
            rows_more = crowd.agg(F.sum(F.col("passes") - passes)).first()[0]
            comp = _linked(crowd, passes, need, rows_more, window, threshold, seed, kind, comp)
    comp = materialize(reps.select("node", "dim", "vec", "n", "low", *[c for c in key if c != "dim"]).join(comp, "node"), "embed-members")
    best = comp.groupBy("component").agg(F.min("low").alias("component_id"), F.count("*").alias("m"))
    linked = _counts(comp.select("component", "node", "n", "dim", "vec"), best.select("component", "m"), threshold, kind, part)
    of = (comp.select("node", "component", "n", *key).join(linked, "node").join(best.select("component", "component_id"), "component")
          .select(*key, (F.col("n") - 1 + F.col("linked")).alias("n_links"), "component_id"))
    alone = (reps.join(comp.select("node"), "node", "left_anti")
             .select(*key, (F.col("n") - 1).alias("n_links"), F.col("low").alias("component_id")))
    named = of.unionByName(alone).withColumn("found", F.lit(True))
    out = rows.select("id", *key).join(named, key, "left")
    component = F.when(F.col("found"), F.col("component_id")).otherwise(F.col("id"))
    return out.select("id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
                      F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"))
