"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civicscan.session import materialize, ship_package

__all__ = ["components", "documents", "fresh", "map_arrow", "materialize", "ship_package", "table", "worker_state"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def fresh(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not have (names are case-insensitive)."""
    taken = {c.lower() for c in df.columns}
    name = base
    while name.lower() in taken:
        name += "_"
    return name


def map_arrow(df: DataFrame, fn: Callable[[dict[str, list]], dict[str, object]], schema: str,
              rows: int = 256) -> DataFrame:
    """Apply ``fn`` (columns as Python lists -> columns) to slices of at most
    ``rows`` rows, whatever the session's Arrow batch size is."""
    ship_package(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                part = batch.slice(at, rows)
                out = fn({n: part.column(i).to_pylist() for i, n in enumerate(part.schema.names)})
                yield pa.RecordBatch.from_pydict(out)

    return df.mapInArrow(run, schema)


_STATE: dict = {}


def worker_state(key: object, build: Callable[[], object]):
    """The tables an operator keeps in a Python worker between tasks.  Workers
    are reused by other stages, so only one operator's tables are held at a time."""
    if _STATE.get("key") != key:
        _STATE.clear()
        _STATE.update(key=key, value=build())
    return _STATE["value"]


class Forest:
    """Union-find over hashable nodes; the root is the smallest member."""

    def __init__(self) -> None:
        self.up: dict = {}

    def find(self, x):
        up = self.up
        root = x
        while (y := up.setdefault(root, root)) != root:
            root = y
        while up[x] != root:
            up[x], x = root, up[x]
        return root

    def link(self, a, b) -> None:
        a, b = self.find(a), self.find(b)
        if a != b:
            self.up[max(a, b)] = min(a, b)

    def stars(self) -> tuple[list, list]:
        nodes = [x for x in self.up if self.find(x) != x]
        return nodes, [self.up[x] for x in nodes]


def _contract(edges: DataFrame) -> DataFrame:
    """Replace each partition's edges by a spanning star per local component."""

    def run(batches):
        f = Forest()
        for b in batches:
            for u, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                f.link(u, v)
        u, v = f.stars()
        yield pa.RecordBatch.from_pydict({"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64())})

    return edges.mapInArrow(run, "u long, v long")


def _checksum(edges: DataFrame) -> tuple:
    r = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
    return tuple(r)


def components(edges: DataFrame, name: str) -> DataFrame:
    """Connected components of an edge list ``(u long, v long)`` over any number of nodes.

    Returns ``(node, component)`` for each node of an edge between two
    different nodes; ``component`` is the smallest node reachable.  Large-star
    and small-star steps alternate until nothing changes.  Each step takes a
    minimum per node (partially aggregated) and joins it back, so a node with
    very many edges never gathers in a task; each round is a table in the
    shared folder, so a lost executor costs a retry of that round only.
    """
    ship_package(edges.sparkSession)
    e = (edges.filter("u is not null and v is not null and u <> v")
         .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")))
    e = materialize(_contract(e).distinct(), name)
    seen = _checksum(e)
    while seen[0]:
        # large star: every larger neighbour of u is linked to the smallest of u's neighbourhood
        both = e.select("u", "v").unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .filter("u <> v").distinct())
        large = materialize(large, name)
        # small star: u and its smaller neighbours are linked to the smallest of them
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u")
                 .select(F.explode(F.array(F.struct(F.col("u"), F.col("m").alias("v")),
                                           F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
                 .select("e.*").filter("u <> v").distinct())
        e = materialize(small, name)
        now = _checksum(e)
        if now == seen:
            break
        seen = now
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def signed(x: int) -> int:
    """The 64-bit pattern ``x`` as Spark's signed long."""
    return x - (1 << 64) if x >= 1 << 63 else x


def as_long(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64), pa.int64())
