"""Embedding whitening through blockwise QR and a bidiagonal qd solver.

Entries become integers, so that sums over any number of rows are exact.  The
fit list holds each different vector once.  Every partition reduces its centred
rows block by block to a triangular factor R; the factors are merged by a tree
of further QR steps until a handful are left (their size depends on the vector
length alone).  The singular values of the last R give the covariance's
eigenvalues without forming the covariance, its right singular vectors the
directions (``bidiagonal.py``).  A last pass measures how far the whitened
rows' covariance is from the identity.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicscan.llm.bidiagonal import right_singular
from civicscan.llm.common import materialize, ship_package

#: An entry c becomes floor(SCALE * c) + OFFSET.
SCALE = 64
OFFSET = 1_000_000
COMPONENTS = 16
#: Triangular factors merged in one task.
FAN_IN = 16
#: Rows centred and reduced at a time.
BLOCK = 4096
#: Scaled entries are held within this bound, so they stay longs.
BOUND = 1 << 62


# --- vectors as packed integers

def pack(entries: np.ndarray) -> list[bytes]:
    """Rows of scaled entries as one width byte and little-endian integers of
    the smallest width that holds the row: equal rows, equal bytes."""
    y = np.clip(np.floor(entries * SCALE), -float(BOUND), float(BOUND)).astype(np.int64)
    need = np.maximum(y.max(axis=1), -1 - y.min(axis=1))
    width = np.select([need < 1 << 7, need < 1 << 15, need < 1 << 31], [1, 2, 4], 8)
    out: list[bytes] = [b""] * len(y)
    for w in np.unique(width).tolist():
        at = np.flatnonzero(width == w)
        raw, size, head = y[at].astype(f"<i{w}").tobytes(), y.shape[1] * w, bytes([w])
        for k, i in enumerate(at.tolist()):
            out[i] = head + raw[k * size:(k + 1) * size]
    return out


def unpack(rows: list[bytes], dim: int) -> np.ndarray:
    """Packed rows of one length as an array of longs."""
    out = np.empty((len(rows), dim), np.int64)
    width = np.array([r[0] for r in rows])
    for w in np.unique(width).tolist():
        at = np.flatnonzero(width == w)
        out[at] = np.frombuffer(b"".join(rows[i][1:] for i in at.tolist()), f"<i{w}").reshape(len(at), dim)
    return out


def _packed(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """``id, dim, y`` of the rows whose vector has entries, all of them finite."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, BLOCK):
                part = batch.slice(start, BLOCK)
                ids, vectors = part.column(0), part.column(1)
                sizes = np.array(vectors.value_lengths().fill_null(0))
                for dim in np.unique(sizes[sizes > 0]).tolist():
                    at = np.flatnonzero(sizes == dim)
                    x = vectors.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(at), dim)
                    whole = np.isfinite(x).all(axis=1)
                    with np.errstate(over="ignore"):
                        y = pack(x[whole]) if whole.any() else []
                    yield pa.RecordBatch.from_pydict({"id": ids.take(pa.array(at[whole])), "dim": pa.array([dim] * len(y), pa.int32()),
                                                      "y": pa.array(y, pa.binary())})

    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("v"))
    return rows.mapInArrow(run, "id long, dim int, y binary")


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray, pa.RecordBatch]]:
    """``dim``, the entries of the rows of that length, and those rows."""
    for batch in batches:
        for start in range(0, batch.num_rows, BLOCK):
            part = batch.slice(start, BLOCK)
            dims = part.column(part.schema.get_field_index("dim")).to_numpy()
            for dim in np.unique(dims).tolist():
                some = part.take(pa.array(np.flatnonzero(dims == dim)))
                yield dim, unpack(some.column(some.schema.get_field_index("y")).to_pylist(), dim), some


# --- the fit

@dataclass
class Fit:
    """What the rows of one vector length share."""
    n: int  # vectors of the fit list
    sums: list[int]  # of the entries without OFFSET, exact
    directions: np.ndarray | None = None  # as columns
    values: np.ndarray | None = None  # eigenvalues of the covariance, descending
    trace: float = 0.0
    error: float | None = None  # of the whitened rows' covariance against the identity

    def spread(self, y: np.ndarray) -> np.ndarray:
        """n * entry - sum, as longs, or as Python integers where longs don't hold it."""
        most = max(int(y.max(initial=0)), -int(y.min(initial=0)))
        if self.n * most + max(map(abs, self.sums), default=0) < BOUND:
            return y * self.n - np.array(self.sums, np.int64)
        return y.astype(object) * self.n - np.array(self.sums, object)

    def centred(self, y: np.ndarray) -> np.ndarray:
        return self.spread(y).astype(np.float64) / self.n

    def whitened(self, y: np.ndarray) -> np.ndarray:
        return self.centred(y) @ self.directions / np.sqrt(self.values)


def _sums(fit: DataFrame) -> dict[int, Fit]:
    """Rows and exact sums per vector length, a row per partition and dimension before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n: dict[int, int] = {}
        total: dict[int, np.ndarray] = {}
        for dim, y, _ in _blocks(batches):
            wide = np.abs(y).max() >= 1 << 40
            s = (y.astype(object) if wide else y).sum(axis=0).astype(object)
            n[dim], total[dim] = n.get(dim, 0) + len(y), total.get(dim, 0) + s
        for dim, s in total.items():
            yield pa.RecordBatch.from_pydict({
                "dim": pa.array([dim] * dim, pa.int32()), "at": pa.array(range(dim), pa.int32()), "n": pa.array([n[dim]] * dim, pa.int64()),
                "s": pa.array([Decimal(int(v)) for v in s], pa.decimal128(38, 0))})

    got = fit.mapInArrow(run, "dim int, at int, n long, s decimal(38,0)").groupBy("dim", "at").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
    out: dict[int, Fit] = {}
    for r in sorted(got.collect(), key=lambda r: (r["dim"], r["at"])):
        out.setdefault(r["dim"], Fit(r["n"], [])).sums.append(int(r["s"]))
    return out


def _merge(r: np.ndarray | None, rows: np.ndarray) -> np.ndarray:
    return np.linalg.qr(rows if r is None else np.concatenate([r, rows]), "r")


def _factors(fit: DataFrame, models: dict[int, Fit]) -> dict[int, np.ndarray]:
    """The triangular factor of the centred rows of each vector length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got: dict[int, np.ndarray] = {}
        for dim, y, _ in _blocks(batches):
            got[dim] = _merge(got.get(dim), models[dim].centred(y))
        yield pa.RecordBatch.from_pydict({"dim": pa.array(list(got), pa.int32()), "r": pa.array([r.tobytes() for r in got.values()], pa.binary())})

    def merge(t: pa.Table) -> pa.Table:
        dim, r = t["dim"][0].as_py(), None
        for raw in t["r"].to_pylist():
            r = _merge(r, np.frombuffer(raw).reshape(-1, dim))
        return pa.table({"task": t["task"][:1], "dim": t["dim"][:1], "r": pa.array([r.tobytes()], pa.binary())})

    factors = materialize(fit.mapInArrow(run, "dim int, r binary").select(F.spark_partition_id().alias("task"), "dim", "r"), "whitening-factors")
    while (factors.groupBy("dim").count().agg(F.max("count")).first()[0] or 0) > FAN_IN:
        factors = factors.withColumn("task", F.floor(F.col("task") / FAN_IN).cast("int"))
        factors = materialize(factors.groupBy("task", "dim").applyInArrow(merge, "task int, dim int, r binary"), "whitening-factors")
    out: dict[int, np.ndarray] = {}
    for row in factors.orderBy("dim", "task").collect():  # FAN_IN of a length at most
        out[row["dim"]] = _merge(out.get(row["dim"]), np.frombuffer(row["r"]).reshape(-1, row["dim"]))
    return out


def _errors(fit: DataFrame, models: dict[int, Fit]) -> dict[int, float]:
    """The largest entry of |covariance - identity| of the whitened fit list, by its sums of products."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for dim, y, _ in _blocks(batches):
            w = models[dim].whitened(y)
            w = np.concatenate([np.ones((len(w), 1)), w], axis=1)  # products with 1 are the plain sums
            total[dim] = total.get(dim, 0) + w.T @ w
        for dim, s in total.items():
            i, j = np.indices(s.shape)
            yield pa.RecordBatch.from_pydict({"dim": pa.array([dim] * s.size, pa.int32()), "i": pa.array(i.ravel(), pa.int32()),
                                              "j": pa.array(j.ravel(), pa.int32()), "s": pa.array(s.ravel(), pa.float64())})

    got = fit.mapInArrow(run, "dim int, i int, j int, s double").groupBy("dim", "i", "j").agg(F.sum("s").alias("s")).collect()
    out = {}
    for dim, m in models.items():
        k = len(m.values)
        s = np.zeros((k + 1, k + 1))
        for r in got:
            if r["dim"] == dim:
                s[r["i"], r["j"]] = r["s"] / m.n
        out[dim] = float(np.abs(s[1:, 1:] - np.outer(s[0, 1:], s[0, 1:]) - np.eye(k)).max()) if k else 0.0
    return out


def fit_models(fit: DataFrame, components: int = COMPONENTS) -> dict[int, Fit]:
    """A model for each vector length in the fit list (``dim, y``, different rows)."""
    models = _sums(fit)
    for dim, r in _factors(fit, models).items():
        m = models[dim]
        squares, m.directions = right_singular(r, components)
        m.values, m.trace = squares / m.n, float((r * r).sum()) / m.n
    for dim, e in _errors(fit, models).items():
        models[dim].error = e
    return models


def whiten(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """``(id, component, n, deviation, whitened, explained, identity_error)``:
    a row per vector and component, numbered from 1 by falling eigenvalue.

    Null and empty vectors and those with null or non-finite entries have no
    rows.  Equal vectors count once in the fit and get equal results; repeated
    rows and null ids are returned as they come.  Directions whose eigenvalue
    is zero but for rounding can't be whitened and are no components, so one
    vector alone, or equal ones, have no rows.  Vectors of each length are a
    table of their own.  ``deviation`` is null where it exceeds a long, and
    scaled entries beyond 2^62 are held at it.  Other columns are not looked
    at.  An empty table gives an empty result.
    """
    ship_package(df.sparkSession)
    rows = _packed(df, id_col, vec_col)
    fit = materialize(rows.select("dim", "y").distinct(), "whitening-fit")
    models = fit_models(fit, components)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for dim, y, some in _blocks(batches):
            m = models[dim]
            k = len(m.values)
            spread = m.spread(y)
            if spread.dtype == object or float(np.abs(spread).max()) ** 2 * dim >= BOUND:
                squares = (spread.astype(object) ** 2).sum(axis=1)
                deviation = pa.array([int(s) if s < 1 << 63 else None for s in squares], pa.int64())
            else:
                deviation = pa.array((spread * spread).sum(axis=1))
            row = pa.array(np.repeat(np.arange(len(y)), k))
            yield pa.RecordBatch.from_pydict({
                "id": some.column(0).take(row), "component": pa.array(np.tile(np.arange(1, k + 1), len(y)), pa.int32()),
                "n": pa.array(np.full(len(row), m.n), pa.int64()), "deviation": deviation.take(row),
                "whitened": pa.array((spread.astype(np.float64) / m.n @ m.directions / np.sqrt(m.values)).ravel()),
                "explained": pa.array(np.tile(m.values / m.trace if k else m.values, len(y))),
                "identity_error": pa.array(np.full(len(row), m.error))})

    return rows.mapInArrow(run, "id long, component int, n long, deviation long, whitened double, explained double, identity_error double")
