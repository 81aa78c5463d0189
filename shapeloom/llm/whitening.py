"""Embedding whitening: distributed covariance, eigenvectors by bisection, projection of every row.

Entries are put on a fixed grid (``floor(scale * c)``), so equal vectors are
equal integers. The fit list holds each distinct grid vector once. Two passes
over it give the exact sums and then the centred covariance, each as partial
results per task that Spark adds up; only sums over dimensions reach the
driver, which finds the leading eigenvectors (``eigen``). One more pass over
the fit list measures what the whitening left, and a last pass projects all rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .eigen import leading_eigenpairs
from .storage import run_dir, written

LONG_MIN, LONG_MAX = -(1 << 63), (1 << 63) - 1
_TYPES = (np.dtype("<i1"), np.dtype("<i2"), np.dtype("<i4"), np.dtype("<i8"))
#: A component whose variance is below this share of the trace counts as flat.
FLAT = 1e-13


def to_grid(values: np.ndarray, scale: float) -> np.ndarray:
    """floor(scale * value) as int64; beyond the range of a long, its nearest end."""
    grid = np.floor(scale * values.astype(np.float64))
    top = grid >= 2.0 ** 63
    out = np.where(top, 0.0, np.maximum(grid, -2.0 ** 63)).astype(np.int64)
    out[top] = LONG_MAX
    return out


def _packed(x: np.ndarray) -> bytes:
    """The vector as bytes of the narrowest integer type that holds it, and that type."""
    low, high = int(x.min(initial=0)), int(x.max(initial=0))
    for code, kind in enumerate(_TYPES):
        info = np.iinfo(kind)
        if info.min <= low and high <= info.max:
            return bytes([code]) + x.astype(kind).tobytes()
    raise ValueError("not a vector of longs")


def _unpacked(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, dtype=_TYPES[raw[0]], offset=1).astype(np.int64)


def on_grid(vectors: DataFrame, scale: float = 256.0, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id, dim, x (packed bytes) of the rows whose vector has only finite entries."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(1)
            flat = column.flatten().to_numpy(zero_copy_only=False)
            grid = to_grid(flat, scale)
            at = np.concatenate([[0], np.cumsum(column.value_lengths().to_numpy(zero_copy_only=False))]).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.diff(at).astype(np.int32)),
                 pa.array([_packed(grid[a:b]) for a, b in zip(at[:-1], at[1:])], pa.binary())],
                names=["vec_id", "dim", "x"])
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"),
                          F.col(vector_col).cast("array<double>").alias("vector"))
    finite = ~F.exists("vector", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return rows.where(F.col("vector").isNotNull() & finite).mapInArrow(run, "vec_id bigint, dim int, x binary")


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return np.stack([_unpacked(v) for v in column.to_pylist()]) if len(column) else np.zeros((0, dim), dtype=np.int64)


def _by_dim(batch: pa.RecordBatch, dim_at: int, x_at: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(dim, rows of the batch, their vectors) for each dimension in a batch."""
    dims = batch.column(dim_at).to_numpy(zero_copy_only=False)
    for dim in np.unique(dims).tolist():
        rows = np.flatnonzero(dims == dim)
        yield dim, rows, _matrix(batch.column(x_at).take(pa.array(rows)), dim)


def sums(fit: DataFrame) -> dict[int, tuple[int, list[int]]]:
    """dim -> (vectors, exact sum of each entry) over the fit list."""
    def run(batches):
        total: dict[int, list] = {}
        for batch in batches:
            for dim, rows, x in _by_dim(batch, 0, 1):
                # split in halves of 32 bits, so that no sum of a batch overflows
                s = [(int(a) << 32) + int(b) for a, b in zip((x >> 32).sum(axis=0), (x & 0xFFFFFFFF).sum(axis=0))]
                n, old = total.get(dim, (0, [0] * dim))
                total[dim] = (n + len(rows), [a + b for a, b in zip(old, s)])
        for dim, (n, s) in total.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([dim] * dim, pa.int32()), pa.array(range(dim), pa.int32()), pa.array([n] * dim, pa.int64()),
                 pa.array([str(v) for v in s], pa.string())], names=["dim", "i", "n", "s"])
    parts = fit.select("dim", "x").mapInArrow(run, "dim int, i int, n bigint, s string")
    whole = parts.groupBy("dim", "i").agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s"))
    out: dict[int, tuple[int, list[int]]] = {}
    for row in whole.orderBy("dim", "i").collect():  # a row per dimension
        out.setdefault(row.dim, (row.n, []))[1].append(int(row.s))
    return out


def _centred(x: np.ndarray, n: int, s: list[int]) -> np.ndarray:
    """x - s / n, each mean split into a whole and a broken part to keep the difference exact."""
    whole = [v // n for v in s]
    broken = np.array([(v - w * n) / n for v, w in zip(s, whole)])
    return (x.astype(np.float64) - np.array(whole, dtype=np.float64)) - broken


def _gram(fit: DataFrame, project, sizes: dict[int, int]) -> dict[int, np.ndarray]:
    """dim -> sum over the fit list of p p', where p is the row that ``project`` makes of a vector."""
    def run(batches):
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for dim, _, x in _by_dim(batch, 0, 1):
                p = project(dim, x)
                total[dim] = total.get(dim, 0.0) + p.T @ p
        for dim, g in total.items():
            i, j = np.triu_indices(len(g))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(i), dim), pa.int32()), pa.array(i, pa.int32()), pa.array(j, pa.int32()),
                 pa.array(g[i, j])], names=["dim", "i", "j", "v"])
    parts = fit.select("dim", "x").mapInArrow(run, "dim int, i int, j int, v double")
    out = {dim: np.zeros((k, k)) for dim, k in sizes.items()}
    for row in parts.groupBy("dim", "i", "j").agg(F.sum("v").alias("v")).toLocalIterator():  # an entry per row
        out[row.dim][row.i, row.j] = out[row.dim][row.j, row.i] = row.v
    return out


@dataclass(frozen=True)
class Whitening:
    """Of one dimension: n and sums of the fit list, and its leading components."""

    n: int
    sums: list[int]
    values: np.ndarray       # eigenvalues, falling
    components: np.ndarray   # dim x k, unit columns
    explained: np.ndarray    # values / trace
    identity_error: float | None

    def flat(self) -> np.ndarray:
        return np.isnan(self.explained) | (self.explained <= FLAT)

    def project(self, x: np.ndarray) -> np.ndarray:
        """rows x k: whitened values; NaN for flat components."""
        scale = np.where(self.flat(), np.nan, np.sqrt(np.maximum(self.values, np.finfo(float).tiny)))
        return _centred(x, self.n, self.sums) @ self.components / scale

    def deviations(self, x: np.ndarray) -> list[int]:
        """sum over entries of (n * x - sums) ** 2, exact."""
        s = np.array(self.sums, dtype=object)
        reach = self.n * int(np.abs(x.astype(object)).max(initial=0)) + max(map(abs, self.sums), default=0)
        if reach * reach * max(len(s), 1) <= LONG_MAX:
            d = self.n * x - s.astype(np.int64)
            return (d * d).sum(axis=1).tolist()
        d = self.n * x.astype(object) - s
        return (d * d).sum(axis=1).tolist()


def fit(vectors: DataFrame, components: int = 4) -> dict[int, Whitening]:
    """The whitening of each dimension in ``vectors`` (see ``on_grid``)."""
    spark = vectors.sparkSession
    # copies meet in the map-side half of the distinct, so a hot vector is one row a task
    distinct = written(vectors.where("dim > 0").select("dim", "x").distinct(), run_dir(spark, "whitening"), "fit")
    totals = sums(distinct)
    sizes = {dim: dim for dim in totals}
    grams = _gram(distinct, lambda dim, x: _centred(x, *totals[dim]), sizes)
    fitted = {}
    for dim, (n, s) in totals.items():
        covariance = grams[dim] / n
        trace = float(np.trace(covariance))
        values, axes = leading_eigenpairs(covariance, components)
        explained = values / trace if trace > 0 else np.full(len(values), np.nan)
        fitted[dim] = Whitening(n, s, values, axes, explained, None)
    live = {dim: w.components.shape[1] - int(w.flat().sum()) for dim, w in fitted.items()}
    left = _gram(distinct, lambda dim, x: fitted[dim].project(x)[:, ~fitted[dim].flat()], live)
    for dim, w in fitted.items():
        error = float(np.abs(left[dim] / w.n - np.eye(live[dim])).max()) if live[dim] else None
        fitted[dim] = Whitening(w.n, w.sums, w.values, w.components, w.explained, error)
    return fitted


def whiten(vectors: DataFrame, components: int = 4, scale: float = 256.0,
           id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Every row's vector whitened on the leading components: a row per input row and component.

    vec_id, component (from 1), n, deviation, whitened, explained,
    identity_error, dim. Left out are null vectors, vectors with a null or
    non-finite entry and empty vectors (no component). Repeated rows and null
    ids each keep their rows; equal vectors count once in the fit. Vectors of
    different length are whitened apart, each length by its own fit list. A
    component without variance (one distinct vector, or fewer independent
    ones than components) has whitened null, and explained 0, null where
    nothing varies. Components of equal variance come in any rotation.
    Entries beyond the range of a long count as its ends; a deviation beyond
    it is null, its digits are in ``deviation_text``. Only the two named
    columns are read; an empty table gives no rows.
    """
    spark = vectors.sparkSession
    rows = written(on_grid(vectors, scale, id_col, vector_col).where("dim > 0"), run_dir(spark, "whitening"), "grid")
    held = spark.sparkContext.broadcast(fit(rows, components))  # per dimension: dim x components numbers

    def run(batches):
        for batch in batches:
            for dim, at, x in _by_dim(batch, 1, 2):
                w = held.value[dim]
                k = w.components.shape[1]
                exact = w.deviations(x)
                flat = w.project(x).ravel()
                count = len(at)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).take(pa.array(np.repeat(at, k))),
                    pa.array(np.tile(np.arange(1, k + 1), count), pa.int32()),
                    pa.array([w.n] * (count * k), pa.int64()),
                    pa.array([v if v <= LONG_MAX else None for v in exact for _ in range(k)], pa.int64()),
                    pa.array(flat, pa.float64(), mask=np.isnan(flat)),
                    pa.array(np.tile(w.explained, count), pa.float64(), mask=np.isnan(np.tile(w.explained, count))),
                    pa.array([w.identity_error] * (count * k), pa.float64()),
                    pa.array([dim] * (count * k), pa.int32()),
                    pa.array([str(v) for v in exact for _ in range(k)], pa.string())],
                    names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error", "dim",
                           "deviation_text"])
    return rows.mapInArrow(run, "vec_id bigint, component int, n bigint, deviation bigint, whitened double, "
                                "explained double, identity_error double, dim int, deviation_text string")
