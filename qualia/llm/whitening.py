"""Embedding whitening from an exact covariance found by polarisation.

Entries become integers, x = floor(256 c). The fit list holds each distinct x vector once. Two passes
over it aggregate integers only: the sums S per dimension, and then, for values centred at the nearest
integer of the mean (y = x - m), the squares of every dimension and of every sum of two
dimensions. What is left of the mean (S - n m) is taken off exactly in whole numbers, so that these are
the exact sums of squares of n x - S and of its pair sums; a cross-covariance is half the difference
of the pair's variance and its two dimensions' variances. The matrix goes to ``eigh``, and each row is
projected on the leading eigenvectors and divided by the root of their eigenvalues.

Sums are exact: 64-bit arithmetic in blocks that cannot overflow (whole Python numbers where values
are too large for that), 38-digit decimals between tasks. Tasks send dim * (dim + 1) / 2 sums each, so
the passes use a bounded number of tasks; the driver holds dim ** 2 numbers whatever the rows.

Defined results: rows whose vector is null, or holds null, NaN, infinite or (in absolute value, times
256) entries of 2**53 and more, are dropped. The dimension is that of most distinct vectors (ties: the
larger); rows of other lengths are dropped. Repeated vectors count once in the fit list, and each row
of the table has its result; null and repeated ids are kept as they are. Components with an eigenvalue
of zero (to rounding) have none, so a table of equal vectors gives no rows, as an empty one does.
Other columns are not read. A deviation that no long can hold is null.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qualia.session import scratch_path

SCALE = 256
_SAFE = 1 << 62
_ENTRY_LIMIT = float(1 << 53)
_BLOCK = 4096


def integer_vectors(column: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, int64 matrix) of the usable vectors of a list column, one pair per length."""
    present = ~pc.is_null(column).to_numpy(zero_copy_only=False)
    sizes = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = pc.list_flatten(column)
    values = flat.cast(pa.float64()).to_numpy(zero_copy_only=False)  # null entries: NaN
    ends = np.cumsum(np.where(present, sizes, 0))
    starts = ends - np.where(present, sizes, 0)
    with np.errstate(invalid="ignore", over="ignore"):
        scaled = np.floor(SCALE * values)
        bad = np.concatenate([[0], np.cumsum(~(np.abs(scaled) < _ENTRY_LIMIT))])
    usable = present & (bad[ends] == bad[starts])
    out = []
    for size in np.unique(sizes[usable]).tolist():
        rows = np.flatnonzero(usable & (sizes == size))
        out.append((rows, scaled[starts[rows][:, None] + np.arange(size)].astype(np.int64)))
    return out


def _packed(x: np.ndarray) -> list[bytes]:
    """One byte string per vector: little-endian integers of the least width of 2, 4, 8 that holds its entries."""
    largest = np.abs(x).max(axis=1, initial=0)
    out: list[bytes] = [b""] * len(x)
    for width, low, high in ((2, -1, (1 << 15) - 1), (4, (1 << 15) - 1, (1 << 31) - 1), (8, (1 << 31) - 1, 1 << 62)):
        rows = np.flatnonzero((largest > low) & (largest <= high))
        data = np.ascontiguousarray(x[rows].astype(f"<i{width}"))
        for row, line in zip(rows.tolist(), data):
            out[row] = line.tobytes()
    return out


def _unpacked(column: pa.Array, dim: int) -> np.ndarray:
    sizes = pc.binary_length(column).to_numpy(zero_copy_only=False)
    out = np.zeros((len(column), dim), dtype=np.int64)
    for size in np.unique(sizes).tolist():
        rows = np.flatnonzero(sizes == size)
        raw = b"".join(column.take(pa.array(rows)).to_pylist())
        out[rows] = np.frombuffer(raw, dtype=f"<i{size // dim}").reshape(len(rows), dim)
    return out


def exact_sums(y: np.ndarray) -> list[int]:
    """Column sums of a matrix of integers, as whole numbers."""
    if len(y) and int(np.abs(y).max()) * len(y) >= _SAFE:
        y = y.astype(object)
    return [int(v) for v in y.sum(axis=0)]


def polarised_squares(y: np.ndarray) -> list[int]:
    """Sums of y_i ** 2 for every column i and of (y_i + y_j) ** 2 for i < j, row by row of the upper triangle."""
    dim = y.shape[1]
    exact = len(y) and 4 * int(np.abs(y).max()) ** 2 * len(y) < _SAFE
    columns = np.ascontiguousarray(y.T) if exact else y.T.astype(object)
    out: list[int] = []
    for i in range(dim):
        out.append(int((columns[i] * columns[i]).sum()))
        if i + 1 < dim:
            both = columns[i + 1:] + columns[i]
            out.extend(int(v) for v in (np.einsum("ij,ij->i", both, both) if exact else (both * both).sum(axis=1)))
    return out


def _blocks(batches: Iterable[pa.RecordBatch], dim: int) -> Iterator[np.ndarray]:
    for batch in batches:
        for at in range(0, batch.num_rows, _BLOCK):
            yield _unpacked(batch.column("packed").slice(at, _BLOCK), dim)


@dataclass(frozen=True)
class Whitening:
    """What a fit gives: rows of the fit list, their sums, leading unit eigenvectors (columns), eigenvalues, and
    the trace of the covariance; ``identity_error`` is measured on the fit list."""

    n: int
    sums: list
    covariance: np.ndarray
    vectors: np.ndarray
    values: np.ndarray
    identity_error: float

    @property
    def dim(self) -> int:
        return len(self.sums)

    def project(self, x: np.ndarray) -> np.ndarray:
        """Whitened values (rows x components) of integer vectors."""
        return self.offsets(x).astype(np.float64) / self.n @ (self.vectors / np.sqrt(self.values))

    def offsets(self, x: np.ndarray) -> np.ndarray:
        """n x - S, exact."""
        sums = np.array(self.sums, dtype=object)
        largest = int(np.abs(x).max(initial=0)) * self.n + max((abs(s) for s in self.sums), default=0)
        return self.n * x - sums.astype(np.int64) if largest < _SAFE else x.astype(object) * self.n - sums

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sum over dimensions of (n x - S) ** 2, exact; None beyond 64 bits."""
        z = self.offsets(x)
        if z.dtype != object and int(np.abs(z).max(initial=0)) ** 2 * self.dim < _SAFE:
            return (z * z).sum(axis=1).tolist()
        totals = [int(v) for v in (z.astype(object) ** 2).sum(axis=1)]
        return [v if v < 1 << 63 else None for v in totals]


def _task_limited(df: DataFrame) -> DataFrame:
    """At most 4 tasks per core of the cluster (each sends dim ** 2 / 2 sums)."""
    return df.coalesce(4 * df.sparkSession.sparkContext.defaultParallelism)


def _total(fit: DataFrame, dim: int, sums_of, width: int) -> list[int]:
    """Sum over all blocks of the fit list of ``sums_of(block)``, a list of ``width`` whole numbers."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [0] * width
        for x in _blocks(batches, dim):
            total = [a + b for a, b in zip(total, sums_of(x))]
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(width), pa.int32()), pa.array([Decimal(v) for v in total], pa.decimal128(38, 0))], names=["k", "v"])

    parts = _task_limited(fit).mapInArrow(run, "k int, v decimal(38,0)")
    rows = parts.groupBy("k").agg(F.sum("v").alias("v")).collect()  # width rows
    out = [0] * width
    for row in rows:
        out[row.k] = int(row.v)
    return out


def fit_list(vectors: DataFrame, vector_col: str = "embedding") -> DataFrame:
    """dim, packed: each distinct usable integer vector once (written)."""
    spark = vectors.sparkSession

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, x in integer_vectors(batch.column("vector")):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(x), x.shape[1], np.int32)), pa.array(_packed(x), pa.binary())], names=["dim", "packed"])

    path = scratch_path(spark, "whitening-fit")
    found = vectors.select(F.col(vector_col).cast("array<double>").alias("vector")).mapInArrow(run, "dim int, packed binary")
    found.distinct().write.parquet(path)
    return spark.read.schema("dim int, packed binary").parquet(path)


def fit(vectors: DataFrame, vector_col: str = "embedding", components: int = 4) -> Whitening | None:
    """Covariance, components and measured identity error; None without usable vectors."""
    fitted = fit_list(vectors, vector_col)
    dims = fitted.where("dim > 0").groupBy("dim").agg(F.count(F.lit(1)).alias("n"))
    best = dims.orderBy(F.desc("n"), F.desc("dim")).first()
    if best is None:
        return None
    dim, n = best.dim, best.n
    fitted = fitted.where(F.col("dim") == dim).select("packed")
    sums = _total(fitted, dim, exact_sums, dim)
    centre = [(2 * s + n) // (2 * n) for s in sums]  # nearest integer of the mean
    rest = [s - n * c for s, c in zip(sums, centre)]
    shift = np.array(centre, dtype=np.int64)
    squares = _total(fitted, dim, lambda x: polarised_squares(x - shift), dim * (dim + 1) // 2)
    # sums of squares of n x - S (and of its pair sums), times 1 / n
    spread, at = np.zeros((dim, dim), dtype=object), 0
    for i in range(dim):
        for j in range(i, dim):
            off = rest[i] if i == j else rest[i] + rest[j]
            spread[i, j] = n * squares[at] - off * off
            at += 1
    covariance = np.zeros((dim, dim))
    for i in range(dim):
        covariance[i, i] = spread[i, i] / n**2
        for j in range(i + 1, dim):
            covariance[i, j] = covariance[j, i] = (spread[i, j] - spread[i, i] - spread[j, j]) / (2 * n**2)
    values, basis = np.linalg.eigh(covariance)
    order = np.argsort(-values, kind="stable")[:components]
    order = order[values[order] > max(float(values.max()), 0.0) * dim * np.finfo(float).eps]
    basis = basis[:, order]
    if len(order):  # the sign with which the largest entry is positive
        basis = basis * np.where(basis[np.abs(basis).argmax(axis=0), np.arange(len(order))] < 0, -1.0, 1.0)
    model = Whitening(n, sums, covariance, basis, values[order], 0.0)
    return Whitening(n, sums, covariance, basis, values[order], _identity_error(fitted, model))


def _identity_error(fitted: DataFrame, model: Whitening) -> float:
    """Largest absolute entry of the whitened fit list's covariance minus the identity, from the whitened values."""
    k = len(model.values)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k + 1, k))
        for x in _blocks(batches, model.dim):
            w = model.project(x)
            total += np.vstack([w.sum(axis=0), w.T @ w])
        yield pa.RecordBatch.from_arrays([pa.array(range(total.size), pa.int32()), pa.array(total.reshape(-1))], names=["k", "v"])

    if not k:
        return 0.0
    rows = _task_limited(fitted).mapInArrow(run, "k int, v double").groupBy("k").agg(F.sum("v").alias("v")).collect()
    total = np.zeros((k + 1) * k)
    for row in rows:  # k * (k + 1) sums
        total[row.k] = row.v
    total = total.reshape(k + 1, k) / model.n
    return float(np.abs(total[1:] - np.outer(total[0], total[0]) - np.eye(k)).max())


def whiten(vectors: DataFrame, model: Whitening | None, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Per usable row and component: vec_id, component (from 1), n, deviation, whitened, explained, identity_error."""
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    trace = float(np.trace(model.covariance)) if model else 0.0

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, x in integer_vectors(batch.column("vector")) if model else []:
                if x.shape[1] != model.dim or not len(model.values):
                    continue
                k, ids = len(model.values), batch.column("vec_id").take(pa.array(rows))
                w, each = model.project(x), pa.array(np.repeat(np.arange(len(rows)), k))
                deviations = pa.array(model.deviations(x), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [ids.take(each), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(rows))),
                     pa.array(np.full(len(rows) * k, model.n, np.int64)), deviations.take(each), pa.array(w.reshape(-1)),
                     pa.array(np.tile(model.values / trace, len(rows))), pa.array(np.full(len(rows) * k, model.identity_error))],
                    names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    src = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector"))
    return src.mapInArrow(run, schema)
