"""Embedding whitening: principal components by a matrix-free Jacobi-Davidson iteration.

Components c of a vector become integers x = floor(64 c) + 1000000.  With n vectors and the
per-dimension sums S, ``n * x - S`` is an exact integer, so centring loses nothing:
``x - S / n`` is that integer over n.  The added constant cancels in it and is not kept.

Method: the vectors are packed once into blocks of small integers.  The covariance matrix
is never formed: ``V Q`` for a block of columns Q is one pass over the packed table, each
task summing ``C' (C Q)`` over its centred rows C.  ``jacobi_davidson`` builds the
components from such products, with projected correction equations solved by inner MINRES
and Rayleigh-Ritz with locking, until all residuals are at double precision.

Scale: a task returns one matrix of dimension x columns doubles; these are summed in
``GROUPS`` groups by Spark, and the driver adds up ``GROUPS`` matrices, whatever the number
of tasks or vectors.  It holds dimension x 104 doubles a matrix (32 components wanted).
Sums of a group are taken in a fixed order, so reruns agree.  Packed entries take the
smallest of 1, 2, 4 or 8 bytes that holds them all, so a pass reads a quarter of the
table's bytes for entries between -2 and 2.

Defined results: rows whose vector is null or empty, or holds null or non-finite entries,
are dropped, as are vectors of another length than the most frequent one (the smallest of
equally frequent lengths).  Rows with null or repeated ids are vectors like any other.
Components whose eigenvalue is zero but for rounding (fewer distinct vectors than
components, constant dimensions) are left out, so equal vectors alone, or one, give no
rows; equal eigenvalues may take any orthonormal basis of their space.  A ``deviation`` that no
long holds is null; entries beyond 2 ** 45, or so far apart that ``n * x - S`` fits no long,
raise an error.  Other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .jacobi_davidson import largest_eigenpairs
from .tables import ship_code, written

COMPONENTS, SCALE = 32, 64
GROUPS, BLOCK = 16, 4096
LARGEST = float(1 << 45)
#: An eigenvalue up to this share of the largest is zero.
NOTHING = 1e-12


def _matrix(column: pa.Array, dimension: int) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(float)
    return flat.reshape(-1, dimension)


def _codes(column: pa.Array, dimension: int) -> np.ndarray:
    """floor(64 c) of every entry."""
    x = _matrix(column, dimension)
    if x.size and np.abs(x).max() > LARGEST:
        raise ValueError("an entry is too large for deviations in 64 bits")
    return np.floor(SCALE * x).astype(np.int64)


def _sums(dimension: int):
    """Per task and dimension: number of vectors, exact sum and sum of squares, extremes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, [0] * dimension
        squares = [0] * dimension
        low, high = np.full(dimension, 1 << 62), np.full(dimension, -(1 << 62))
        for batch in batches:
            for part in range(0, batch.num_rows, BLOCK):
                x = _codes(batch.column(0).slice(part, BLOCK), dimension)
                n += len(x)
                low, high = np.minimum(low, x.min(0)), np.maximum(high, x.max(0))
                exact = x if np.abs(x).max() < 1 << 24 else x.astype(object)
                total = [a + int(b) for a, b in zip(total, exact.sum(0))]
                squares = [a + int(b) for a, b in zip(squares, (exact * exact).sum(0))]
        if n:
            arrays = [pa.array(range(dimension), pa.int32()), pa.array([n] * dimension, pa.int64())]
            arrays += [pa.array(map(str, total), pa.string()), pa.array(map(str, squares), pa.string()), pa.array(low), pa.array(high)]
            yield pa.RecordBatch.from_arrays(arrays, ["place", "n", "total", "squares", "low", "high"])

    return run


def _pack(dimension: int, kind: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in range(0, batch.num_rows, BLOCK):
                some = batch.slice(part, BLOCK)
                ids = pa.ListArray.from_arrays(pa.array([0, some.num_rows], pa.int32()), some.column(0))
                x = _codes(some.column(1), dimension).astype(kind)
                yield pa.RecordBatch.from_arrays([ids, pa.array([x.tobytes()], pa.binary())], ["ids", "vectors"])

    return run


class Fit(NamedTuple):
    """Packed vectors (``ids``, ``vectors``), their entries' type and number, the number of
    vectors, exact sums of the codes per dimension and the trace of the covariance."""

    blocks: DataFrame
    kind: str
    dimension: int
    n: int
    sums: np.ndarray
    trace: float


def _deviations(packed: bytes, fit: tuple) -> np.ndarray:
    """``n * x - S`` of every vector of a block, exact."""
    kind, dimension, n, sums = fit
    return np.frombuffer(packed, kind).reshape(-1, dimension).astype(np.int64) * n - sums


def _product(fit: tuple, columns):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q = columns.value
        total = np.zeros_like(q)
        for batch in batches:
            for packed in batch.column(0):
                centred = _deviations(packed.as_py(), fit) / fit[2]
                total += centred.T @ (centred @ q)
        task = TaskContext.get().partitionId()
        yield pa.RecordBatch.from_arrays([pa.array([task % GROUPS]), pa.array([task]), pa.array([total.tobytes()], pa.binary())], ["part", "task", "sums"])

    return run


def _gram(fit: tuple, projection):
    """Products of the projected vectors among themselves."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn = projection.value
        total = np.zeros((turn.shape[1], turn.shape[1]))
        for batch in batches:
            for packed in batch.column(0):
                projected = _deviations(packed.as_py(), fit) / fit[2] @ turn
                total += projected.T @ projected
        task = TaskContext.get().partitionId()
        yield pa.RecordBatch.from_arrays([pa.array([task % GROUPS]), pa.array([task]), pa.array([total.tobytes()], pa.binary())], ["part", "task", "sums"])

    return run


def _added(group: pa.Table) -> pa.Table:
    order = np.argsort(group.column("task").to_numpy(), kind="stable")
    total = 0.0
    for at in order.tolist():
        total = total + np.frombuffer(group.column("sums")[at].as_py())
    return pa.table([group.column("part").slice(0, 1), pa.array([total.tobytes()], pa.binary())], ["part", "sums"])


def _summed(fit: Fit, step, shape: tuple[int, int]) -> np.ndarray:
    """The sum of the tasks' matrices: ``GROUPS`` partial sums at most reach the driver."""
    partial = fit.blocks.select("vectors").mapInArrow(step, "part long, task long, sums binary")
    rows = partial.groupBy("part").applyInArrow(_added, "part long, sums binary").collect()
    return sum((np.frombuffer(r["sums"]).reshape(shape) for r in sorted(rows)), np.zeros(shape))


def fit_list(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> Fit | None:
    """The usable vectors, packed, with their sums; None if there are none."""
    ship_code(vectors.sparkSession)
    entries = F.col("vector")
    rows = vectors.select(vectors[id_col].cast("long").alias("vec_id"), vectors[vector_col].alias("vector"))
    finite = F.forall(entries, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    rows = rows.filter(entries.isNotNull() & (F.size(entries) > 0) & finite)
    length = rows.groupBy(F.size(entries).alias("size")).count().orderBy(F.desc("count"), "size").limit(1).first()
    if length is None:
        return None
    dimension = length["size"]
    rows = rows.filter(F.size(entries) == dimension)
    numbers = T.DecimalType(38, 0)
    sums = rows.select("vector").mapInArrow(_sums(dimension), "place int, n long, total string, squares string, low long, high long")
    sums = sums.groupBy("place").agg(
        F.sum("n").alias("n"), *(F.sum(F.col(c).cast(numbers)).alias(c) for c in ("total", "squares")), F.min("low").alias("low"), F.max("high").alias("high")
    )
    found = sorted(sums.collect())  # one row a dimension
    n = found[0]["n"]
    low, high = min(r["low"] for r in found), max(r["high"] for r in found)
    kind = next(k for k in ("int8", "int16", "int32", "int64") if np.iinfo(k).min <= low and high <= np.iinfo(k).max)
    if n * max(abs(low), abs(high)) * 2 >= 1 << 63:
        raise ValueError("deviations of these vectors do not fit 64 bits")
    variance = sum(n * int(r["squares"]) - int(r["total"]) ** 2 for r in found) / n**2
    blocks = written(rows.mapInArrow(_pack(dimension, kind), "ids array<long>, vectors binary"), "whitening-vectors")
    return Fit(blocks, kind, dimension, n, np.array([int(r["total"]) for r in found], np.int64), variance)


def fit_components(fit: Fit, components: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (falling) and eigenvectors (columns) of the covariance, zero ones left out."""
    if not fit.trace:
        return np.zeros(0), np.zeros((fit.dimension, 0))
    spark, shared = fit.blocks.sparkSession, tuple(fit[1:5])

    def product(q: np.ndarray) -> np.ndarray:
        return _summed(fit, _product(shared, spark.sparkContext.broadcast(np.ascontiguousarray(q))), q.shape) / fit.n

    values, directions = largest_eigenpairs(product, fit.dimension, components)
    some = values > NOTHING * values[0]
    return values[some], directions[:, some]


_OUT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def _squared(deviations: np.ndarray) -> pa.Array:
    """Exact sums of squares per row; null where no long holds one."""
    large = (deviations.astype(float) ** 2).sum(1) >= 2.0**62
    if not large.any():
        return pa.array((deviations * deviations).sum(1))
    exact = [sum(int(v) ** 2 for v in row) for row in deviations]
    return pa.array([e if e < 1 << 63 else None for e in exact], pa.int64())


def _whiten(fit: tuple, model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn, explained, error = model.value
        k = turn.shape[1]
        for batch in batches:
            for ids, packed in zip(batch.column(0), batch.column(1)):
                deviations = _deviations(packed.as_py(), fit)
                rows = len(deviations)
                whitened = (deviations / fit[2]) @ turn
                each = pa.array(np.repeat(np.arange(rows), k))
                arrays = [
                    ids.values.take(each),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows)),
                    pa.array(np.full(rows * k, fit[2])),
                    _squared(deviations).take(each),
                    pa.array(whitened.ravel()),
                    pa.array(np.tile(explained, rows)),
                    pa.array(np.full(rows * k, error)),
                ]
                yield pa.RecordBatch.from_arrays(arrays, ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return run


def whiten(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained and identity_error of every usable
    vector and component."""
    spark = vectors.sparkSession
    fit = fit_list(vectors, id_col, vector_col)
    values, directions = fit_components(fit, components) if fit is not None else (np.zeros(0), None)
    if not len(values):
        return spark.createDataFrame([], _OUT)
    shared, k = tuple(fit[1:5]), len(values)
    turn = np.ascontiguousarray(directions / np.sqrt(values))
    covariance = _summed(fit, _gram(shared, spark.sparkContext.broadcast(turn)), (k, k)) / fit.n
    error = float(np.abs(covariance - np.eye(k)).max())
    model = spark.sparkContext.broadcast((turn, values / fit.trace, error))
    return fit.blocks.mapInArrow(_whiten(shared, model), _OUT)
