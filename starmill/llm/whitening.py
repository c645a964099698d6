"""Whitening of embeddings by principal components, found by QDWH spectral divide-and-conquer.

Vectors are put on a grid of 1/256, x = floor(256 * c). Each distinct vector counts once: the fit list is
written to the shared folder, where three narrow passes read it (sums, covariance, check of the result).
Every pass reduces a task's rows to a matrix of the vectors' dimensions before anything is shuffled, so
a vector that fills a third of the table is one row of the list and one combined row a task before.

The covariance is split by spectral projectors: the polar factor U of V - s I, found by the dynamically
weighted Halley iteration (QDWH), has eigenvalue 1 above the shift s and -1 below it, so (U + I) / 2 projects on
the span of all eigenvectors above s. An orthonormal basis of that span and of its complement turns the
matrix into two smaller ones, which are split in turn, largest eigenvalues first, until subspaces of
one dimension are the components. They are broadcast with the functions of the last pass: their size is the
number of dimensions times the number of components, whatever the table's size.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmill.llm.text import Scratch

GRID = 256
#: Entries beyond it count as not finite: sums over a batch then stay exact in 64 bits.
LARGEST = float(1 << 40)
EPS = float(np.finfo(float).eps)
#: Where shifts are tried, in parts of the spread around the mean eigenvalue.
SHIFTS = (0.0, 0.13, -0.13, 0.37, -0.37, 0.71, -0.71)


@dataclass(frozen=True)
class Whitening:
    """What a fit list of ``n`` vectors gives; ``sums`` are exact, ``vectors`` are columns."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    @property
    def dims(self) -> int:
        return len(self.sums)

    def known(self) -> np.ndarray:
        """Which components have a variance that rounding cannot explain."""
        return self.values > self.dims * EPS * max(float(self.trace), 0.0)

    def scales(self) -> np.ndarray:
        """What projections are multiplied by; not a number where a component has no variance."""
        with np.errstate(invalid="ignore", divide="ignore"):
            return np.where(self.known(), 1 / np.sqrt(np.maximum(self.values, 0)), np.nan)


def halley_weights(low: float) -> tuple[float, float, float]:
    """The weights a, b, c of the best step for singular values in [low, 1]."""
    square = low * low
    d = np.cbrt(4 * (1 - square) / square**2)
    a = np.sqrt(1 + d) + 0.5 * np.sqrt(8 - 4 * d + 8 * (2 - square) / (square * np.sqrt(1 + d)))
    b = (a - 1) ** 2 / 4
    return float(a), float(b), float(a + b - 1)


def polar_factor(matrix: np.ndarray) -> np.ndarray:
    """The symmetric polar factor U of a symmetric matrix U H, by QDWH; H has no negative eigenvalue."""
    size = len(matrix)
    largest = np.linalg.norm(matrix)
    x = matrix / largest
    try:
        low = 1 / max(1.0, float(np.linalg.norm(np.linalg.inv(x))))
    except np.linalg.LinAlgError:
        low = EPS
    low = min(max(low, EPS), 1.0)
    one = np.eye(size)
    for _ in range(50):
        a, b, c = halley_weights(low) if low < 1 else (3.0, 1.0, 3.0)
        if c > 100:
            q, _ = np.linalg.qr(np.vstack([np.sqrt(c) * x, one]))
            after = b / c * x + (a - b / c) / np.sqrt(c) * q[:size] @ q[size:].T
        else:
            after = b / c * x + (a - b / c) * np.linalg.solve(one + c * x.T @ x, x.T).T
        after = (after + after.T) / 2
        change = np.linalg.norm(after - x)
        x, low = after, min(low * (a + b * low * low) / (1 + c * low * low), 1.0)
        # Steps converge cubically: after one this small, x is exact but for rounding.
        if change <= EPS ** (1 / 3) * np.sqrt(size) and 1 - low <= 10 * EPS:
            break
    return x


def split_subspaces(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
    """Orthonormal bases of two invariant subspaces, that of the larger eigenvalues first.

    None if rounding cannot tell the eigenvalues apart.
    """
    size = len(matrix)
    mean = np.trace(matrix) / size
    spread = np.linalg.norm(matrix - mean * np.eye(size)) / np.sqrt(size)
    start = np.random.default_rng(size).standard_normal((size, size))
    for part in SHIFTS:
        projector = (polar_factor(matrix - (mean + part * spread) * np.eye(size)) + np.eye(size)) / 2
        rank = int(round(np.trace(projector)))
        # A shift that meets an eigenvalue leaves a part that is neither above nor below.
        if not 0 < rank < size or np.linalg.norm(projector @ projector - projector) > 1e-10 * size:
            continue
        upper = np.linalg.qr(projector @ start[:, :rank])[0]
        upper = np.linalg.qr(projector @ upper)[0]
        lower = np.linalg.qr(upper, mode="complete")[0][:, rank:]
        lower = lower - projector @ lower
        lower = np.linalg.qr(lower - upper @ (upper.T @ lower))[0]
        return upper, lower
    return None


def leading_components(matrix: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues of a symmetric matrix, falling, and unit eigenvectors as columns."""
    size = len(matrix)
    floor = size * EPS * np.linalg.norm(matrix)
    found: list[np.ndarray] = []
    # The subspaces still to be split, the one of the largest eigenvalues last.
    open_bases = [np.eye(size)]
    while open_bases and len(found) < wanted:
        basis = open_bases.pop()
        inner = basis.T @ matrix @ basis
        inner = (inner + inner.T) / 2
        width = len(inner)
        mean = np.trace(inner) / width
        level = width == 1 or np.linalg.norm(inner - mean * np.eye(width)) <= floor
        parts = None if level else split_subspaces(inner)
        if parts is None:
            found.extend(basis.T)
        else:
            upper, lower = parts
            open_bases += [basis @ lower, basis @ upper]
    vectors = np.array(found).reshape(-1, size).T
    values = np.einsum("ij,ij->j", vectors, matrix @ vectors)
    order = np.argsort(-values, kind="stable")[:wanted]
    return values[order], vectors[:, order]


def grid_vector(vector: Column) -> Column:
    """x = floor(256 * c) of every entry, as long; null for a vector with null or non-finite entries.

    Entries of 2^40 or more count as non-finite.
    """
    entries = vector.cast("array<double>")
    finite = F.forall(
        entries, lambda c: F.coalesce((F.abs(c) < LARGEST) & ~F.isnan(c), F.lit(False))
    )
    on_grid = F.transform(entries, lambda c: F.floor(c * GRID).cast("long"))
    return F.when(vector.isNotNull() & finite & (F.size(vector) > 0), on_grid)


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    """The vectors of a batch as rows."""
    column = batch.column("x")
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _by_dimension(rows: list, kind: pa.DataType) -> pa.RecordBatch:
    """One row for each dimension: its number and what was added up for it."""
    return pa.RecordBatch.from_arrays([pa.array(range(len(rows)), pa.int32()), pa.array(rows, kind)], ["i", "part"])


def _sums(fit: DataFrame) -> list[int]:
    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: list[int] = []
        for batch in batches:
            if batch.num_rows:
                sums = _matrix(batch).sum(axis=0).tolist()
                total = [a + b for a, b in zip(total, sums)] if total else sums
        if total:
            yield _by_dimension([str(s) for s in total], pa.string())

    parts = fit.mapInArrow(partial, "i int, part string")
    exact = parts.groupBy("i").agg(F.sum(F.col("part").cast("decimal(38,0)")).alias("s"))
    # One row for each dimension.
    return [int(r.s) for r in sorted(exact.collect(), key=lambda r: r.i)]


def _centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """x - S/n of every row: exact differences n*x - S, divided once."""
    most = max(float(np.abs(x).max(initial=0)) * n, *(abs(float(s)) for s in sums))
    if most < 2.0**61:
        return (x * n - np.array(sums, dtype=np.int64)) / n
    return ((x.astype(object) * n - np.array(sums, dtype=object)) / n).astype(float)


def _products(rows: DataFrame, dims: int, made: object) -> np.ndarray:
    """The sum of the outer products of the rows that ``made`` derives from a matrix of vectors."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dims, dims))
        for batch in batches:
            if batch.num_rows:
                y = made(_matrix(batch))
                total += y.T @ y
        yield _by_dimension(total.tolist(), pa.list_(pa.float64()))

    def added(table: pa.Table) -> pa.Table:
        parts = table.column("part").combine_chunks().flatten().to_numpy(zero_copy_only=False)
        total = parts.reshape(table.num_rows, dims).sum(axis=0)
        return pa.table(
            {"i": pa.array(table.column("i").to_pylist()[:1], pa.int32()), "part": pa.array([total.tolist()])}
        )

    parts = rows.mapInArrow(partial, "i int, part array<double>")
    # One row of a task for each dimension; the result has as many rows as the matrix.
    summed = parts.groupBy("i").applyInArrow(added, "i int, part array<double>").collect()
    total = np.zeros((dims, dims))
    for row in summed:
        total[row.i] = row.part
    return total


def fitted(fit: DataFrame, components: int) -> Whitening | None:
    """The whitening of a stored list of distinct vectors ``x`` of one length; None for an empty one."""
    n = fit.count()
    if not n:
        return None
    sums = _sums(fit)
    dims = len(sums)
    covariance = _products(fit, dims, lambda x: _centred(x, n, sums)) / n
    covariance = (covariance + covariance.T) / 2
    values, vectors = leading_components(covariance, min(components, dims))
    return Whitening(n, sums, values, vectors, float(np.trace(covariance)))


def _projected(x: np.ndarray, model: Whitening) -> np.ndarray:
    return _centred(x, model.n, model.sums) @ (model.vectors * model.scales())


def identity_error(fit: DataFrame, model: Whitening) -> float | None:
    """The largest absolute entry of the whitened list's covariance minus the identity.

    Components without variance are left out; None if none has any.
    """
    known = model.known()
    if not known.any():
        return None
    size = int(known.sum())
    covariance = _products(fit, size, lambda x: _projected(x, model)[:, known]) / model.n
    return float(np.abs(covariance - np.eye(size)).max())


def _deviations(x: np.ndarray, model: Whitening) -> list[int | None]:
    """Sum over dimensions of (n*x - S)^2, exactly; None where that is no long."""
    most = max(float(np.abs(x).max(initial=0)) * model.n, *(abs(float(s)) for s in model.sums))
    kind = np.int64 if 4 * most * most * model.dims < 2.0**62 else object
    off = x.astype(kind) * model.n - np.array(model.sums, dtype=kind)
    squares = (off * off).sum(axis=1).tolist()
    return [s if s < 1 << 63 else None for s in squares]


def whitened(
    vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", components: int = 4
) -> DataFrame:
    """For each usable row and each of the first ``components``: its id, component (from 1), n, deviation,
    whitened, explained and identity_error; other columns are not read.

    Rows whose vector is null, empty, or holds null or non-finite entries are left out, and so are rows of
    another length than most rows have (of equally frequent lengths the larger one counts). Repeated rows and
    null ids stay, each with its own result rows, but count once in the fit. Vectors of fewer dimensions
    have fewer components. A component without variance (one distinct vector, dimensions that depend on each
    other) has null for whitened; explained is null where there is no variance at all, identity_error
    where no component has any. ``deviation`` is null where it is more than a long holds. An empty table, or one
    without usable rows, gives an empty result.
    """
    spark = vectors.sparkSession
    scratch = Scratch(spark, "whitening")
    names = ["component", "n", "deviation", "whitened", "explained", "identity_error"]
    id_type = vectors.schema[id_column].dataType.simpleString()
    shape = (
        f"key {id_type}, component int, n bigint, deviation bigint, whitened double, "
        "explained double, identity_error double"
    )
    rows = vectors.select(
        F.col(f"`{id_column}`").alias("key"), grid_vector(F.col(f"`{vector_column}`")).alias("x")
    ).where("x IS NOT NULL")
    lengths = rows.groupBy(F.size("x").alias("dims")).agg(F.count("*").alias("rows"))
    most = lengths.orderBy(F.desc("rows"), F.desc("dims")).first()
    if most is None:
        return spark.createDataFrame([], shape).withColumnRenamed("key", id_column)
    rows = rows.where(F.size("x") == most.dims)
    fit = scratch.keep(rows.select("x").distinct())
    model = fitted(fit, components)
    error = identity_error(fit, model)
    size = len(model.values)
    shares = [float(v) / model.trace if model.trace > 0 else None for v in model.values]

    def projected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch) if batch.num_rows else np.zeros((0, model.dims), dtype=np.int64)
            m = len(x)
            found = _projected(x, model).reshape(-1)
            off = _deviations(x, model)
            keys = batch.column("key").take(pa.array(np.repeat(np.arange(m), size)))
            yield pa.RecordBatch.from_arrays(
                [
                    keys,
                    pa.array(np.tile(np.arange(1, size + 1, dtype=np.int32), m)),
                    pa.array(np.full(m * size, model.n)),
                    pa.array([d for d in off for _ in range(size)], pa.int64()),
                    pa.array(found, mask=np.isnan(found)),
                    pa.array(shares * m, pa.float64()),
                    pa.array([error] * (m * size), pa.float64()),
                ],
                ["key", *names],
            )

    return rows.mapInArrow(projected, shape).withColumnRenamed("key", id_column)
