"""Whitening of embeddings by shifted CholeskyQR.

The rows, centred, are a tall matrix ``A``.  A pass over them sums ``QᵀQ``
task by task, where ``Q`` is ``A`` after the triangular solves with all factors
found so far; the small matrix is factorised on the driver and its factor joins
the others.  The first factorisation is shifted, so that it works for any
condition of ``A``; later passes bring ``Q`` to orthonormal columns.  With
``A = Q R``, ``R`` the product of the factors, the singular value decomposition
of the small ``R`` has the components of ``A``, to the precision of the rows
and not of their squares.  Only matrices of ``d`` by ``d`` numbers, ``d`` being
the length of a vector, go to the driver and to all tasks.

Entries are scaled, floored and moved by an offset, and stay whole numbers
until they are centred: ``n * x - S`` is exact, with sums ``S`` that are exact
at any size.

Vectors that are null, empty, or hold a null or non-finite entry, take no part;
nor do entries beyond 2 ** 40 after scaling.  Where lengths differ, the most
frequent one counts (of equally frequent ones the longest) and other vectors
take no part.  Rows that repeat count each; a null ``vec_id`` stays null.
Directions in which the rows do not differ (no more than ``1e-10`` of the
first one's deviation) are no components, so constant or few rows have fewer,
and no rows have none and give no rows.  Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import stored

_LARGEST = float(1 << 40)
_PORTION = 2048
_EXACT = 1 << 62
_ROUND = np.finfo(np.float64).eps / 2
_FLAT = 1e-10  # of the largest singular value


def scaled(vectors: DataFrame, column: str = "embedding", scale: int = 64, offset: int = 1_000_000) -> DataFrame:
    """``vec_id`` and ``x``: whole numbers, stored; only usable rows of the usual length."""
    entries = F.col(column)
    grown = lambda c: c.cast("double") * F.lit(float(scale))
    fine = F.forall(entries, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(grown(c)) < F.lit(_LARGEST)))
    whole = F.transform(entries, lambda c: F.floor(grown(c)).cast("long") + F.lit(offset).cast("long"))
    rows = vectors.where(entries.isNotNull() & (F.size(entries) > 0) & fine)
    rows = stored(rows.select(F.col("vec_id").cast("long").alias("vec_id"), whole.alias("x")))
    usual = rows.groupBy(F.size("x").alias("d")).count().agg(F.max(F.struct("count", "d"))["d"]).first()[0]
    return rows.where(F.size("x") == F.lit(usual or 0))


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    """The vectors of a batch; never called without rows."""
    column = batch.column(batch.schema.get_field_index("x"))
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _totals(rows: DataFrame) -> tuple[int, list[int]]:
    """How many rows there are and the exact sum of each dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = None, 0
        for batch in batches:
            if batch.num_rows:
                own = _matrix(batch).sum(axis=0).astype(object)  # of Python's whole numbers
                total, n = own if total is None else total + own, n + batch.num_rows
        if total is not None:
            sums = [Decimal(int(x)) for x in (n, *total)]
            columns = [pa.array(range(-1, len(total)), pa.int32()), pa.array(sums, pa.decimal128(38, 0))]
            yield pa.RecordBatch.from_arrays(columns, ["dim", "total"])

    found = rows.select("x").mapInArrow(run, "dim int, total decimal(38,0)").groupBy("dim").agg(F.sum("total").alias("total"))
    by = {r["dim"]: int(r["total"]) for r in found.collect()}
    return by.pop(-1, 0), [by[i] for i in sorted(by)]


def differences(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """``n * x - sums``, exact: 64-bit where that holds them, else Python's whole numbers."""
    middle = np.array([s // n for s in sums], np.int64)
    rest = [s - n * int(m) for s, m in zip(sums, middle, strict=True)]  # 0 to n - 1
    near = x - middle
    if n * (int(np.abs(near).max(initial=0)) + 1) < _EXACT:
        return n * near - np.array(rest, np.int64)
    return n * near.astype(object) - np.array(rest, object)


def centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    return differences(x, n, sums).astype(np.float64) / n


def solved(rows: np.ndarray, factor: np.ndarray) -> np.ndarray:
    """``rows`` times the inverse of an upper triangular factor, by substitution."""
    out = rows.copy()
    for j in range(factor.shape[0]):
        if j:
            out[:, j] -= out[:, :j] @ factor[:j, j]
        out[:, j] /= factor[j, j]
    return out


def _gram(rows: DataFrame, n: int, sums: list[int], factors: list[np.ndarray]) -> np.ndarray:
    """``QᵀQ`` over all rows, after the solves with these factors."""
    d = len(sums)
    shared = rows.sparkSession.sparkContext.broadcast((n, sums, factors))
    upper = np.triu_indices(d)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, factors = shared.value
        total = None
        for batch in batches:
            if batch.num_rows:
                q = centred(_matrix(batch), n, sums)
                for factor in factors:
                    q = solved(q, factor)
                total = q.T @ q if total is None else total + q.T @ q
        if total is not None:
            cells = pa.array(np.arange(len(upper[0]), dtype=np.int32))
            yield pa.RecordBatch.from_arrays([cells, pa.array(total[upper])], ["cell", "value"])

    found = rows.select("x").mapInArrow(run, "cell int, value double").groupBy("cell").agg(F.sum("value").alias("value")).toArrow()
    out = np.zeros((d, d))
    cells = found.column("cell").to_numpy()
    out[upper[0][cells], upper[1][cells]] = found.column("value").to_numpy()
    return out + np.triu(out, 1).T


def _factor(gram: np.ndarray, n: int, shifted: bool) -> np.ndarray:
    """Upper triangular ``R`` with ``RᵀR`` the matrix, shifted if asked or if it must be."""
    d = len(gram)
    if not shifted:
        try:
            return np.linalg.cholesky(gram).T
        except np.linalg.LinAlgError:
            pass
    shift = max(11 * (n * d + d * (d + 1)) * _ROUND, 1e-12) * np.linalg.norm(gram, 2)
    return np.linalg.cholesky(gram + shift * np.eye(d)).T


@dataclass
class Whitening:
    """What was fitted: sizes grow with the length of a vector only."""

    n: int
    sums: list[int]
    components: np.ndarray  # a unit vector in each row
    eigenvalues: np.ndarray
    trace: float

    @property
    def explained(self) -> list[float]:
        return [float(e / self.trace) for e in self.eigenvalues]

    def whiten(self, rows: np.ndarray) -> np.ndarray:
        """Centred rows, projected and scaled to variance 1."""
        return rows @ (self.components / np.sqrt(self.eigenvalues)[:, None]).T


def fit(rows: DataFrame, components: int = 32, most_passes: int = 8) -> Whitening:
    """The first components of all rows; each pass reads the stored rows once."""
    n, sums = _totals(rows)
    nothing = Whitening(n, sums, np.zeros((0, len(sums))), np.zeros(0), 0.0)
    if not n:
        return nothing
    factors: list[np.ndarray] = []
    for turn in range(most_passes):
        gram = _gram(rows, n, sums, factors)
        if not gram.any():
            return nothing
        factors.append(_factor(gram, n, shifted=not turn))
        spread = np.linalg.eigvalsh(gram)
        # Orthonormal but for this last factor; directions without any deviation stay at 0.
        if turn and np.all((np.abs(spread - 1) < 1e-7) | (spread < 1e-12)):
            break
    whole = factors[0]
    for factor in factors[1:]:
        whole = factor @ whole
    _, deviations, directions = np.linalg.svd(whole)
    keep = int((deviations > _FLAT * deviations[0]).sum())
    eigenvalues = deviations**2 / n
    first = min(components, keep)
    return Whitening(n, sums, directions[:first], eigenvalues[:first], float(eigenvalues[:keep].sum()))


def identity_error(rows: DataFrame, fitted: Whitening) -> float:
    """Largest absolute entry of the whitened rows' covariance less the identity."""
    k = len(fitted.eigenvalues)
    if not k:
        return 0.0
    shared = rows.sparkSession.sparkContext.broadcast(fitted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted, total = shared.value, None
        for batch in batches:
            if batch.num_rows:
                w = fitted.whiten(centred(_matrix(batch), fitted.n, fitted.sums))
                own = np.vstack([w.sum(axis=0), w.T @ w]).ravel()
                total = own if total is None else total + own
        if total is not None:
            cells = pa.array(np.arange(len(total), dtype=np.int32))
            yield pa.RecordBatch.from_arrays([cells, pa.array(total)], ["cell", "value"])

    found = rows.select("x").mapInArrow(run, "cell int, value double").groupBy("cell").agg(F.sum("value").alias("value")).toArrow()
    out = np.zeros((k + 1) * k)
    out[found.column("cell").to_numpy()] = found.column("value").to_numpy()
    out = out.reshape(k + 1, k) / fitted.n
    # The rows are centred before; what rounding leaves of their mean goes too.
    return float(np.abs(out[1:] - np.outer(out[0], out[0]) - np.eye(k)).max())


def whitened(rows: DataFrame, fitted: Whitening) -> DataFrame:
    """``vec_id``, ``deviation`` (the exact sum of ``(n * x - S) ** 2``, null
    beyond a long) and ``whitened``, an entry for each component."""
    shared = rows.sparkSession.sparkContext.broadcast(fitted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = shared.value
        for batch in batches:
            for start in range(0, batch.num_rows, _PORTION):
                some = batch.slice(start, _PORTION)
                apart = differences(_matrix(some), fitted.n, fitted.sums)
                if apart.dtype != object and int(np.abs(apart).max()) ** 2 * apart.shape[1] < _EXACT:
                    squares = pa.array((apart**2).sum(axis=1))
                else:
                    exact = (apart.astype(object) ** 2).sum(axis=1)
                    squares = pa.array([int(x) if x < 1 << 63 else None for x in exact], pa.int64())
                w = fitted.whiten(apart.astype(np.float64) / fitted.n)
                offsets = pa.array(np.arange(len(w) + 1, dtype=np.int32) * w.shape[1])
                lists = pa.ListArray.from_arrays(offsets, pa.array(w.ravel()))
                yield pa.RecordBatch.from_arrays([some.column(0), squares, lists], ["vec_id", "deviation", "whitened"])

    return rows.select("vec_id", "x").mapInArrow(run, "vec_id long, deviation long, whitened array<double>")
