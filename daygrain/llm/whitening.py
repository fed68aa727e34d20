"""Whitening of embeddings: pivoted Cholesky of the centred scatter, then one-sided Jacobi.

Two passes over the vectors give their sums and their scatter about the mean. The scatter is factored
by Cholesky with pivoting, and the columns of the triangular factor are made orthogonal by plane
rotations. The squared norms of the rotated columns are the eigenvalues of the covariance, and the
columns themselves, brought to length 1, are its eigenvectors: no product of matrices is ever formed
from the factor, so small eigenvalues keep their leading digits.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daygrain.llm.tables import written

#: Numbers of a batch handled at once.
AT_ONCE = 1 << 20
#: Whole numbers are exact as doubles up to this size; vectors beyond it count as not finite.
EXACT = 1 << 53


def pivoted_cholesky(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``factor, order`` with ``matrix[order][:, order] = factor @ factor.T``; rank as many columns.

    The largest diagonal entry that is left is the next pivot; what is left below the rounding of the
    first one counts as 0.
    """
    size = len(matrix)
    order, factor = np.arange(size), np.zeros((size, size))
    left = np.diag(matrix).astype(float).copy()
    least = size * np.finfo(float).eps * max(left.max(initial=0.0), 0.0)
    for k in range(size):
        pivot = k + int(np.argmax(left[k:]))
        if not left[pivot] > least:
            return factor[:, :k], order
        for a in (order, factor, left):
            a[[k, pivot]] = a[[pivot, k]]
        factor[k, k] = np.sqrt(left[k])
        rest = matrix[order[k + 1 :], order[k]] - factor[k + 1 :, :k] @ factor[k, :k]
        factor[k + 1 :, k] = rest / factor[k, k]
        left[k + 1 :] -= factor[k + 1 :, k] ** 2
    return factor, order


def one_sided_jacobi(factor: np.ndarray, sweeps: int = 60) -> np.ndarray:
    """The columns of ``factor``, rotated pair by pair until all are orthogonal.

    The pairs of a round share no column, as in a tournament, so a round is a few array operations.
    """
    columns = factor.copy()
    width = columns.shape[1]
    near = 4 * np.finfo(float).eps * np.sqrt(max(1, len(columns)))
    players = list(range(width + width % 2))
    for _ in range(sweeps):
        moved = False
        for _ in range(len(players) - 1):
            half = len(players) // 2
            pairs = [p for p in zip(players[:half], players[:half - 1:-1], strict=True) if max(p) < width]
            i, j = (np.array(side) for side in zip(*pairs, strict=True)) if pairs else ([], [])
            a, b = columns[:, i], columns[:, j]
            aa, bb, ab = ((x * y).sum(axis=0) for x, y in ((a, a), (b, b), (a, b)))
            apart = np.abs(ab) > near * np.sqrt(aa * bb)
            if apart.any():
                moved = True
                ratio = np.where(apart, (bb - aa) / np.where(apart, 2 * ab, 1.0), 0.0)
                turn = np.where(ratio < 0, -1.0, 1.0) / (np.abs(ratio) + np.hypot(1.0, ratio))
                turn = np.where(apart, turn, 0.0)
                cosine = 1 / np.hypot(1.0, turn)
                sine = cosine * turn
                columns[:, i], columns[:, j] = cosine * a - sine * b, sine * a + cosine * b
            players = [players[0], players[-1], *players[1:-1]]
        if not moved:
            break
    return columns


def eigen(covariance: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues above 0, falling, and unit eigenvectors as rows; the largest entry of each is positive."""
    factor, order = pivoted_cholesky(covariance)
    columns = one_sided_jacobi(factor)
    norms = np.sqrt((columns * columns).sum(axis=0))
    found = np.argsort(-norms, kind="stable")
    values = norms[found] ** 2
    vectors = np.zeros((len(found), len(covariance)))
    vectors[:, order] = (columns[:, found] / norms[found]).T
    largest = np.abs(vectors).argmax(axis=1) if len(vectors) else np.zeros(0, int)
    signs = np.sign(vectors[np.arange(len(vectors)), largest])
    return values, vectors * signs[:, None]


@dataclass(frozen=True)
class Whitening:
    """What the fit list gives: counts and sums of whole numbers, eigenvalues and components as rows."""

    n: int
    sums: tuple[int, ...]
    values: np.ndarray
    components: np.ndarray
    trace: float
    scale: int
    offset: int

    @property
    def centre(self) -> tuple[np.ndarray, np.ndarray]:
        """The mean as whole numbers and what is left of it, so that a difference from it is exact first."""
        whole = [s // self.n for s in self.sums]
        rest = [(s - self.n * w) / self.n for s, w in zip(self.sums, whole, strict=True)]
        return np.array(whole, np.int64), np.array(rest)


def whole_numbers(column: pa.ListArray, size: int, scale: int, offset: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows of usable vectors of ``size`` entries, and ``floor(scale * entry) + offset`` of each entry."""
    rows = np.flatnonzero(pc.fill_null(pc.equal(pc.list_value_length(column), size), False).to_numpy(zero_copy_only=False))
    step = max(1, AT_ONCE // max(1, size))
    for first in range(0, len(rows), step):
        at = rows[first : first + step]
        entries = column.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False).reshape(len(at), size)
        with np.errstate(invalid="ignore", over="ignore"):
            entries = np.floor(scale * entries.astype(float))
        fine = (np.abs(entries) < EXACT).all(axis=1)  # a null has become NaN, which is no number below
        yield at[fine], entries[fine].astype(np.int64) + offset


def _exact_sum(x: np.ndarray) -> np.ndarray:
    """Sums of columns as Python numbers."""
    if len(x) and int(np.abs(x).max()) * len(x) >= 1 << 62:
        x = x.astype(object)
    return x.sum(axis=0).astype(object)


def _sums(scale: int, offset: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        for batch in batches:
            column = batch.column(0)
            for size in pc.unique(pc.list_value_length(column)).to_pylist():
                if not size:  # null or without entries
                    continue
                for rows, x in whole_numbers(column, size, scale, offset):
                    before = held.setdefault(size, [0, np.zeros(size, object)])
                    before[0] += len(rows)
                    before[1] = before[1] + _exact_sum(x)
        for size, (n, sums) in held.items():
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([size] * size, pa.int32()),
                    pa.array(range(size), pa.int32()),
                    pa.array([n] * size, pa.int64()),
                    pa.array([Decimal(int(s)) for s in sums], pa.decimal128(38, 0)),
                ],
                ["size", "i", "n", "total"],
            )

    return run


def scatter(rows: DataFrame, centred: Callable[[pa.Array], Iterator[np.ndarray]], size: int) -> np.ndarray:
    """Sum of the outer products of centred vectors.

    Each task adds up its own and gives ``size`` rows; these are added by a grouping over row and
    column, so the driver gets one matrix however many tasks there are.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size))
        for batch in batches:
            for x in centred(batch.column(0)):
                total += x.T @ x
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(size), pa.int32()), pa.array(list(total), pa.list_(pa.float64()))], ["i", "values"]
        )

    parts = rows.mapInArrow(run, "i int, values array<double>").select("i", F.posexplode("values").alias("j", "value"))
    found = np.zeros((size, size))
    for i, j, value in parts.groupBy("i", "j").agg(F.sum("value")).collect():
        found[i, j] = value
    return (found + found.T) / 2


def fit_whitening(vectors: DataFrame, vector_col: str = "embedding", scale: int = 1024, offset: int = 100_000) -> Whitening | None:
    """Eigenvalues and components of the covariance (divisor n) of all usable vectors; None without any.

    An entry c counts as the whole number ``floor(scale * c) + offset``. The driver gets two numbers
    for each dimension and one matrix of dimension x dimension, never rows.
    """
    column = vectors.select(F.col(vector_col).cast("array<double>").alias("vector"))
    parts = column.mapInArrow(_sums(scale, offset), "size int, i int, n long, total decimal(38,0)")
    sums = written(parts.groupBy("size", "i").agg(F.sum("n").alias("n"), F.sum("total").cast("decimal(38,0)").alias("total")), "sums")
    most = sums.filter("i = 0").orderBy(F.desc("n"), F.desc("size")).first()
    if most is None or not most.n:
        return None
    totals = {r.i: int(r.total) for r in sums.filter(F.col("size") == most.size).collect()}
    size = most.size
    model = Whitening(
        most.n, tuple(totals[i] for i in range(size)), np.zeros(0), np.zeros((0, size)), 0.0, scale, offset
    )
    whole, rest = model.centre

    def centred(column: pa.Array) -> Iterator[np.ndarray]:
        for _, x in whole_numbers(column, size, scale, offset):
            yield (x - whole) - rest

    covariance = scatter(column, centred, size) / most.n
    values, components = eigen(covariance)
    return Whitening(most.n, model.sums, values, components, float(np.trace(covariance)), scale, offset)


def _deviations(x: np.ndarray, whole: np.ndarray, n: int, left: list[int]) -> list[int | None]:
    """Sum of ``(n * x - S) ** 2`` over the entries of each row, exact; None where it is no 64-bit number."""
    x = x - whole
    reach = n * int(np.abs(x).max(initial=0)) + max(map(abs, left), default=0)
    exact = np.int64 if reach * reach * x.shape[1] < 1 << 63 else object
    found = ((n * x.astype(exact) - np.array(left, exact)) ** 2).sum(axis=1)
    return [int(v) if v < 1 << 63 else None for v in found]


def whiten(
    vectors: DataFrame, model: Whitening, components: int = 8, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """``vec_id, deviation, whitened``: each usable row, with its projections on the first components."""
    kind = dict(vectors.dtypes)[id_col]
    whole, rest = model.centre
    left = [s - model.n * int(w) for s, w in zip(model.sums, whole, strict=True)]
    basis = (model.components[:components] / np.sqrt(model.values[:components])[:, None]).T

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, x in whole_numbers(batch.column(1), len(whole), model.scale, model.offset):
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(rows)),
                        pa.array(_deviations(x, whole, model.n, left), pa.int64()),
                        pa.array(list(((x - whole) - rest) @ basis), pa.list_(pa.float64())),
                    ],
                    ["vec_id", "deviation", "whitened"],
                )

    taken = vectors.select(F.col(id_col).alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector"))
    return taken.mapInArrow(run, f"vec_id {kind}, deviation long, whitened array<double>")


def identity_error(white: DataFrame, size: int) -> float:
    """Largest entry of the covariance of ``whitened`` minus the identity: means first, then the scatter."""
    entries = [F.avg(F.element_at("whitened", k + 1)) for k in range(size)]
    n, *means = white.agg(F.count("*"), *entries).first()
    means = np.array(means)

    def centred(column: pa.Array) -> Iterator[np.ndarray]:
        yield column.flatten().to_numpy(zero_copy_only=False).reshape(-1, size) - means

    covariance = scatter(white.select("whitened"), centred, size) / n
    return float(np.abs(covariance - np.eye(size)).max())


def whitened_components(
    vectors: DataFrame,
    components: int = 8,
    scale: int = 1024,
    offset: int = 100_000,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error``: a row for each usable
    row and component.

    The fit list is all usable rows, copies included. Components are the unit eigenvectors of the
    covariance by falling eigenvalue, at most ``components``, the same for all rows; ``whitened`` is
    the projection over the root of the eigenvalue, ``explained`` the eigenvalue's share of the trace,
    ``deviation`` the exact sum of ``(n * x - S) ** 2``, and ``identity_error`` one value for the
    table, measured on the written result.

    Rows are read twice to fit and once to project; only sums and matrices of the dimension are
    shuffled, so no id, label or copy is a hot key, and the driver holds a matrix of the dimension.

    A null vector, one without entries, and one with a null or non-finite entry or one beyond 2**53 are
    dropped, as are vectors of another length than most have (of equally many, than the longest). A
    null id is an id like others; rows with the same id each get their rows. Equal eigenvalues share
    a plane, of which the rotations choose the axes. Directions without variance have no component, so
    a table whose vectors are all equal, or empty, gives no rows. A deviation beyond 64 bits is null.
    Other columns are ignored, whatever their names; there is no text.
    """
    kind = dict(vectors.dtypes)[id_col]
    model = fit_whitening(vectors, vector_col, scale, offset)
    size = 0 if model is None else min(components, len(model.values))
    if not size:
        return vectors.sparkSession.createDataFrame(
            [], f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
        )
    white = written(whiten(vectors, model, components, id_col, vector_col), "whitened")
    error = identity_error(white, size)
    explained = F.array(*[F.lit(float(v / model.trace)) for v in model.values[:size]])
    each = white.select("vec_id", "deviation", F.posexplode("whitened").alias("place", "whitened"))
    return each.select(
        "vec_id",
        (F.col("place") + 1).alias("component"),
        F.lit(model.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.element_at(explained, F.col("place") + 1).alias("explained"),
        F.lit(error).alias("identity_error"),
    )
