"""Whitening of vectors by spectral divide and conquer.

Sums and products over the vectors are made by tasks, whose parts a small aggregate adds up; only
the square matrix of the covariance, as wide as a vector, comes to the driver. There it is split:
the polar decomposition of the matrix, shifted by a number between its eigenvalues, is the sign of
it, and gives the projectors on what lies above and below the shift. Each half is a smaller matrix
in its own subspace and is split the same way, down to single components. The polar decompositions
are made by dynamically weighted Halley steps on QR factorizations (QDWH), which converge in some
six steps whatever the condition and need no inverse.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

COMPONENTS = 8
#: Entries become whole numbers: floor(SCALE * entry) + OFFSET.
SCALE, OFFSET = 1024, 100_000
EPS = np.finfo(np.float64).eps
ROWS_AT_ONCE = 8192
#: A covariance of up to so many columns is split by the driver: 512 MB, more than any embedding is wide.
WIDEST = 8192


def polar_factor(matrix: np.ndarray) -> np.ndarray:
    """The orthogonal factor of a symmetric matrix's polar decomposition: its sign."""
    size = len(matrix)
    one = np.eye(size)
    x = matrix / max(np.abs(matrix).sum(axis=1).max(), np.finfo(np.float64).tiny)
    low = EPS  # a lower bound of the least singular value worth telling from zero
    for _ in range(20):
        root = np.cbrt(4 * (1 - low**2) / low**4) if low < 1 else 0.0
        a = np.sqrt(1 + root) + np.sqrt(8 - 4 * root + 8 * (2 - low**2) / (low**2 * np.sqrt(1 + root))) / 2
        b = (a - 1) ** 2 / 4
        c = a + b - 1
        q, _ = np.linalg.qr(np.vstack([np.sqrt(c) * x, one]))
        step = (b / c) * x + (a - b / c) / np.sqrt(c) * (q[:size] @ q[size:].T)
        step = (step + step.T) / 2
        moved, x = np.linalg.norm(step - x), step
        low = min(1.0, low * (a + b * low**2) / (1 + c * low**2))
        if moved < np.cbrt(EPS) and 1 - low < 10 * EPS:
            break
    return x


def _halves(matrix: np.ndarray, shift: float) -> tuple[np.ndarray, np.ndarray] | None:
    """Orthonormal bases of what lies above and below the shift, or None if it does not separate cleanly."""
    size = len(matrix)
    projector = (polar_factor(matrix - shift * np.eye(size)) + np.eye(size)) / 2
    above = int(round(np.trace(projector)))
    if not 0 < above < size:
        return None
    start = np.random.default_rng(size).standard_normal((size, above))
    basis = np.linalg.qr(projector @ start)[0]
    full = np.linalg.qr(projector @ basis, mode="complete")[0]
    upper, lower = full[:, :above], full[:, above:]
    if np.linalg.norm(lower.T @ matrix @ upper) > 32 * size * EPS * np.linalg.norm(matrix):
        return None
    return upper, lower


def components_of(matrix: np.ndarray, number: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``number`` largest eigenvalues of a symmetric matrix, falling, and their unit eigenvectors as columns.

    Of a split only the halves that hold wanted components are split further.
    """
    scale = np.linalg.norm(matrix)

    def split(block: np.ndarray, basis: np.ndarray, wanted: int) -> list[tuple[float, np.ndarray]]:
        size, diagonal = len(block), np.diag(block)
        mean = diagonal.mean()
        if size == 1 or np.linalg.norm(block - mean * np.eye(size)) <= size * EPS * scale:
            return [(diagonal[i], basis[:, i]) for i in np.argsort(-diagonal, kind="stable")[:wanted]]
        spread = np.linalg.norm(block - mean * np.eye(size)) / np.sqrt(size)
        for shift in (np.median(diagonal), mean, *(mean + spread * t for t in (0.1, -0.1, 0.3, -0.3, 0.03, -0.03, 0.7, -0.7))):
            halves = _halves(block, shift)
            if halves:
                break
        else:
            raise ArithmeticError("no shift separates the components")
        found = []
        for half in halves:
            if len(found) < wanted:
                inner = half.T @ block @ half
                found += split((inner + inner.T) / 2, basis @ half, wanted - len(found))
        return found

    found = split((matrix + matrix.T) / 2, np.eye(len(matrix)), min(number, len(matrix)))
    found.sort(key=lambda pair: -pair[0])
    return np.array([value for value, _ in found]), np.array([vector for _, vector in found]).reshape(len(found), -1).T


def whole(entries: np.ndarray) -> np.ndarray:
    """floor(SCALE * entry) + OFFSET; as Python's integers where 64 bits could be too few."""
    floors = np.floor(entries * SCALE)
    if np.abs(floors).max(initial=0) < 2.0**52:
        return floors.astype(np.int64) + OFFSET
    return np.array([int(v) for v in floors.ravel()], dtype=object).reshape(floors.shape) + OFFSET


def apart(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n * x - S, exactly."""
    if x.dtype != object and n * max(int(np.abs(x).max(initial=0)), 1) < 2**62 and max(map(abs, sums), default=0) < 2**62:
        return n * x - np.array(sums, dtype=np.int64)
    return n * x.astype(object) - np.array(sums, dtype=object)


def centred(away: np.ndarray, n: int) -> np.ndarray:
    """x - S / n in double precision, rounded once."""
    return (away / n).astype(np.float64)


def deviations(away: np.ndarray) -> list[int | None]:
    """The sum of squares per row, exactly; null where it does not fit a long."""
    if away.dtype != object and int(np.abs(away).max(initial=0)) ** 2 * max(away.shape[1], 1) < 2**63:
        return (away * away).sum(axis=1).tolist()
    squares = (away.astype(object) ** 2).sum(axis=1)
    return [s if s < 2**63 else None for s in map(int, squares)]


def _entries(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return (b.slice(at, ROWS_AT_ONCE) for b in batches for at in range(0, b.num_rows, ROWS_AT_ONCE))


def fit_list(vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding") -> tuple[DataFrame, int]:
    """``id, vector`` (doubles) of the rows that are whitened, and their width.

    Dropped are vectors that are null or hold null or non-finite entries, and those of another
    width than most of the others (of equally frequent widths the largest counts): they are no
    points of the same space.
    """
    rows = vectors.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{vector_column}`").cast("array<double>").alias("vector"))
    finite = F.forall("vector", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    good = rows.where(F.coalesce(finite, F.lit(False)))
    most = good.groupBy(F.size("vector").alias("width")).count().orderBy(F.desc("count"), F.desc("width")).first()
    width = most["width"] if most else 0
    return good.where(F.size("vector") == width), width


def _sums(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, np.zeros(width, dtype=object)
        for batch in _batches(batches):
            x = whole(_entries(batch.column(0), width))
            n += len(x)
            total += x.sum(axis=0).astype(object)
        if n:
            values = pa.array([str(int(v)) for v in (n, *total)])
            yield pa.RecordBatch.from_arrays([pa.array(range(-1, width), pa.int32()), values], names=["at", "value"])

    return run


def _products(of, width: int, size: int):
    """A task's sum of products of the columns that ``of`` makes of a batch: the upper triangle as ``i, j, value``."""
    i, j = np.triu_indices(size)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size))
        for batch in _batches(batches):
            made = of(_entries(batch.column(0), width))
            total += made.T @ made
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(total[i, j])], names=["i", "j", "value"])

    return run


def _second_moments(rows: DataFrame, of, width: int, size: int) -> np.ndarray:
    parts = rows.select("vector").mapInArrow(_products(of, width, size), "i int, j int, value double")
    table = parts.groupBy("i", "j").agg(F.sum("value").alias("value")).toPandas()
    matrix = np.zeros((size, size))
    matrix[table["i"], table["j"]] = table["value"]
    return matrix + np.triu(matrix, 1).T


@dataclass(frozen=True)
class Whitening:
    n: int
    sums: list[int]
    values: np.ndarray  # variances of the components, falling
    vectors: np.ndarray  # components as columns
    trace: float
    identity_error: float

    @property
    def projection(self) -> np.ndarray:
        return self.vectors / np.sqrt(self.values)


def fit(rows: DataFrame, width: int, number: int = COMPONENTS) -> Whitening | None:
    """Means, components and variances of all ``rows`` (from ``fit_list``); None without rows or without any variance.

    Components whose variance is nothing but rounding are left out: they can't be scaled to one.
    What comes to the driver depends on the width alone.
    """
    if width > WIDEST:
        raise ValueError(f"vectors of {width} entries; at most {WIDEST} are split by the driver")
    if not width:
        return None
    parts = rows.select("vector").mapInArrow(_sums(width), "at int, value string")
    added = parts.groupBy("at").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value")).collect()
    totals = {row["at"]: int(row["value"]) for row in added}
    n, sums = totals.get(-1, 0), [totals.get(i, 0) for i in range(width)]
    if not n:
        return None
    covariance = _second_moments(rows, lambda v: centred(apart(whole(v), n, sums), n), width, width) / n
    trace = float(np.trace(covariance))
    if not trace > 0:
        return None
    values, found = components_of(covariance, number)
    real = values > width * EPS * values[0]
    model = Whitening(n, sums, values[real], found[:, real], trace, 0.0)
    projection = model.projection
    moments = _second_moments(rows, lambda v: centred(apart(whole(v), n, sums), n) @ projection, width, projection.shape[1]) / n
    return Whitening(n, sums, model.values, model.vectors, trace, float(np.abs(moments - np.eye(len(moments))).max()))


WHITENED = "component int, n long, deviation long, whitened double, explained double, identity_error double"


def whitened(rows: DataFrame, width: int, model: Whitening | None) -> DataFrame:
    """A row per vector and component: ``id, component, n, deviation, whitened, explained, identity_error``.

    Null ids and repeated rows stay. Without a model there is nothing to return a row for.
    """
    schema = T.StructType([rows.schema["id"], *T._parse_datatype_string(WHITENED).fields])
    if model is None:
        return rows.sparkSession.createDataFrame([], schema)
    n, sums, projection, error = model.n, model.sums, model.projection, model.identity_error
    explained, number = model.values / model.trace, len(model.values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _batches(batches):
            away = apart(whole(_entries(batch.column(1), width)), n, sums)
            made, size = centred(away, n) @ projection, batch.num_rows
            each = np.repeat(np.arange(size), number)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(each)),
                    pa.array(np.tile(np.arange(1, number + 1, dtype=np.int32), size)),
                    pa.array(np.full(size * number, n)),
                    pa.array(deviations(away), pa.int64()).take(pa.array(each)),
                    pa.array(made.ravel()),
                    pa.array(np.tile(explained, size)),
                    pa.array(np.full(size * number, error)),
                ],
                names=schema.names,
            )

    return rows.select("id", "vector").mapInArrow(run, schema)


def whiten(vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", number: int = COMPONENTS) -> DataFrame:
    """Fit on all usable vectors (see ``fit_list``) and whiten each of them. Other columns are not read."""
    rows, width = fit_list(vectors, id_column, vector_column)
    return whitened(rows, width, fit(rows, width, number))
