"""Whitened embeddings: distributed covariance, float32 eigenvectors refined by matrix products in higher precision."""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import beside, free_name, written

#: An entry c counts as floor(STEPS * c) + OFFSET.
STEPS, OFFSET = 64, 1_000_000
#: Entries of at least this size have no such whole number in a double; their vectors are dropped.
LARGEST = float(1 << 52) / STEPS
#: Higher precision of the refinement.
HIGH = np.longdouble
#: Refinements at most; four are enough where eigenvalues are apart, and as many again for each depth of clusters.
ROUNDS = 30


def refined(a: np.ndarray, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, float, list[tuple[int, int]]]:
    """One Ogita-Aishima step for a symmetric matrix: better eigenvectors, values, what was wrong outside clusters, and these.

    Only matrix products in the higher precision: R = I - X'X tells how far X is from orthonormal, S = X'AX how far from
    diagonal; X(I + E) mends both to second order. Values closer together than the present error cannot be told apart
    by S, so within such a cluster (first, end) E mends orthonormality only.
    """
    eye = np.eye(len(a), dtype=HIGH)
    r, s = eye - vectors.T @ vectors, vectors.T @ a @ vectors
    # Rounding must not make these unsymmetric: divided by a small gap it would spoil orthonormality.
    r, s = (r + r.T) / 2, (s + s.T) / 2
    values = np.diag(s) / (1 - np.diag(r))
    order = np.argsort(-values, kind="stable")
    vectors, values, r, s = vectors[:, order], values[order], r[np.ix_(order, order)], s[np.ix_(order, order)]
    size = np.abs(values).max()
    # Frobenius norms bound the spectral ones, at the cost of somewhat larger clusters.
    delta = np.finfo(np.float64).eps * size + 2 * (np.sqrt(((s - np.diag(values)) ** 2).sum()) + size * np.sqrt((r**2).sum()))
    gap = values[None, :] - values[:, None]
    borders = [0, *(np.flatnonzero(-np.diff(values) > delta) + 1).tolist(), len(values)]
    same = np.zeros(gap.shape, bool)
    for i, j in zip(borders, borders[1:]):
        same[i:j, i:j] = True
    e = np.where(same, r / 2, (s + values[None, :] * r) / np.where(same, 1, gap))
    left = max(np.abs(r).max(), np.abs(np.where(same, 0, s)).max() / size)
    vectors = vectors + vectors @ e
    # What a turn by close values takes from orthonormality is mended at once, without dividing by a gap.
    for _ in range(3):
        vectors = vectors + vectors @ (eye - vectors.T @ vectors) / 2
    return vectors, values, float(left), [(i, j) for i, j in zip(borders, borders[1:]) if j - i > 1]


def split_cluster(a: np.ndarray, vectors: np.ndarray, least: float) -> np.ndarray | None:
    """Vectors of a cluster turned within its space: the small matrix, shifted to its mean value, is solved by itself.

    After the shift the cluster's own spread is the largest size there, so that single precision resolves it. None if
    nothing off the diagonal exceeds `least`: then the values are equal as far as can be told, and any basis is right.
    """
    t = vectors.T @ a @ vectors
    if np.abs(t - np.diag(np.diag(t))).max() <= least:
        return None
    t -= np.eye(len(t), dtype=HIGH) * (np.trace(t) / len(t))
    small = ((t + t.T) / (2 * np.abs(t).max())).astype(np.float32)
    return vectors @ np.linalg.eigh(small)[1][:, ::-1].astype(HIGH)


def eigen(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(values, unit vectors in columns) of a symmetric matrix by falling value, to double precision."""
    a = (matrix.astype(HIGH) + matrix.T.astype(HIGH)) / 2
    peak = np.abs(a).max() if a.size else 0
    if not peak > 0:
        return np.zeros(len(a)), np.eye(len(a))
    a = a / peak
    vectors = np.linalg.eigh(a.astype(np.float32))[1][:, ::-1].astype(HIGH)
    enough = float(np.finfo(np.float64).eps) / 8
    for _ in range(ROUNDS):
        vectors, values, wrong, clusters = refined(a, vectors)
        if wrong < enough:
            parts = [(i, j, split_cluster(a, vectors[:, i:j], enough)) for i, j in clusters]
            if all(part is None for _, _, part in parts):
                break
            for i, j, part in parts:
                if part is not None:
                    vectors[:, i:j] = part
    vectors = vectors / np.sqrt((vectors**2).sum(0))
    return (values * peak).astype(np.float64), vectors.astype(np.float64)


def whole(column: pa.Array, dimension: int | None = None) -> list[np.ndarray | None]:
    """floor(64 c) of every vector; None where it is null, empty, of another dimension or holds a part that is not finite."""
    out: list[np.ndarray | None] = []
    for values in column:
        x = None
        if values.is_valid and len(values) and values.values.null_count == 0 and dimension in (None, len(values)):
            c = values.values.to_numpy(zero_copy_only=False).astype(np.float64)
            if (np.abs(c) < LARGEST).all():
                x = np.floor(STEPS * c).astype(np.int64)
        out.append(x)
    return out


def packed(x: np.ndarray) -> bytes:
    """A vector of whole numbers in the narrowest of two widths, so that equal vectors have equal bytes."""
    narrow = np.abs(x).max() < 1 << 15
    return x.astype("<i2" if narrow else "<i8").tobytes()


def unpacked(column: pa.Array, dimension: int) -> np.ndarray:
    """Rows of whole numbers, x itself."""
    kinds = {2 * dimension: "<i2", 8 * dimension: "<i8"}
    rows = [np.frombuffer(raw, kinds[len(raw)]) for raw in column.to_pylist()]
    return np.array(rows, np.int64).reshape(-1, dimension) + OFFSET


class Fit:
    """n, sums S (exact), and from `solve` on the components, for one dimension; all of it grows with the dimension only."""

    def __init__(self, dimension: int, n: int, sums: list[int]):
        self.dimension, self.n = dimension, n
        self.floor = np.array([s // n for s in sums], np.int64) if n else np.zeros(dimension, np.int64)
        self.rest = np.array([s % n for s in sums], np.int64) if n else np.zeros(dimension, np.int64)

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - S/n with one rounding: the whole part of the mean is taken off before anything becomes a double."""
        return (x - self.floor) - self.rest / self.n

    def deviations(self, x: np.ndarray) -> list[Decimal]:
        """Sums of (n x - S)^2, exact."""
        near = x - self.floor
        peak = int(np.abs(near).max()) if near.size else 0
        if self.dimension * (self.n * (peak + 1)) ** 2 < 1 << 63:
            return [Decimal(int(v)) for v in ((self.n * near - self.rest) ** 2).sum(1)]
        rest = self.rest.astype(object)
        return [Decimal(int(v)) for v in ((self.n * near.astype(object) - rest) ** 2).sum(1)]

    def solve(self, covariance: np.ndarray, components: int) -> None:
        values, vectors = eigen(covariance)
        trace = float(np.trace(covariance))
        # A value within rounding of zero has no direction that whitening could scale.
        used = int((values > max(trace, 0) * self.dimension * np.finfo(np.float64).eps).sum())
        k = min(components, used)
        self.values, self.explained = values[:k], values[:k] / trace if trace > 0 else values[:k]
        self.basis = vectors[:, :k] / np.sqrt(values[:k])

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.basis


def _products(vectors: DataFrame, rows_of, size: int) -> np.ndarray:
    """Sum over all vectors of the outer product of a row with itself, `rows_of(x)`; each task sums its own first.

    What a task sends is one half of a matrix of that size, and one number for each of its cells reaches the driver.
    """
    i, j = np.triu_indices(size)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, some = np.zeros((size, size)), False
        for batch in batches:
            rows = rows_of(batch.column(0))
            total += rows.T @ rows
            some = True
        if some:
            yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), pa.array(total[i, j])], names=["i", "j", "v"])

    out = np.zeros((size, size))
    if size:
        for row in vectors.mapInArrow(run, "i long, j long, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).collect():
            out[row["i"], row["j"]] = out[row["j"], row["i"]] = row["v"]
    return out


def _sums(vectors: DataFrame, dimension: int) -> tuple[int, list[int]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = unpacked(batch.column(0), dimension)
            values = np.append(x.sum(0), len(x))
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(dimension + 1)), pa.array(values)], names=["i", "v"])

    rows = vectors.mapInArrow(run, "i long, v long").groupBy("i").agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("v")).collect()
    sums = {r["i"]: int(r["v"]) for r in rows}
    return sums.get(dimension, 0), [sums.get(i, 0) for i in range(dimension)]


def fit_list(vectors: DataFrame, column: str, dimension: int) -> DataFrame:
    """(x), each distinct vector of whole numbers once; copies meet in the map tasks before anything moves."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [packed(x) for x in whole(batch.column(0), dimension) if x is not None]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.binary())], names=["x"])

    return vectors.select(F.col(f"`{column}`").alias("v")).mapInArrow(run, "x binary").distinct()


def whiten(
    vectors: DataFrame, components: int = 16, column: str = "embedding", keep: list[str] | None = None, dimension: int | None = None
) -> DataFrame:
    """The kept columns with component, n, deviation, whitened, explained, identity_error: a row per vector and component.

    Entries count as x = floor(64 c) + 1000000. n, the exact sums and the covariance are those of the distinct x vectors,
    gathered by one shuffle of them and two passes; the driver holds matrices of the dimension, never vectors. The
    covariance's eigenvectors come in single precision and are refined by matrix products in extended precision, close
    eigenvalues by small problems of their own. All vectors are then projected where they lie. `identity_error` is
    measured by one more pass over the distinct vectors.

    A vector is dropped if it is null or empty, holds a null or a part that is not finite or of 2^52 / 64 or more, or has
    another dimension than `dimension`, by default the most frequent one (of equally frequent ones the largest).
    Components whose eigenvalue is zero within rounding are left out, so there are fewer than `components` if vectors
    are few or equal; with none left, or an empty table, the result is empty. Repeated rows and null ids come out row by
    row, and columns that are not kept are not read. `deviation` is a decimal of 38 digits.
    """
    keep = [c for c in vectors.columns if c != column] if keep is None else keep
    clash = {c.lower() for c in keep} & {"component", "n", "deviation", "whitened", "explained", "identity_error"}
    if clash:
        raise ValueError(f"kept columns are named like results: {sorted(clash)}")
    if dimension is None:
        sizes = vectors.select(F.size(f"`{column}`").alias("d")).where("d > 0").groupBy("d").count()
        row = sizes.orderBy(F.desc("count"), F.desc("d")).first()
        dimension = row["d"] if row else 1
    distinct = written(fit_list(vectors, column, dimension), "fit-list")
    fit = Fit(dimension, *_sums(distinct, dimension))
    if fit.n:
        covariance = _products(distinct, lambda x: fit.centred(unpacked(x, dimension)), dimension) / fit.n
        fit.solve(covariance, components)
    k = fit.basis.shape[1] if fit.n else 0
    error = 0.0
    if k:
        again = _products(distinct, lambda x: fit.whitened(unpacked(x, dimension)), k) / fit.n
        error = float(np.abs(again - np.eye(k)).max())
    chosen = vectors.select(*(F.col(f"`{c}`") for c in keep), F.col(f"`{column}`").alias(free_name(vectors, "_vector")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = whole(batch.column(len(keep)), dimension)
            at = np.array([i for i, x in enumerate(rows) if x is not None], np.int64)
            if not (k and len(at)):
                continue
            x = np.array([rows[i] for i in at]) + OFFSET
            part = batch.take(pa.array(np.repeat(at, k)))
            size = len(at) * k
            yield beside(
                part, keep,
                component=pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(at))),
                n=pa.array(np.full(size, fit.n)),
                deviation=pa.array(np.repeat(np.array(fit.deviations(x), object), k).tolist(), pa.decimal128(38, 0)),
                whitened=pa.array(fit.whitened(x).ravel()),
                explained=pa.array(np.tile(fit.explained, len(at))),
                identity_error=pa.array(np.full(size, error)),
            )

    new = "component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
    schema = T.StructType([*(chosen.schema[c] for c in keep), *T.StructType.fromDDL(new).fields])
    return chosen.mapInArrow(run, schema)
