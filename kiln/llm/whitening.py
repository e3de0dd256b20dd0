"""Embedding whitening by QDWH spectral divide and conquer.

Entries become integers x = floor(``SCALE`` * c) + ``OFFSET``.  Spark adds up
n, the exact sums S and the covariance V of x, centred before multiplying.  V
is split by the polar decomposition of V - shift * I: its orthogonal factor U,
found by the QDWH iteration (dynamically weighted Halley steps, with QR while
badly conditioned and Cholesky after), gives the projector (U + I) / 2 on the
directions whose variance exceeds the shift.  Orthonormal bases of its range
and of the rest block-diagonalise V, and each block is split in the same way
until single components are left.  The projection of all vectors on the
leading components, over the square roots of their variances, is then a plain
product with a matrix that travels with the tasks.

Edge cases: vectors that are null, empty, hold a null or non-finite entry or
one of ``MOST`` or more in size, or have another length than the commonest,
are dropped.  Rows that share a vec_id, null included, are vectors of their
own.  Components without variance (up to rounding) cannot be whitened and are
left out, so equal vectors give no row.  A deviation that leaves 64 bits is
null.  An empty table gives an empty result; other columns are ignored.

Scale: two passes of partial sums of d by d numbers a task, added up in two
steps, and one pass that projects; nothing but such sums reaches the driver,
whose work depends on the dimension alone.  No pass shuffles a vector.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kiln.llm.vectors import common_length, gram, matrix, usable

__all__ = ["SCALE", "OFFSET", "MOST", "COMPONENTS", "polar", "spectral", "Whitening", "fit", "whiten", "rows"]

SCALE = 64
OFFSET = 1_000_000
#: Entries are smaller than this in size: their integers, and sums over a batch of them, stay exact.
MOST = float(1 << 40)
COMPONENTS = 32

_EPS = np.finfo(float).eps


# ---- the spectral decomposition -------------------------------------------------------
def polar(a: np.ndarray) -> np.ndarray:
    """The orthogonal factor of a symmetric matrix's polar decomposition, by the QDWH iteration."""
    n = len(a)
    alpha = float(np.linalg.norm(a))
    if alpha == 0:
        return np.eye(n)
    x = a / alpha
    try:  # a lower bound of the smallest singular value; the iteration only needs its order of size
        low = 1 / (float(np.linalg.norm(np.linalg.inv(x), 1)) * np.sqrt(n))
    except np.linalg.LinAlgError:
        low = _EPS
    low = min(max(low, _EPS), 1.0)
    eye = np.eye(n)
    for _ in range(40):
        g = np.cbrt(max(0.0, 4 * (1 - low ** 2) / low ** 4))
        root = np.sqrt(1 + g)
        wa = root + 0.5 * np.sqrt(max(0.0, 8 - 4 * g + 8 * (2 - low ** 2) / (low ** 2 * root)))
        wb = (wa - 1) ** 2 / 4
        wc = wa + wb - 1
        if wc > 100:
            q, _ = np.linalg.qr(np.vstack([np.sqrt(wc) * x, eye]))
            new = wb / wc * x + (wa - wb / wc) / np.sqrt(wc) * (q[:n] @ q[n:].T)
        else:
            lower = np.linalg.cholesky(eye + wc * (x.T @ x))
            solved = np.linalg.solve(lower.T, np.linalg.solve(lower, x.T)).T
            new = wb / wc * x + (wa - wb / wc) * solved
        new = (new + new.T) / 2
        moved = float(np.linalg.norm(new - x))
        x, low = new, min(1.0, low * (wa + wb * low ** 2) / (1 + wc * low ** 2))
        if moved < _EPS ** (1 / 3) and abs(1 - low) < 10 * _EPS:
            break
    # one Newton-Schulz step takes off what rounding left
    return 1.5 * x - 0.5 * x @ (x.T @ x)


def _split(a: np.ndarray, shift: float, scale: float) -> tuple[np.ndarray, int] | None:
    """(orthogonal basis, size of its first part) that block-diagonalises ``a`` at ``shift``; None where it fails."""
    n = len(a)
    u = polar(a - shift * np.eye(n))
    up = (u + np.eye(n)) / 2
    k = int(round(float(np.trace(up))))
    if not 0 < k < n or np.linalg.norm(up @ up - up) > 1e-8 * n:
        return None
    rng = np.random.default_rng(n)  # any full-rank start spans the range; two products clean it
    first, _ = np.linalg.qr(up @ rng.standard_normal((n, k)))
    first, _ = np.linalg.qr(up @ first)
    rest = rng.standard_normal((n, n - k))
    rest, _ = np.linalg.qr(rest - up @ rest)
    basis, _ = np.linalg.qr(np.hstack([first, rest - first @ (first.T @ rest)]))
    off = basis[:, k:].T @ a @ basis[:, :k]
    return (basis, k) if np.linalg.norm(off) <= 100 * n * _EPS * scale else None


def _shifts(a: np.ndarray) -> Iterator[float]:
    """Places to split at, most promising first; all lie between the least and the largest eigenvalue."""
    diagonal = np.sort(np.diag(a))
    n = len(diagonal)
    yield float(diagonal[(n - 1) // 2] + diagonal[n // 2]) / 2
    middle, spread = float(diagonal.mean()), float(np.linalg.norm(a - np.diag([diagonal.mean()] * n))) / np.sqrt(n)
    yield middle
    for k in range(1, 40):  # the standard deviation of the eigenvalues is spread: some lie within it of the mean
        yield middle + spread * (0.9 * (k * 0.6180339887498949 % 1.0) - 0.45) * 2


def spectral(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, falling; unit eigenvectors as columns) of a symmetric matrix, by QDWH divide and conquer."""
    a = (a + a.T) / 2
    scale = float(np.linalg.norm(a))
    vectors = np.empty_like(a)
    done = 0
    todo = [(a, np.eye(len(a)))]
    while todo:
        block, basis = todo.pop()
        n = len(block)
        centre = float(np.trace(block)) / n
        flat = n == 1 or np.linalg.norm(block - centre * np.eye(n)) <= 4 * n * _EPS * scale
        found = None if flat else next((s for s in (_split(block, x, scale) for x in _shifts(block)) if s), None)
        if found is None:  # one component, or several of one variance, any basis of which will do
            vectors[:, done:done + n] = basis
            done += n
            continue
        turn, k = found
        for part in (turn[:, k:], turn[:, :k]):
            small = part.T @ block @ part
            todo.append(((small + small.T) / 2, basis @ part))
    vectors, r = np.linalg.qr(vectors)
    vectors = vectors * np.where(np.diag(r) < 0, -1.0, 1.0)
    values = np.einsum("ij,ij->j", vectors, a @ vectors)
    order = np.argsort(-values, kind="stable")
    values, vectors = values[order], vectors[:, order]
    lead = vectors[np.abs(vectors).argmax(0), np.arange(len(a))]
    return values, vectors * np.where(lead < 0, -1.0, 1.0)


# ---- over tables ------------------------------------------------------------------------
def _integers(column: pa.Array, length: int) -> np.ndarray:
    return np.floor(SCALE * matrix(column, length)).astype(np.int64) + OFFSET


class Whitening:
    """What ``fit`` learns: ``n``, exact ``sums``, ``values`` (variances, falling) and ``vectors`` of the components
    used, ``trace`` of the covariance and ``identity_error`` of the whitened vectors' covariance."""

    def __init__(self, n: int, sums: list[int], values: np.ndarray, vectors: np.ndarray, trace: float):
        self.n, self.sums, self.values, self.vectors, self.trace = n, sums, values, vectors, trace
        self.identity_error = 0.0

    @property
    def length(self) -> int:
        return len(self.sums)

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - S / n, rounded once: the whole part of the mean is taken off as an integer."""
        whole = np.array([s // self.n for s in self.sums], np.int64)
        part = np.array([(s % self.n) / self.n for s in self.sums])
        return (x - whole) - part

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ (self.vectors / np.sqrt(self.values))

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """Exact sum over dimensions of (n * x - S) squared for each row; None beyond 64 bits."""
        whole = np.array([s // self.n for s in self.sums], np.int64)
        rest = np.array([s % self.n for s in self.sums], np.int64)
        near = x - whole  # n * x - S = n * (x - whole) - rest
        size = int(np.abs(near).max(initial=0)) * self.n + self.n
        if size * size * self.length < 1 << 62:
            return ((self.n * near - rest) ** 2).sum(1).tolist()
        exact = [sum((self.n * v - r) ** 2 for v, r in zip(row, rest.tolist())) for row in near.tolist()]
        return [v if v < 1 << 63 else None for v in exact]


def _sums(table: DataFrame, length: int) -> tuple[int, list[int]]:
    """(n, exact sums of the integers by dimension)."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = [0] * length, 0
        for batch in batches:
            n += batch.num_rows
            # 10,000 rows of 2**46 stay below 2**63; Python's integers hold the rest
            total = [t + s for t, s in zip(total, _integers(batch.column(0), length).sum(0).tolist())]
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(range(-1, length), pa.int32()),
                                              pa.array([str(v) for v in [n, *total]], pa.string())], ["dim", "total"])

    found = table.select("vector").mapInArrow(add, "dim int, total string")
    found = found.groupBy("dim").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
    totals = {r["dim"]: int(r["total"]) for r in found.collect()}  # a row for each dimension
    return (totals[-1], [totals[k] for k in range(length)]) if totals else (0, [])


def _table(vectors: DataFrame, vec_id: str, vector: str, length: int) -> DataFrame:
    return usable(vectors, vector, length, MOST, F.col(f"`{vec_id}`").alias("vec_id"))


def fit(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> Whitening | None:
    """The whitening of all usable vectors, up to ``components`` components; None where there is none."""
    length = common_length(vectors, vector, MOST)
    if length is None:
        return None
    table = _table(vectors, vec_id, vector, length)
    n, sums = _sums(table, length)
    plain = Whitening(n, sums, np.ones(length), np.eye(length), 0.0)
    total, outer = gram(table, ["vector"], lambda batch: plain.centred(_integers(batch.column(0), length)), length)
    covariance = outer / n - np.outer(total / n, total / n)
    values, directions = spectral(covariance)
    trace = float(np.trace(covariance))
    used = int((values[:components] > 8 * length * _EPS * max(trace, 0.0)).sum())
    if not used:
        return None
    found = Whitening(n, sums, values[:used], directions[:, :used], trace)
    total, outer = gram(table, ["vector"], lambda batch: found.whitened(_integers(batch.column(0), length)), used)
    identity = outer / n - np.outer(total / n, total / n) - np.eye(used)
    found.identity_error = float(np.abs(identity).max())
    return found


def whiten(vectors: DataFrame, found: Whitening, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """vec_id, ``whitened`` (array, a number for each component) and ``deviation`` of every usable vector."""
    table = _table(vectors, vec_id, vector, found.length)
    schema = T.StructType([table.schema["vec_id"], T.StructField("deviation", T.LongType()),
                           T.StructField("whitened", T.ArrayType(T.DoubleType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _integers(batch.column(1), found.length)
            values = found.whitened(x)
            offsets = pa.array(np.arange(0, values.size + 1, values.shape[1]), pa.int32())
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array(found.deviation(x), pa.int64()),
                pa.ListArray.from_arrays(offsets, pa.array(values.ravel()))], schema.fieldNames())

    return table.mapInArrow(run, schema)


def rows(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """A row for each usable vector and component: vec_id, component (from 1), n, deviation, whitened, explained (share
    of all variance) and identity_error (one value)."""
    found = fit(vectors, vec_id, vector, components)
    if found is None:
        nothing = vectors.where(F.lit(False)).select(F.col(f"`{vec_id}`").alias("vec_id"))
        return nothing.selectExpr("vec_id", "cast(0 AS int) AS component", "cast(0 AS bigint) AS n", "cast(0 AS bigint) AS deviation",
                                  "cast(0 AS double) AS whitened", "cast(0 AS double) AS explained", "cast(0 AS double) AS identity_error")
    explained = F.array(*[F.lit(float(v / found.trace)) for v in found.values])
    df = whiten(vectors, found, vec_id, vector).select("vec_id", "deviation", F.posexplode("whitened").alias("k", "whitened"))
    return df.select("vec_id", (F.col("k") + 1).alias("component"), F.lit(found.n).cast("bigint").alias("n"), "deviation", "whitened",
                     F.get(explained, F.col("k")).alias("explained"), F.lit(found.identity_error).alias("identity_error"))
