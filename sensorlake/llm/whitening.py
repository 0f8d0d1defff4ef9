"""Embedding whitening: float32 eigenvectors of a distributed covariance, refined in higher precision.

An entry c becomes the integer x = floor(64 c) + 1000000 (exact). The fit list holds each
distinct x vector once, in a stored table; its sums and its covariance are partial
sums of partitions, combined in two levels, so a task holds one matrix of the dimension and one batch.
The driver sees matrices of the dimension only. Rows are centred with the exact integer
sums before anything is multiplied.

The eigenvectors come from a float32 solve. Each refinement step (Ogita and Aishima) needs only matrix
products, done in extended precision: the departure from orthogonality and the off-diagonal rest of the
projected matrix give the correction. Eigenvalues closer together than the step can resolve form a cluster, whose
subspace is solved apart: the matrix projected on it, shifted by the cluster's mean, is a small eigenproblem
whose rotation separates the members for the next step. Members that stay equal (a multiple
eigenvalue) keep any orthonormal basis of their space.

Defined results: a row whose vector is null, empty, holds null or non-finite entries, or has another
length than most non-null vectors has no result. Repeated rows each get one and count once in
the fit. A null vec_id stays null. x is kept within 2**61 of zero. Components without
variance (constant tables, fewer distinct rows than dimensions) are left out, so a table without
variance, or an empty one, gives no rows. A deviation beyond 64 bits is null.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorlake.llm.tables import matrix, stored

COMPONENTS = 16
MOST = 1 << 61          # bound of |x|
FAN = 16                # partial sums meet in so many tasks before the last one
WIDE = np.longdouble

SCHEMA = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


# --- integer vectors ---------------------------------------------------------------------------

def integer_vectors(column: pa.Array, d: int) -> tuple[np.ndarray, np.ndarray]:
    """(x, rows): integer vectors of the rows that hold d finite entries, and those rows' numbers."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    ends = column.offsets.to_numpy()
    rows = np.flatnonzero((np.diff(ends) == d) & column.is_valid().to_numpy(zero_copy_only=False))
    values = column.values.to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    if not len(rows):
        return np.zeros((0, d), np.int64), rows
    c = values[ends[rows][:, None] + np.arange(d)]
    good = np.isfinite(c).all(axis=1)
    with np.errstate(over="ignore"):
        x = np.clip(np.floor(64.0 * c[good]), -float(MOST), float(MOST)).astype(np.int64) + 1_000_000
    return x, rows[good]


def dimension(vectors: DataFrame, vec_col: str) -> int:
    """The commonest length of a non-null vector (the longer one of equals); 0 without vectors."""
    top = vectors.filter(F.col(vec_col).isNotNull()).groupBy(F.size(vec_col).alias("d")).agg(F.count(F.lit(1)).alias("n")).filter(
        "d > 0").orderBy(F.desc("n"), F.desc("d")).first()
    return top["d"] if top else 0


def distinct_vectors(vectors: DataFrame, vec_col: str, d: int) -> DataFrame:
    """x (binary, d little-endian longs): each distinct integer vector once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x, _ = integer_vectors(b.column(0), d)
            yield pa.RecordBatch.from_arrays([pa.array([r.tobytes() for r in x], pa.binary())], names=["x"])

    return vectors.select(F.col(vec_col).cast("array<double>")).mapInArrow(run, "x binary").distinct()


# --- sums over partitions ----------------------------------------------------------------------

def _combined(blocks: DataFrame, add: Callable[[list[bytes]], bytes]) -> bytes | None:
    """One value from one binary block a partition: added in FAN tasks, then in one. Each task holds its sum and a batch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for b in batches:
            for block in b.column(0).to_pylist():
                total = block if total is None else add([total, block])
        yield pa.RecordBatch.from_arrays([pa.array([] if total is None else [total], pa.binary())], names=["block"])

    row = blocks.repartition(FAN).mapInArrow(run, "block binary").repartition(1).mapInArrow(run, "block binary").first()
    return row["block"] if row else None


def _per_partition(fit_list: DataFrame, d: int, start: Callable[[], object], step: Callable, pack: Callable[[object], bytes]) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, seen = start(), False
        for b in batches:
            if b.num_rows:
                seen, state = True, step(state, matrix(b.column(0), "<i8", d))
        yield pa.RecordBatch.from_arrays([pa.array([pack(state)] if seen else [], pa.binary())], names=["block"])

    return fit_list.mapInArrow(run, "block binary")


def exact_sums(fit_list: DataFrame, d: int) -> tuple[int, list[int]]:
    """(n, sum of each dimension) as whole numbers: high and low halves are added apart, so nothing overflows."""
    def step(state, x):
        state[0] += len(x)
        state[1:d + 1] += (x >> 32).sum(axis=0)
        state[d + 1:] += (x & 0xFFFFFFFF).sum(axis=0)
        return state

    parts = _per_partition(fit_list, d, lambda: np.zeros(2 * d + 1, np.int64), step, lambda s: s.astype("<i8").tobytes())
    block = _combined(parts, lambda ab: (np.frombuffer(ab[0], "<i8") + np.frombuffer(ab[1], "<i8")).tobytes())
    if block is None:
        return 0, [0] * d
    s = np.frombuffer(block, "<i8").tolist()
    return s[0], [(h << 32) + low for h, low in zip(s[1:d + 1], s[d + 1:], strict=True)]


def _pack(wide: np.ndarray) -> bytes:
    """Extended precision as the sum of two doubles."""
    high = wide.astype(np.float64)
    return np.concatenate((high.ravel(), (wide - high).astype(np.float64).ravel())).astype("<f8").tobytes()


def _unpack(block: bytes) -> np.ndarray:
    halves = np.frombuffer(block, "<f8").reshape(2, -1).astype(WIDE)
    return halves[0] + halves[1]


def second_moment(fit_list: DataFrame, d: int, project: Callable[[np.ndarray], np.ndarray], width: int, n: int) -> np.ndarray:
    """Covariance (divisor n) of ``project(x)``, whose rows come centred; what is left of their mean is taken out too."""
    def step(state, x):
        for i in range(0, len(x), 4096):
            y = project(x[i:i + 4096])
            state[0] += y.sum(axis=0)
            state[1:] += y.T @ y
        return state

    parts = _per_partition(fit_list, d, lambda: np.zeros((width + 1, width), WIDE), step, _pack)
    total = _unpack(_combined(parts, lambda ab: _pack(_unpack(ab[0]) + _unpack(ab[1])))).reshape(width + 1, width) / WIDE(n)
    return total[1:] - np.outer(total[0], total[0])


class Centre:
    """x - S/n: the whole part of the mean is taken off in integers, the fraction in double precision."""

    def __init__(self, n: int, sums: list[int]):
        self.n, whole = n, [s // n for s in sums]
        self.rest = [s - n * w for s, w in zip(sums, whole, strict=True)]
        self.whole = np.array(whole, np.int64)
        self.fraction = np.array([r / n for r in self.rest])

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return (x - self.whole).astype(np.float64) - self.fraction

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """Sum over dimensions of (n x - S)^2, exact; None beyond 64 bits."""
        z = x - self.whole
        rough = ((self.n * z.astype(np.float64) - np.array(self.rest, np.float64)) ** 2).sum(axis=1)
        small = rough < 2.0 ** 61      # each term, and so each factor, fits then
        out: list[int | None] = [None] * len(x)
        exact = ((self.n * z[small] - np.array(self.rest, np.int64)) ** 2).sum(axis=1)
        for i, v in zip(np.flatnonzero(small).tolist(), exact.tolist(), strict=True):
            out[i] = v
        for i in np.flatnonzero(~small & (rough < 2.0 ** 64)).tolist():
            v = sum((self.n * a - r) ** 2 for a, r in zip(z[i].tolist(), self.rest, strict=True))
            out[i] = v if v < 1 << 63 else None
        return out


# --- eigenvectors ------------------------------------------------------------------------------

def _norm(a: np.ndarray) -> float:
    return float(np.linalg.norm(a.astype(np.float64), 2))


def _clusters(values: np.ndarray, reach: float) -> list[np.ndarray]:
    """Index sets of two or more values (falling) in which neighbours are at most ``reach`` apart."""
    order = np.argsort(-values, kind="stable")
    cuts = np.flatnonzero(values[order][:-1] - values[order][1:] > reach) + 1
    return [c for c in np.split(order, cuts) if len(c) > 1]


def refined_eigen(a: np.ndarray, rounds: int = 30) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues falling, eigenvectors as columns) of a symmetric matrix, in extended precision.

    Starts from a float32 solve; a matrix of zeros gives zeros and the unit vectors.
    """
    d = len(a)
    a = (a.astype(WIDE) + a.astype(WIDE).T) / 2
    scale = np.abs(a).max() if d else WIDE(0)
    if not scale:
        return np.zeros(d, WIDE), np.eye(d, dtype=WIDE)
    a, one = a / scale, np.eye(d, dtype=WIDE)
    x = np.linalg.eigh(a.astype(np.float32))[1].astype(WIDE)
    size, done = _norm(a), 4 * d * float(np.finfo(WIDE).eps)
    for _ in range(rounds):
        r = one - x.T @ x
        s = x.T @ a @ x
        r, s = (r + r.T) / 2, (s + s.T) / 2     # else rounding, divided by a small gap, would turn members apart
        values = np.diag(s) / (1 - np.diag(r))
        reach = 2 * (_norm(s - np.diag(values)) + size * _norm(r))
        gap = values[None, :] - values[:, None]
        apart = np.abs(gap) > reach
        rest = s + values[None, :] * r
        e = np.where(apart, rest / np.where(apart, gap, 1), r / 2)
        x, turned = x + x @ e, False
        for members in _clusters(values, reach):
            sub = x[:, members]
            small = sub.T @ (a @ sub - values[members].mean() * sub)
            top = np.abs(small).max()
            if top > done:      # below, the members are equal to all digits and any basis will do
                turned = True
                turn = np.linalg.eigh(((small + small.T) / (2 * top)).astype(np.float64))[1].astype(WIDE)
                x[:, members] = sub @ turn
        if not turned and max(np.abs(r).max(), np.abs(np.where(apart, rest, 0)).max()) <= done:
            break
    values = np.einsum("ij,ij->j", x, a @ x) / np.einsum("ij,ij->j", x, x)
    order = np.argsort(-values, kind="stable")
    return values[order] * scale, x[:, order]


# --- operator ----------------------------------------------------------------------------------

def whiten(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """vec_id, component (from 1), n, deviation, whitened, explained, identity_error for every usable row."""
    spark = vectors.sparkSession
    d = dimension(vectors, vec_col)
    none = spark.createDataFrame([], SCHEMA)
    if not d:
        return none
    fit_list = stored(distinct_vectors(vectors, vec_col, d), "vectors")
    n, sums = exact_sums(fit_list, d)
    if not n:
        return none
    centre = Centre(n, sums)
    covariance = second_moment(fit_list, d, centre, d, n)
    values, axes = refined_eigen(covariance)
    k = int((values[:components] > values[0] * 4 * d * np.finfo(np.float64).eps).sum()) if values[0] > 0 else 0
    if not k:
        return none
    scaled = (axes[:, :k] / np.sqrt(values[:k])).astype(np.float64)
    explained = (values[:k] / np.trace(covariance)).astype(np.float64)
    rest = second_moment(fit_list, d, lambda x: centre(x) @ scaled, k, n) - np.eye(k, dtype=WIDE)
    error = float(np.abs(rest).max())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x, rows = integer_vectors(b.column(1), d)
            m = len(rows)
            ids = b.column(0).take(pa.array(np.repeat(rows, k)))
            yield pa.RecordBatch.from_arrays([
                ids, pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, n, np.int64)),
                pa.array([v for v in centre.deviation(x) for _ in range(k)], pa.int64()), pa.array((centre(x) @ scaled).ravel()),
                pa.array(np.tile(explained, m)), pa.array(np.full(m * k, error))], names=[c.split()[0] for c in SCHEMA.split(", ")])

    return vectors.select(F.col(id_col).cast("long"), F.col(vec_col).cast("array<double>")).mapInArrow(run, SCHEMA)
