"""Embedding whitening by Chebyshev-filtered subspace iteration (operator 13).

Every entry c becomes the integer ``floor(scale * c) + shift``; the fit list has
each distinct integer vector once. Its covariance V is never formed: the driver
holds a block Q of ``2 k`` vectors, and one distributed pass multiplies the
centred rows by it and sums ``X'(XQ) / n`` over blocks of rows.

1. A short Lanczos run, its vectors kept orthogonal, estimates the lower end of the spectrum.
2. Rayleigh-Ritz on the block gives the upper end of its unwanted part: the
   smallest Ritz value.
3. A Chebyshev polynomial of degree ``degree``, small on that interval and steep
   above it, is applied to the block by its three-term recurrence, a pass a step.
4. QR makes the block orthonormal; Rayleigh-Ritz, one pass, gives new Ritz pairs
   and their residuals ``|Vq - eq|``. The wanted ones are certified when all
   are at most ``TOL`` of the largest eigenvalue; else from 2.

Vectors no longer than the block span the whole space: Rayleigh-Ritz is exact then.

Scale: distinct vectors are found by one shuffle and staged packed, a row per
block of ``BLOCK_BYTES``; sums of integers are exact, those of products go through a
grouped reduce, so the driver gets at most ``REDUCERS`` matrices of the block's size a pass.
Nothing but matrices of (dimensions x block) reaches the driver, whatever the number of rows.

Defined results: rows with a null vector, an empty one, null or non-finite entries, or entries whose
integer does not fit 63 bits take no part; so do vectors of another length than the most
frequent one (ties: the longest). Repeated rows: one output row each and component, one row of the fit
list. Components whose eigenvalue is 0 (to rounding) are left out: they can't be whitened. Null ids are kept.
A deviation beyond a long is null. No rows: no rows. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obsgate.llm import common as C
from obsgate.llm import vectors as V

COMPONENTS, SCALE, SHIFT = 16, 64, 1_000_000
DEGREE, LANCZOS, CYCLES = 12, 12, 60
TOL, SPREAD = 2e-14, 1e6
BLOCK_BYTES, REDUCERS = 2 << 20, 32
OUT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def prepared(df: DataFrame, id_col: str, vector_col: str, scale: int, shift: int) -> DataFrame:
    """``(vec_id, x)`` of the rows that take part, whatever their vectors' length."""
    rows = df.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), F.col(f"`{vector_col}`").cast("array<double>").alias("v"))
    return rows.filter(V.usable(F.col("v"), scale)).select("vec_id", V.integers(F.col("v"), scale, shift).alias("x"))


def _pack(batches: Iterator[pa.RecordBatch], dims: int, shift: int, block_bytes: int) -> Iterator[pa.RecordBatch]:
    """Blocks of vectors less ``shift``, in 4 or 8 bytes an entry, with the exact sums of their entries."""
    most = max(1, block_bytes // (8 * dims))
    for b in batches:
        x = V.matrix(b.column(0)) - shift
        for lo in range(0, len(x), most):
            part = x[lo : lo + most]
            narrow = not len(part) or np.abs(part).max() < 2**31
            high, low = part >> 32, part & 0xFFFFFFFF  # sums of either half fit a long
            row = [part.astype("<i4" if narrow else "<i8").tobytes()], [4 if narrow else 8], [len(part)], [high.sum(0).tolist()], [low.sum(0).tolist()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(row, (pa.binary(), pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64())))], ["block", "width", "n", "high", "low"])


@dataclass
class Fit:
    """Rows ``x`` are centred as ``x - shift - whole - part``: integers first, so nothing is lost."""

    n: int
    sums: list[int]  # of x, exact
    shift: int
    whole: np.ndarray
    part: np.ndarray

    def centred(self, x: np.ndarray) -> np.ndarray:
        """``x``: entries less the shift."""
        return (x - self.whole).astype(float) - self.part


def _sums(batches: Iterator[pa.RecordBatch], dims: int) -> Iterator[pa.RecordBatch]:
    """Vectors and exact sums by dimension, of all blocks of a task."""
    n, high, low = 0, [0] * dims, [0] * dims
    for b in batches:
        n += sum(b.column(0).to_pylist())
        for h, l in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
            high, low = [x + y for x, y in zip(high, h)], [x + y for x, y in zip(low, l)]
    sums = [str((h << 32) + l) for h, l in zip(high, low)]
    yield pa.RecordBatch.from_arrays([pa.array(range(dims), pa.int32()), pa.array([n] * dims), pa.array(sums)], ["i", "n", "s"])


def _fit(blocks: DataFrame, dims: int, shift: int) -> Fit:
    parts = blocks.select("n", "high", "low").mapInArrow(lambda it: _sums(it, dims), "i int, n long, s string")
    rows = parts.groupBy("i").agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).orderBy("i").collect()  # one a dimension
    n, less = rows[0].n, [int(r.s) for r in rows]
    means = [Fraction(s, n) for s in less]
    whole = [m.numerator // m.denominator for m in means]
    return Fit(n, [s + n * shift for s in less], shift, np.array(whole, np.int64), np.array([float(m - w) for m, w in zip(means, whole)]))


def _unpacked(block: bytes, width: int, dims: int) -> np.ndarray:
    return np.frombuffer(block, f"<i{width}").reshape(-1, dims).astype(np.int64)


def _summed(blocks: DataFrame, product) -> np.ndarray:
    """Sum of ``product(block of integers)``, a matrix, over all blocks."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for b in batches:
            for block, width in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                m = product(block, width)
                total = m if total is None else total + m
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["m"])

    def add(t: pa.Table) -> pa.Table:
        return pa.table([pa.array([sum(np.frombuffer(m) for m in t.column("m").to_pylist()).tobytes()], pa.binary())], ["m"])

    parts = blocks.select("block", "width").mapInArrow(partial, "m binary")
    if blocks.rdd.getNumPartitions() > REDUCERS:
        parts = parts.withColumn("g", F.pmod(F.spark_partition_id(), F.lit(REDUCERS))).groupBy("g").applyInArrow(add, "m binary")
    return sum(np.frombuffer(r.m) for r in parts.collect())


def covariance_times(blocks: DataFrame, fit: Fit, q: np.ndarray) -> np.ndarray:
    """``V q``: one pass over the fit list."""
    dims = len(q)

    def product(block: bytes, width: int) -> np.ndarray:
        x = fit.centred(_unpacked(block, width, dims))
        return x.T @ (x @ q)

    return _summed(blocks, product).reshape(q.shape) / fit.n


def gram(blocks: DataFrame, fit: Fit, w: np.ndarray) -> np.ndarray:
    """Covariance of the projections on ``w``'s columns over the fit list: one pass."""
    dims = len(w)

    def product(block: bytes, width: int) -> np.ndarray:
        z = fit.centred(_unpacked(block, width, dims)) @ w
        return z.T @ z

    return _summed(blocks, product).reshape(w.shape[1], -1) / fit.n


def trace(blocks: DataFrame, fit: Fit) -> float:
    dims = len(fit.whole)
    return float(_summed(blocks, lambda block, width: np.array([np.square(fit.centred(_unpacked(block, width, dims))).sum()]))[0]) / fit.n


# --- on the driver: matrices of (dimensions x block)


def lower_end(times, dims: int, steps: int, rng: np.random.Generator) -> float:
    """An estimate from below of the smallest eigenvalue: Lanczos' smallest Ritz value less its residual."""
    basis = np.zeros((dims, 0))
    v = rng.standard_normal((dims, 1))
    alpha, beta = [], []
    for _ in range(min(steps, dims)):
        v /= np.linalg.norm(v)
        basis = np.hstack([basis, v])
        w = times(v)
        alpha.append(float((v.T @ w)[0, 0]))
        for _ in range(2):
            w = w - basis @ (basis.T @ w)
        beta.append(float(np.linalg.norm(w)))
        if beta[-1] <= 1e-12 * max(abs(alpha[0]), 1e-300):
            break
        v = w
    off = beta[: len(alpha) - 1]
    e, s = np.linalg.eigh(np.diag(alpha) + np.diag(off, 1) + np.diag(off, -1))
    return max(0.0, float(e[0] - beta[-1] * abs(s[-1, 0])))


def filtered(times, q: np.ndarray, low: float, high: float, top: float, degree: int) -> np.ndarray:
    """The Chebyshev polynomial of V on ``[low, high]``, scaled to 1 at ``top``, applied to ``q``: ``degree`` passes."""
    half, mid = (high - low) / 2, (high + low) / 2
    sigma = first = half / (top - mid)
    before, now = q, (times(q) - mid * q) * (sigma / half)
    for _ in range(degree - 1):
        new = 1 / (2 / first - sigma)
        before, now = now, (times(now) - mid * now) * (2 * new / half) - before * (sigma * new)
        sigma = new
    return now


def rayleigh_ritz(times, q: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ritz values, falling, their vectors in the span of ``q``, and residual norms: one pass."""
    q, _ = np.linalg.qr(q)
    vq = times(q)
    h = q.T @ vq
    e, s = np.linalg.eigh((h + h.T) / 2)
    e, s = e[::-1], s[:, ::-1]
    return e, q @ s, np.linalg.norm(vq @ s - (q @ s) * e, axis=0)


def leading(times, dims: int, k: int, *, degree: int = DEGREE, tol: float = TOL, seed: int = 13) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues and their vectors, certified by residuals of at most ``tol`` of the largest."""
    rng = np.random.default_rng(seed)
    m = min(dims, 2 * k)
    e, q, r = rayleigh_ritz(times, np.eye(dims) if m == dims else rng.standard_normal((dims, m)))
    if m == dims:
        return e[:k], q[:, :k]
    low = lower_end(times, dims, LANCZOS, rng)
    best, since = np.inf, 0
    for _ in range(CYCLES):
        worst = r[:k].max() / max(e[0], 1e-300)
        since = since + 1 if worst > best / 2 else 0
        best = min(best, worst)
        if e[0] <= 0 or worst <= (tol if since < 3 else 50 * tol):  # what rounding of the passes leaves, if no cycle betters it
            return e[:k], q[:, :k]
        high = e[-1] + r[-1] * 1e-3
        low, high = min(low, high * 0.9), max(high, 1e-12 * e[0])
        # the largest are not to drown the last wanted one: at most SPREAD times its growth
        growth = np.arccosh(np.maximum((2 * e[[0, k - 1]] - high - low) / (high - low), 1))
        steps = int(min(degree, max(2, np.log(SPREAD) / max(growth[0] - growth[1], 1e-9))))
        q = filtered(times, q, low, high, e[0], steps)
        e, q, r = rayleigh_ritz(times, q)
    raise RuntimeError(f"residuals of {best:.3g} of the largest eigenvalue after {CYCLES} cycles")


# --- as Spark jobs


def _whitened(batches: Iterator[pa.RecordBatch], fit: Fit, w: np.ndarray, explained: np.ndarray, error: float) -> Iterator[pa.RecordBatch]:
    dims, k = w.shape
    names = [c.split()[0] for c in OUT.split(", ")]
    for b in batches:
        for lo in range(0, b.num_rows, 4096):
            part = b.slice(lo, 4096)
            x = V.matrix(part.column(1)) - fit.shift
            c = fit.centred(x)
            own = [s - fit.n * fit.shift for s in fit.sums]
            if fit.n * float(np.abs(c).max()) < 2**31 / dims**0.5 and max(map(abs, own)) < 2**62 and fit.n * float(np.abs(x).max()) < 2**62:
                far = np.square(fit.n * x - np.array(own, np.int64)).sum(1).tolist()
            else:
                far = [d if (d := sum((fit.n * v - s) ** 2 for v, s in zip(row, own))) < 2**63 else None for row in x.tolist()]
            z = c @ w
            cols = [
                part.column(0).take(pa.array(np.repeat(np.arange(len(x)), k))), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))), pa.array(np.full(len(x) * k, fit.n)),
                pa.array([d for d in far for _ in range(k)], pa.int64()), pa.array(z.ravel()), pa.array(np.tile(explained, len(x))), pa.array(np.full(len(x) * k, error)),
            ]
            yield pa.RecordBatch.from_arrays(cols, names)


def whiten(df: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS, scale: int = SCALE, shift: int = SHIFT, degree: int = DEGREE) -> DataFrame:
    """One row per remaining row and component: its whitened coordinate, with the fit's size and shares."""
    spark = df.sparkSession
    rows = prepared(df, id_col, vector_col, scale, shift)
    dims = V.usual_length(rows, "x")
    if dims is None:
        return spark.createDataFrame([], OUT)
    rows = rows.filter(F.size("x") == dims)
    packed = rows.select("x").distinct().mapInArrow(lambda it: _pack(it, dims, shift, BLOCK_BYTES), "block binary, width int, n long, high array<long>, low array<long>")
    blocks = C.stage(packed, "whitening-blocks")
    fit = _fit(blocks, dims, shift)
    e, q = leading(lambda m: covariance_times(blocks, fit, m), dims, min(components, dims), degree=degree)
    total = trace(blocks, fit)
    real = e > 1e-12 * max(total, 1e-300)
    if not real.any():
        return spark.createDataFrame([], OUT)
    e, q = e[real], q[:, real]
    w = q / np.sqrt(e)
    error = float(np.abs(gram(blocks, fit, w) - np.eye(len(e))).max())
    C.release(blocks)
    return rows.mapInArrow(lambda it: _whitened(it, fit, w, e / total, error), OUT)
