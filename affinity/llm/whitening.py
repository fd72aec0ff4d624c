"""Whitening of embeddings on their leading components, by Chebyshev-filtered subspace iteration.

Entries become whole numbers; the components are the leading eigenvectors of the covariance V of the
distinct vectors, and no pass over them holds more than a block of d x ``BLOCK`` sums.

* **Passes.** V Q is the sum of x (x'Q) over the centred vectors x, added up per task, then on the
  executors; d x ``BLOCK`` numbers come to the driver. Centring is by whole numbers, (n x - S) / n.
* **Bounds.** A few Lanczos steps enclose the spectrum from below: the smallest Ritz value less the
  last coupling, zero at least.
* **Filter.** The block goes through a Chebyshev polynomial of V that stays within one on the
  unwanted part of the spectrum, from that bound to the block's smallest Ritz value, and grows fastest
  beyond. Its three-term recurrence takes a pass per degree; the degree follows the gap.
* **Rayleigh-Ritz.** QR, the block's small eigenproblem and the residuals |V q - e q| of the wanted
  pairs, which bound the errors of their eigenvalues.
* **Certified** is a block whose residuals are at rounding level: no larger than ``ROUNDING`` of the
  largest eigenvalue, or below ``NEAR`` of it and no longer halved by a cycle.

Defined cases: rows whose vector is null or has null, infinite or not-a-number entries are dropped.
Rows without an id are kept, repeated rows are kept each and counted once in the fit. Entries beyond the range of
long are its ends. A deviation that no long holds is null; ``deviation_digits`` has it as text in any case.
Where the vectors span fewer components, those without variance have null in ``whitened``, and where
all are equal ``explained`` and ``identity_error`` are null, too. Vectors of different lengths are
refused. Empty tables, and vectors without entries, give no rows. Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from affinity.llm.stage import written

SCALE, COMPONENTS, BLOCK = 256, 4, 16
LANCZOS_STEPS = 10
#: What a cycle of the filter should gain, and the degrees it may take for that.
GAIN, DEGREES, CYCLES = 1e5, (4, 40), 500
ROUNDING, NEAR = 4e-15, 1e-9
#: Entries that are worked on at a time in a task, and the largest sum that is left to 64 bits.
ENTRIES, SAFE = 1 << 20, 1 << 62


@dataclass
class Fit:
    """The distinct vectors (written, ``x``), their number, exact sums and length."""

    vectors: DataFrame
    n: int
    sums: list[int]


@dataclass
class Whitening:
    """Components as columns by falling eigenvalue, and what certifies them."""

    components: np.ndarray
    values: np.ndarray
    trace: float
    residuals: np.ndarray
    identity_error: float | None
    passes: int


def grid(embeddings: DataFrame) -> DataFrame:
    """``vec_id, x`` of the rows whose entries are all finite: floor of 256 times each entry."""
    entries = F.col("embedding").cast("array<double>")
    finite = F.forall(entries, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < math.inf))
    return embeddings.where(F.col("embedding").isNotNull() & finite).select(
        "vec_id", F.transform(entries, lambda c: F.floor(c * F.lit(float(SCALE)))).alias("x"))


def _blocks(batch: pa.RecordBatch, d: int) -> Iterator[tuple[int, np.ndarray]]:
    """First row and whole-number entries of successive parts of a batch."""
    rows = max(1, ENTRIES // d)
    for at in range(0, batch.num_rows, rows):
        column = batch.column("x")[at:at + rows]
        yield at, column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), d)


def deviations(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n x - S, in 64 bits where these hold it and as Python's numbers otherwise."""
    most = max(int(x.max(initial=0)), -int(x.min(initial=0)))
    if n * most + max(map(abs, sums)) < SAFE:
        return x * np.int64(n) - np.array(sums, np.int64)
    return x.astype(object) * n - np.array(sums, object)


def _sums(vectors: DataFrame, d: int) -> list[int]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [0] * d
        for batch in batches:
            for _, x in _blocks(batch, d):
                small = len(x) * max(int(x.max(initial=0)), -int(x.min(initial=0))) < SAFE
                total = [t + int(s) for t, s in zip(total, x.sum(0) if small else x.astype(object).sum(0), strict=True)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(d), pa.int32()), pa.array([Decimal(t) for t in total], pa.decimal128(38, 0))], ["pos", "total"])

    rows = vectors.mapInArrow(run, "pos int, total decimal(38, 0)").groupBy("pos").agg(F.sum("total").alias("total"))
    return [int(r.total) for r in rows.orderBy("pos").collect()]


def fit(vectors: DataFrame) -> Fit:
    """The fit of the distinct vectors ``x``."""
    distinct = written(vectors.select("x").distinct())
    n, least, most = distinct.agg(F.count("*"), F.min(F.size("x")), F.max(F.size("x"))).first()
    if least != most:
        raise ValueError(f"vectors of different lengths, {least} to {most}")
    return Fit(distinct, n, _sums(distinct, most) if n and most else [])


def _summed(given: Fit, part: Callable[[np.ndarray], np.ndarray], size: int) -> np.ndarray:
    """Sum of ``part`` (``size`` numbers) over blocks of the centred vectors."""
    n, sums = given.n, given.sums

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            for _, x in _blocks(batch, len(sums)):
                total += part(deviations(x, n, sums).astype(np.float64) / n).ravel()
        yield pa.RecordBatch.from_arrays([pa.array(range(size), pa.int32()), pa.array(total)], ["pos", "total"])

    rows = given.vectors.mapInArrow(run, "pos int, total double").groupBy("pos").agg(F.sum("total").alias("total"))
    out = np.zeros(size)
    for pos, total in rows.collect():
        out[pos] = total
    return out


class _Operator:
    """V as an operator on blocks, one pass over the vectors each."""

    def __init__(self, given: Fit) -> None:
        self.given, self.d, self.passes = given, len(given.sums), 0

    def __call__(self, q: np.ndarray) -> np.ndarray:
        self.passes += 1
        return _summed(self.given, lambda x: x.T @ (x @ q), q.size).reshape(q.shape) / self.given.n


def lower_bound(apply: Callable[[np.ndarray], np.ndarray], d: int, rng: np.random.Generator) -> float:
    """A bound below the spectrum, from a few Lanczos steps with all vectors kept orthogonal."""
    basis = [rng.standard_normal(d)]
    basis[0] /= np.linalg.norm(basis[0])
    diagonal, coupling = [], []
    for _ in range(min(d, LANCZOS_STEPS)):
        v = apply(basis[-1][:, None])[:, 0]
        diagonal.append(basis[-1] @ v)
        for _ in range(2):
            v = v - np.array(basis).T @ (np.array(basis) @ v)
        coupling.append(np.linalg.norm(v))
        if coupling[-1] <= 1e-12 * max(diagonal):
            break
        basis.append(v / coupling[-1])
    inner = coupling[:len(diagonal) - 1]
    ritz = np.linalg.eigvalsh(np.diag(diagonal) + np.diag(inner, 1) + np.diag(inner, -1))
    return max(0.0, float(ritz[0] - coupling[-1]))


def chebyshev(apply: Callable[[np.ndarray], np.ndarray], q: np.ndarray, degree: int, low: float, high: float,
              top: float) -> np.ndarray:
    """The block after a polynomial that is small on [low, high], scaled to about one at ``top``."""
    half, middle = (high - low) / 2, (high + low) / 2
    scale = half / (top - middle)
    turn = 2 / scale
    before, now = q, (apply(q) - middle * q) * (scale / half)
    for _ in range(degree - 1):
        following = 1 / (turn - scale)
        before, now = now, 2 * following / half * (apply(now) - middle * now) - scale * following * before
        scale = following
    return now


def ritz_pairs(apply: Callable[[np.ndarray], np.ndarray], block: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ritz values by falling size, their vectors, and the norms of the residuals."""
    q, _ = np.linalg.qr(block)
    v = apply(q)
    small = q.T @ v
    values, turn = np.linalg.eigh((small + small.T) / 2)
    values, turn = values[::-1], turn[:, ::-1]
    vectors = q @ turn
    return values, vectors, np.linalg.norm(v @ turn - vectors * values, axis=0)


def leading(apply: Callable[[np.ndarray], np.ndarray], d: int, wanted: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ``wanted`` leading eigenvalues, their vectors and residuals, once certified."""
    rng = np.random.default_rng(11)
    if d <= BLOCK:  # the block is the whole space
        values, vectors, residuals = ritz_pairs(apply, np.eye(d))
        return values[:wanted], vectors[:, :wanted], residuals[:wanted]
    low = lower_bound(apply, d, rng)
    values, block, residuals = ritz_pairs(apply, rng.standard_normal((d, BLOCK)))
    worst = math.inf
    for _ in range(CYCLES):
        top, now = values[0], residuals[:wanted].max()
        if now <= ROUNDING * top or (worst <= NEAR * top and now > worst / 2):
            return values[:wanted], block[:, :wanted], residuals[:wanted]
        worst = now
        width = top - low
        high = min(max(values[-1], low + 1e-3 * width), low + 0.999 * width)
        beyond = 2 * (values[wanted - 1] - low) / (high - low) - 1
        degree = math.ceil(math.log(2 * GAIN) / math.acosh(max(beyond, 1 + 1e-6)))
        degree = min(max(degree, DEGREES[0]), DEGREES[1])
        values, block, residuals = ritz_pairs(apply, chebyshev(apply, block, degree, low, high, top))
    raise RuntimeError(f"components not certified: residual {worst:g} of {values[0]:g} after {CYCLES} cycles")


def solve(given: Fit, wanted: int = COMPONENTS) -> Whitening:
    """Leading components of the fit, the sign of each such that its largest entry is positive."""
    apply, d = _Operator(given), len(given.sums)
    wanted = min(wanted, d)
    trace = float(_summed(given, lambda x: (x * x).sum(0), d).sum()) / given.n
    if trace == 0:
        return Whitening(np.eye(d)[:, :wanted], np.zeros(wanted), 0.0, np.zeros(wanted), None, 1)
    values, vectors, residuals = leading(apply, d, wanted)
    values = np.where(values > 1e-13 * trace, values, 0.0)
    vectors = vectors * np.sign(vectors[np.abs(vectors).argmax(0), np.arange(wanted)])
    some = vectors[:, values > 0] / np.sqrt(values[values > 0])
    k = some.shape[1]

    def moments(x: np.ndarray) -> np.ndarray:
        w = x @ some
        return np.concatenate([w.sum(0), (w.T @ w).ravel()])

    total = _summed(given, moments, k + k * k) / given.n
    covariance = total[k:].reshape(k, k) - np.outer(total[:k], total[:k])
    return Whitening(vectors, values, trace, residuals, float(np.abs(covariance - np.eye(k)).max()), apply.passes + 2)


def whiten(embeddings: DataFrame) -> DataFrame:
    """One row per vector and component up to ``COMPONENTS``, see the contract's columns."""
    fields = T.StructType([
        T.StructField("vec_id", embeddings.schema["vec_id"].dataType), T.StructField("component", T.IntegerType()),
        T.StructField("n", T.LongType()), T.StructField("deviation", T.LongType()),
        T.StructField("whitened", T.DoubleType()), T.StructField("explained", T.DoubleType()),
        T.StructField("identity_error", T.DoubleType()), T.StructField("deviation_digits", T.StringType())])
    points = grid(embeddings)
    given = fit(points)
    if not given.n or not given.sums:
        return embeddings.sparkSession.createDataFrame([], fields)
    found = solve(given)
    n, sums, k = given.n, given.sums, len(found.values)
    scaled = found.components / np.where(found.values > 0, np.sqrt(found.values), np.nan)
    explained = [v / found.trace if found.trace else None for v in found.values.tolist()]
    error = found.identity_error

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, x in _blocks(batch, len(sums)):
                away = deviations(x, n, sums)
                inexact = away.astype(np.float64)
                if (inexact * inexact).sum(1).max(initial=0.0) < SAFE:
                    exact = (away * away).sum(1).tolist()
                else:
                    exact = [sum(int(v) ** 2 for v in row) for row in away.tolist()]
                whitened = (inexact / n) @ scaled
                rows = len(x)
                ids = batch.column("vec_id")[at:at + rows].take(pa.array(np.repeat(np.arange(rows), k)))
                yield pa.RecordBatch.from_arrays([
                    ids, pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows)),
                    pa.array(np.full(rows * k, n)),
                    pa.array([v if v < 1 << 63 else None for v in exact for _ in range(k)], pa.int64()),
                    pa.array(whitened.ravel(), mask=np.isnan(whitened).ravel()),
                    pa.array(explained * rows, pa.float64()), pa.array([error] * (rows * k), pa.float64()),
                    pa.array([str(v) for v in exact for _ in range(k)])], fields.names)

    return points.mapInArrow(run, fields)
