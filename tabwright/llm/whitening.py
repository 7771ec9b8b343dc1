"""Whitening of embeddings by Chebyshev-filtered subspace iteration over distributed passes.

Entries become integers x = floor(64 c) + 1,000,000. The fit list holds each distinct
x vector once; it is stored as packed blocks. One pass over it gives n, the sums S and
the trace of the covariance, all in whole numbers; every later pass gives V Q for a thin
matrix Q: each task centres its blocks exactly, (n x - S) / n, multiplies to Y'(YQ), and
the d-by-q partial products are added in two levels, so that the driver receives one.

1. Lanczos steps on one vector bound the spectrum from below.
2. A block of ``2 * components`` vectors is filtered: a Chebyshev polynomial of V, by its
   three-term recurrence with one pass per degree, stays small on the unwanted part of
   the spectrum, from that bound to the least Ritz value, and grows above it.
3. QR makes the block orthonormal and a Rayleigh-Ritz step, one pass more, turns it to
   Ritz vectors. Residuals certify them: the iteration ends when every wanted residual
   is below ``RESIDUAL`` of the largest eigenvalue, or once they are below ``ENOUGH``
   and no longer shrink (rounding); beyond ``MOST_ROUNDS`` it raises.

Where the block spans the whole space, Rayleigh-Ritz is exact and no filter is needed.
Sums of doubles depend on how the fit list fell into tasks and blocks, and beyond 64
tasks on the order in which partial sums arrive: runs agree up to rounding. Counts,
sums and deviations are whole numbers and the same in every run.

Cases. Vectors that are null, or hold null or non-finite entries, are dropped, and so
are empty ones and those of another length than most (ties: the longer). Null and
repeated ids are rows like others. Components whose eigenvalue is below ``FLAT`` of the
trace (no variance, as with a single distinct vector) are left out, having no whitened
value. A ``deviation`` beyond a long is null. An empty table gives no rows. Columns
besides vec_id and embedding are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwright.lineage import stored
from tabwright.llm.tables import map_arrow

#: How entries become integers.
SCALE, SHIFT = 64, 1_000_000

COMPONENTS = 16
DEGREE = 10
LANCZOS = 12
RESIDUAL = 2e-14
ENOUGH = 1e-10
FLAT = 1e-13
MOST_ROUNDS = 100
#: Vectors of a packed block hold so many entries at most.
BLOCK_ENTRIES = 1 << 19
_LONG = 1 << 63


def integer_vectors(embeddings: DataFrame, length: int | None = None) -> DataFrame:
    """vec_id and x of rows whose vector is whole and finite (and of ``length`` entries)."""
    wide = F.col("embedding").cast("array<double>")
    whole = F.forall(wide, lambda e: F.coalesce(~F.isnan(e) & (F.abs(e) < float("inf")), F.lit(False)))
    rows = embeddings.select("vec_id", "embedding").filter(F.col("embedding").isNotNull() & (F.size("embedding") > 0) & whole)
    if length is not None:
        rows = rows.filter(F.size("embedding") == length)
    return rows.select("vec_id", F.transform(wide, lambda e: F.floor(e * SCALE) + SHIFT).alias("x"))


def usual_length(vectors: DataFrame) -> int:
    """The length of most vectors; 0 without any."""
    found = vectors.groupBy(F.size("x").alias("length")).count().orderBy(F.desc("count"), F.desc("length")).first()
    return found["length"] if found else 0


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def packed(vectors: DataFrame, d: int) -> DataFrame:
    """Each distinct x once, in blocks of packed longs."""
    most = max(1, BLOCK_ENTRIES // d)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def flush() -> pa.RecordBatch:
            whole = np.concatenate(held)
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array([whole.tobytes()], pa.binary())], names=["rows"])

        for batch in batches:
            held.append(_matrix(batch.column("x"), d))
            if sum(len(h) for h in held) >= most:
                yield flush()
        if held:
            yield flush()

    return stored(map_arrow(vectors.select("x").distinct(), run, "rows binary"), "whitening-fit-list")


def _added(blocks: DataFrame, each: Callable[[np.ndarray], np.ndarray | list[int]], d: int, exact: bool) -> np.ndarray | list[int]:
    """The sum of ``each`` block's numbers: per task, then over groups of tasks, then of those."""
    kind = "array<string>" if exact else "array<double>"
    arrow = pa.list_(pa.string() if exact else pa.float64())

    def total(parts: list) -> list:
        if exact:
            return [str(sum(int(v) for v in column)) for column in zip(*parts)]
        return np.sum(np.array(parts), axis=0).tolist()

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = None
        for batch in batches:
            for rows in batch.column("rows"):
                x = np.frombuffer(rows.as_buffer(), np.int64).reshape(-1, d)
                found = each(x)
                sums = found if sums is None else [a + b for a, b in zip(sums, found)] if exact else sums + found
        if sums is not None:
            sums = [str(v) for v in sums] if exact else sums.ravel().tolist()
            yield pa.RecordBatch.from_arrays([pa.array([sums], arrow)], names=["sums"])

    def second(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = None
        for batch in batches:
            for row in batch.column("sums").to_pylist():
                sums = row if sums is None else total([sums, row])
        if sums is not None:
            yield pa.RecordBatch.from_arrays([pa.array([sums], arrow)], names=["sums"])

    parts = map_arrow(blocks, first, f"sums {kind}")
    tasks = blocks.rdd.getNumPartitions()
    if tasks > 64:
        parts = map_arrow(parts.repartition(isqrt(tasks)), second, f"sums {kind}")
    found = sorted(r["sums"] for r in parts.collect())  # at most 64 rows, or a root of the tasks
    if exact:
        return [int(v) for v in total(found)]
    return np.array(total(found))


class FitList:
    """The stored fit list with n, S and the trace of the covariance, and passes over it."""

    def __init__(self, blocks: DataFrame, d: int):
        self.blocks, self.d, self.passes = blocks, d, 0

        def sums(x: np.ndarray) -> list[int]:
            wide = x if _fits(x, len(x)) else x.astype(object)
            return [len(x), *(int(v) for v in wide.sum(axis=0))]

        self.n, *self.sums = _added(blocks, sums, d, exact=True)
        n, s = self.n, self.sums

        def squares(x: np.ndarray) -> list[int]:
            return [sum(deviations(x, n, s))]

        self.trace = _added(blocks, squares, d, exact=True)[0] / n**3

    def times(self, q: np.ndarray) -> np.ndarray:
        """V Q in one pass."""
        n, s, d = self.n, self.sums, self.d

        def product(x: np.ndarray) -> np.ndarray:
            y = centred(x, n, s)
            return y.T @ (y @ q)

        self.passes += 1
        return _added(self.blocks, product, d, exact=False).reshape(q.shape) / n


def _fits(x: np.ndarray, n: int) -> bool:
    """Whether n times the entries, less a sum of n of them, stay in a long."""
    return not x.size or int(max(abs(int(x.min())), abs(int(x.max())))) * 2 * n < _LONG


def differences(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n x - S, exactly: longs, or Python integers where those do not fit."""
    small = _fits(x, n) and all(abs(v) < _LONG >> 1 for v in sums)
    kind = np.int64 if small else object
    return x.astype(kind) * n - np.array(sums, dtype=kind)


def centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """x - S / n as doubles, rounded once."""
    return (differences(x, n, sums) / n).astype(np.float64)


def deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int]:
    """Per row, the exact sum of squares of n x - S."""
    gap = differences(x, n, sums)
    if gap.dtype == object or (gap.size and int(np.abs(gap).max()) ** 2 * gap.shape[1] >= _LONG):
        gap = gap.astype(object)
    return [int(v) for v in (gap * gap).sum(axis=1)]


def least_bound(fit: FitList) -> float:
    """A lower end of the spectrum by Lanczos steps with full orthogonalisation, less its residual."""
    q = np.random.default_rng(1).standard_normal((fit.d, 1))
    basis, alphas, betas = [q / np.linalg.norm(q)], [], []
    for _ in range(min(LANCZOS, fit.d)):
        w = fit.times(basis[-1])
        alphas.append(float((basis[-1] * w).sum()))
        for _ in range(2):
            for b in basis:
                w = w - b * float((b * w).sum())
        betas.append(float(np.linalg.norm(w)))
        if betas[-1] <= 1e-12 * abs(alphas[0]):
            break
        basis.append(w / betas[-1])
    inner = betas[: len(alphas) - 1]
    values, vectors = np.linalg.eigh(np.diag(alphas) + np.diag(inner, 1) + np.diag(inner, -1))
    return max(0.0, float(values[0] - betas[-1] * abs(vectors[-1, 0])))


def filtered(fit: FitList, q: np.ndarray, low: float, high: float, top: float) -> np.ndarray:
    """The scaled Chebyshev polynomial of V, small on [low, high] and one at ``top``, applied to Q."""
    half, middle = (high - low) / 2, (high + low) / 2
    sigma = first = half / (top - middle)
    before, now = q, (fit.times(q) - middle * q) * (sigma / half)
    for _ in range(DEGREE - 1):
        following = 1 / (2 / first - sigma)
        before, now = now, 2 * following / half * (fit.times(now) - middle * now) - sigma * following * before
        sigma = following
    return now


def components(fit: FitList, k: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors of the covariance, certified by their residuals."""
    d = fit.d
    k = min(k, d)
    if fit.trace == 0:
        return np.zeros(0), np.zeros((d, 0))
    width = min(d, 2 * k)
    q = np.eye(d) if width == d else np.linalg.qr(np.random.default_rng(0).standard_normal((d, width)))[0]
    low = 0.0 if width == d else least_bound(fit)
    worst = np.inf
    for _ in range(MOST_ROUNDS):
        image = fit.times(q)
        inner = q.T @ image
        values, turn = np.linalg.eigh((inner + inner.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        q, image = q @ turn, image @ turn
        residual = float(np.linalg.norm(image[:, :k] - q[:, :k] * values[:k], axis=0).max()) / values[0]
        done = residual <= RESIDUAL or (residual <= ENOUGH and residual > worst / 2)
        if done or width == d:
            keep = values[:k] > FLAT * fit.trace
            return values[:k][keep], np.linalg.qr(q)[0][:, :k][:, keep] * np.sign(np.diag(np.linalg.qr(q)[1]))[:k][keep]
        worst = residual
        high, top = float(values[-1]), float(values[0])
        if high <= FLAT * fit.trace:  # the rest of the space is flat: one plain step removes it
            q = np.linalg.qr(image)[0]
            continue
        q = np.linalg.qr(filtered(fit, q, min(low, high * 0.999), high, top))[0]
    raise ArithmeticError(f"residual {residual:.1e} after {MOST_ROUNDS} rounds")


def whitened(embeddings: DataFrame, k: int = COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error: one row per vector and component."""
    key = embeddings.schema["vec_id"].dataType.simpleString()
    schema = f"vec_id {key}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    d = usual_length(integer_vectors(embeddings))
    if not d:
        return embeddings.sparkSession.createDataFrame([], schema)
    vectors = integer_vectors(embeddings, d)
    fit = FitList(packed(vectors, d), d)
    values, basis = components(fit, k)
    scaled = basis / np.sqrt(values)
    error = 0.0
    if len(values):
        error = float(np.abs(scaled.T @ fit.times(scaled) - np.eye(len(values))).max())
    n, sums, share, m = fit.n, fit.sums, values / (fit.trace or 1.0), len(values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not m or not batch.num_rows:
                continue
            x = _matrix(batch.column("x"), d)
            rows = len(x)
            squares = pa.array([v if v < _LONG else None for v in deviations(x, n, sums)], pa.int64())
            at = pa.array(np.repeat(np.arange(rows), m))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id").take(at), pa.array(np.tile(np.arange(1, m + 1, dtype=np.int32), rows)),
                    pa.array(np.full(rows * m, n, np.int64)), squares.take(at), pa.array((centred(x, n, sums) @ scaled).ravel()),
                    pa.array(np.tile(share, rows)), pa.array(np.full(rows * m, error)),
                ],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return map_arrow(vectors, run, schema)
