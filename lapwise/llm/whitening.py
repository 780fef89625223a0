"""Embedding whitening by Chebyshev-filtered subspace iteration."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapwise.llm.vector_rows import common_length, grid, usable
from lapwise.session import stored

# Columns carried beside the wanted components, passes of one filter, steps of the spectrum's
# estimate, and bytes of a block of the fit list.
GUARD = 16
DEGREE = 10
BOUND_STEPS = 8
BLOCK_BYTES = 1 << 20

# Residuals of the components, against the greatest eigenvalue: good enough to stop at once, and
# good enough to stop when they no longer fall.
FINE = 1e-14
ENOUGH = 1e-10
ROUNDS = 60

RESULT = (
    "vec_id long, component int, n long, deviation long, whitened double, explained double,"
    " identity_error double"
)


@dataclass(frozen=True)
class Whitening:
    """What the fit list says: sums are of whole numbers, components are columns."""

    n: int
    sums: tuple[int, ...]
    components: np.ndarray
    eigenvalues: np.ndarray
    trace: float
    identity_error: float


def blocks_of(size: int):
    """For `mapInArrow` over ``x``: rows packed into blocks of little-endian 64-bit numbers."""
    most = max(1, BLOCK_BYTES // (8 * size))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(0).flatten().to_numpy().reshape(-1, size)
            for begin in range(0, len(x), most):
                part = np.ascontiguousarray(x[begin : begin + most], "<i8")
                yield pa.RecordBatch.from_arrays([pa.array([part.tobytes()], pa.binary())], names=["block"])

    return pack


class FitList:
    """The distinct vectors, stored as blocks; every pass sums a small matrix over them."""

    def __init__(self, rows: DataFrame, size: int) -> None:
        self.size = size
        self.blocks = stored(
            rows.select("x").distinct().mapInArrow(blocks_of(size), "block binary"), "fit-list"
        )
        # High and low halves are summed apart, so no sum leaves its type.
        halves = self._sums(
            lambda x: np.stack([(x >> 31).sum(0), (x & 0x7FFFFFFF).sum(0), np.full(size, len(x))], 1),
            3, np.int64, "long", "decimal(38,0)",
        )
        self.n = int(halves[0][2]) if halves else 0
        self.sums = tuple(int(high) * (1 << 31) + int(low) for high, low, _ in halves)

    def _sums(self, matrix, width: int, kind, sql: str, total: str) -> list[list]:
        """The sum of ``matrix(x)`` (``width`` columns) over all blocks, row by row.

        A task adds up its blocks; Spark adds up the tasks, row by row of the matrix.
        """
        size = self.size
        names = [f"v{j}" for j in range(width)]

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held = None
            for batch in batches:
                for block in batch.column(0):
                    got = matrix(np.frombuffer(block.as_buffer(), "<i8").reshape(-1, size))
                    held = got if held is None else held + got
            if held is not None:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(len(held), dtype=np.int32))]
                    + [pa.array(np.ascontiguousarray(c, kind)) for c in held.T],
                    names=["i", *names],
                )

        parts = self.blocks.mapInArrow(add, "i int, " + ", ".join(f"{v} {sql}" for v in names))
        sums = parts.groupBy("i").agg(*[F.sum(F.col(v).cast(total)).alias(v) for v in names])
        # As many rows as a vector has entries.
        return [list(row)[1:] for row in sorted(sums.collect())]

    def centred(self):
        """A function from a block to its vectors less the mean: whole part first, exactly."""
        base = np.array([s // self.n for s in self.sums], np.int64)
        rest = np.array([(s % self.n) / self.n for s in self.sums])
        return lambda x: (x - base).astype(np.float64) - rest

    def covariance_times(self, basis: np.ndarray) -> np.ndarray:
        """``V @ basis`` by one pass over the centred vectors."""
        centre = self.centred()

        def part(x: np.ndarray) -> np.ndarray:
            c = centre(x)
            return c.T @ (c @ basis)

        sums = self._sums(part, basis.shape[1], np.float64, "double", "double")
        return np.array(sums) / self.n

    def trace(self) -> float:
        centre = self.centred()
        sums = self._sums(lambda x: (centre(x) ** 2).sum(0)[:, None], 1, np.float64, "double", "double")
        return float(np.sum(sums) / self.n)

    def identity_error(self, weights: np.ndarray) -> float:
        """Largest entry of the covariance of the vectors times ``weights``, less the identity."""
        centre = self.centred()

        def part(x: np.ndarray) -> np.ndarray:
            white = centre(x) @ weights
            return white.T @ white

        sums = np.array(self._sums(part, weights.shape[1], np.float64, "double", "double"))
        return float(np.abs(sums / self.n - np.eye(weights.shape[1])).max())


def lower_end(times, size: int, rng: np.random.Generator) -> float:
    """A value about the smallest eigenvalue or below it, by a few Lanczos steps."""
    q = rng.normal(size=(size, 1))
    basis = [q / np.linalg.norm(q)]
    diagonal, beside = [], []
    for _ in range(min(BOUND_STEPS, size)):
        image = times(basis[-1])
        diagonal.append(float((basis[-1].T @ image)[0, 0]))
        whole = np.hstack(basis)
        for _ in range(2):
            image = image - whole @ (whole.T @ image)
        beside.append(float(np.linalg.norm(image)))
        if beside[-1] <= 1e-12 * max(map(abs, diagonal)):
            break
        basis.append(image / beside[-1])
    steps = len(diagonal)
    small = np.diag(diagonal) + np.diag(beside[: steps - 1], 1) + np.diag(beside[: steps - 1], -1)
    values, vectors = np.linalg.eigh(small)
    return max(0.0, float(values[0] - beside[-1] * abs(vectors[-1, 0])))


def filtered(times, basis: np.ndarray, low: float, cut: float, top: float, degree: int) -> np.ndarray:
    """``basis`` times the Chebyshev polynomial that is small on ``[low, cut]``, scaled at ``top``.

    The three-term recurrence takes one pass over the data for each degree.
    """
    half, middle = (cut - low) / 2, (cut + low) / 2
    sigma = first = half / (top - middle)
    before, now = basis, (times(basis) - middle * basis) * (sigma / half)
    for _ in range(degree - 1):
        following = 1 / (2 / first - sigma)
        before, now = now, (
            (times(now) - middle * now) * (2 * following / half) - sigma * following * before
        )
        sigma = following
    return now


def leading(times, size: int, wanted: int, guard: int, degree: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` greatest eigenvalues, falling, and their unit vectors as columns.

    Each round filters the basis, makes it orthonormal (QR) and turns it by Rayleigh-Ritz.  It
    ends when the residuals of all wanted vectors are certified small, and when that still holds
    after a round in which fresh random columns took the guards' place, which would have
    brought up an eigenvector missed so far.
    """
    width = min(size, wanted + guard)
    rng = np.random.default_rng(seed)
    if width == size:
        basis, certain = np.eye(size), True
    else:
        basis, certain = np.linalg.qr(rng.normal(size=(size, width)))[0], False
    low = 0.0 if certain else lower_end(times, size, rng)
    past = np.inf
    for _ in range(ROUNDS):
        image = times(basis)
        small = basis.T @ image
        values, turn = np.linalg.eigh((small + small.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        basis, image = basis @ turn, image @ turn
        top = values[0]
        worst = float(np.linalg.norm(image[:, :wanted] - basis[:, :wanted] * values[:wanted], axis=0).max())
        done = top <= 0 or worst <= FINE * top or (worst <= ENOUGH * top and worst > past / 2)
        if done and certain:
            return values[:wanted], basis[:, :wanted]
        if width == size:
            # The whole space: only rounding is left.
            past = worst
            basis = np.linalg.qr(basis)[0]
            continue
        cut = max(values[-1], low + 1e-3 * (top - low))
        if done:
            certain, past = True, np.inf
            basis[:, wanted:] = rng.normal(size=(size, width - wanted)) / np.sqrt(size)
        else:
            past = worst
        basis = np.linalg.qr(filtered(times, basis, low, cut, top, degree))[0]
    raise ArithmeticError(f"no certified components after {ROUNDS} rounds; residual {worst / top:.1e}")


def fit(rows: DataFrame, size: int, components: int, guard: int = GUARD, degree: int = DEGREE, seed: int = 11) -> Whitening | None:
    """The whitening of the distinct vectors ``x``; none without rows."""
    listed = FitList(rows, size)
    if not listed.n:
        return None
    trace = listed.trace()
    if trace <= 0:
        return Whitening(listed.n, listed.sums, np.zeros((size, 0)), np.zeros(0), 0.0, 0.0)
    values, vectors = leading(
        listed.covariance_times, size, min(components, size), guard, degree, seed
    )
    real = values > size * np.finfo(float).eps * values[0]
    values, vectors = values[real], vectors[:, real]
    # Either sign will do; the largest entry is made positive, so that reruns agree.
    vectors = vectors * np.sign(vectors[np.abs(vectors).argmax(0), np.arange(vectors.shape[1])])
    error = listed.identity_error(vectors / np.sqrt(values))
    return Whitening(listed.n, listed.sums, vectors, values, trace, error)


def projected(fitted: Whitening):
    """For `mapInArrow` over ``vec_id, x``: a row for each component."""
    n, count = fitted.n, len(fitted.eigenvalues)
    base = np.array([s // n for s in fitted.sums], np.int64)
    left = [s % n for s in fitted.sums]
    rest = np.array([r / n for r in left])
    weights = fitted.components / np.sqrt(fitted.eigenvalues)
    explained = fitted.eigenvalues / fitted.trace

    def deviations(x: np.ndarray) -> pa.Array:
        """``sum((n * x - S)^2)``; null where it exceeds a long."""
        from_base = x - base
        most = n * (int(np.abs(from_base).max(initial=0)) + 1)
        if most * most * x.shape[1] < 1 << 63:
            numbers = n * from_base - np.array(left, np.int64)
            return pa.array((numbers * numbers).sum(1))
        sums = [sum((n * int(a) - r) ** 2 for a, r in zip(row, left)) for row in from_base]
        return pa.array([s if s < 1 << 63 else None for s in sums], pa.int64())

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(1).flatten().to_numpy().reshape(-1, len(base))
            white = ((x - base).astype(np.float64) - rest) @ weights
            rows = len(x)
            each = pa.array(np.repeat(np.arange(rows), count))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(each),
                    pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), rows)),
                    pa.array(np.full(rows * count, n)),
                    deviations(x).take(each),
                    pa.array(white.ravel()),
                    pa.array(np.tile(explained, rows)),
                    pa.array(np.full(rows * count, fitted.identity_error)),
                ],
                names=[c.split()[0] for c in RESULT.split(", ")],
            )

    return project


def whiten(
    vectors: DataFrame,
    components: int = 16,
    scale: int = 64,
    shift: int = 1_000_000,
    guard: int = GUARD,
    degree: int = DEGREE,
    seed: int = 11,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error``.

    Entries become whole numbers ``x = floor(scale * entry) + shift``.  Mean, covariance (divisor
    ``n``) and components come from the fit list, which holds each distinct ``x`` once; the list
    is stored as blocks, and every product of the covariance with a basis is one pass over them.
    A row of the result is a row of the input and a component, numbered by falling eigenvalue:
    ``deviation`` is the exact sum of ``(n * x - sum)^2`` over the dimensions (null where that
    exceeds a long), ``whitened`` the centred row along the component over the eigenvalue's root,
    ``explained`` the eigenvalue's share of the trace, ``identity_error`` the largest entry of
    the whitened list's covariance less the identity.

    Rows whose vector is null, empty, or holds a null or non-finite entry give no rows, nor do
    vectors of another length than the most frequent one (of equally frequent lengths, the
    greater) and entries whose ``x`` is beyond 2^62.  Null and repeated ids are rows like any
    other.  Components without variance (an eigenvalue that is zero in double precision) are left
    out, so equal vectors alone, or an empty table, give no rows.
    """
    spark = vectors.sparkSession
    rows = usable(vectors, id_col, vector_col)
    whole, inside = grid(scale, shift, (1 << 62) - abs(shift))
    rows = rows.where(inside)
    size = common_length(rows)
    rows = rows.where(F.size("vector") == size).select("vec_id", whole.alias("x"))
    fitted = fit(rows, size, components, guard, degree, seed) if size else None
    if fitted is None or not len(fitted.eigenvalues):
        return spark.createDataFrame([], RESULT)
    return rows.mapInArrow(projected(fitted), RESULT)
