"""Whitening of vectors by their leading principal components, found by Jacobi-Davidson.

The covariance is never formed.  A product with it is one pass over the stored list of
distinct vectors: tasks centre their vectors, multiply with a block of directions and sum;
partial sums meet by slot, and at most ``SLOTS`` small matrices reach the driver.  There a
block Jacobi-Davidson iteration keeps a small search space: Rayleigh-Ritz picks the leading
pairs, pairs whose residual has reached double precision are locked, and for the others the
projected correction equations are solved by a few steps of MINRES, all columns in step, so
that each step is one pass.  The start is fixed and sums are ordered, so results repeat.

An entry c becomes the whole number floor(64 * c) + 1000000.  With S the sum of n vectors,
x - S / n is taken as (x - S // n) - (S % n) / n, exact up to one rounding.

Rows whose vector is NULL or holds NULL or non-finite entries are dropped.  A shorter vector
counts as padded with entries of 0.  Repeated vectors count once in the fit; each of their
rows has its result, and so have rows without id.  Components without variance (e not above
1e-12 of the trace) are not returned, so one distinct vector, empty vectors or an empty
table give no rows.  With equal eigenvalues any basis of their space may come.  Entries
beyond 2**62, and deviations beyond 64 bits, end the job with an error.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwise.llm.components import stored
from tillwise.llm.pivot_index import usable, whole_components

SLOTS = 32
BLOCK_ROWS = 4096
OFFSET = 1_000_000


def whole_vectors(vectors: DataFrame, *, column: str = "embedding", id_column: str = "vec_id") -> DataFrame:
    """``vec_id, x array<bigint>`` of the rows that take part."""
    x = F.transform(whole_components(F.col(column)), lambda c: c + F.lit(OFFSET).cast("long"))
    return vectors.where(usable(F.col(column))).select(F.col(id_column).alias("vec_id"), x.alias("x"))


def _matrix(lists: pa.Array, width: int) -> np.ndarray:
    """Rows of whole numbers; missing entries are those of 0."""
    sizes = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    if len(sizes) and (sizes == width).all():
        return flat.reshape(len(sizes), width)
    out = np.full((len(sizes), width), OFFSET, np.int64)
    rows = np.repeat(np.arange(len(sizes)), sizes)
    out[rows, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def blocks(vectors: DataFrame, width: int) -> DataFrame:
    """The distinct vectors in stored blocks of bounded size: ``n, data``."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                rows = _matrix(batch.column(0).slice(at, BLOCK_ROWS), width)
                yield pa.RecordBatch.from_pydict(
                    {"n": pa.array([len(rows)], pa.int64()), "data": pa.array([rows.tobytes()], pa.binary())}
                )

    padded = F.concat("x", F.array_repeat(F.lit(OFFSET).cast("long"), F.lit(width) - F.size("x")))
    return stored(vectors.select(padded.alias("x")).distinct().mapInArrow(task, "n long, data binary"), "whitening")


def summed(stored_blocks: DataFrame, width: int, part: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """Sum over all blocks of what ``part`` makes of a block of vectors; zeros if there are none.

    Each task adds up its blocks; tasks of one slot meet in one group, in order.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for data in batch.column("data"):
                rows = np.frombuffer(data.as_buffer(), np.int64).reshape(-1, width)
                found = part(rows)
                total = found if total is None else total + found
        if total is not None:
            number = TaskContext.get().partitionId()
            columns = [pa.array([number % SLOTS]), pa.array([number]), pa.array([total.tobytes()], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["slot", "task", "total"])

    like = part(np.full((1, width), OFFSET, np.int64))

    def joined(key, table):
        found = np.zeros(like.shape, like.dtype)
        for row in sorted(table.select(["task", "total"]).to_pylist(), key=lambda r: r["task"]):
            found += np.frombuffer(row["total"], like.dtype).reshape(like.shape)
        return pa.table({"slot": [key[0].as_py()], "total": [found.tobytes()]})

    partial = stored_blocks.select("data").mapInArrow(task, "slot long, task long, total binary")
    rows = partial.groupBy("slot").applyInArrow(joined, "slot long, total binary").collect()
    total = np.zeros(like.shape, like.dtype)
    for row in sorted(rows, key=lambda r: r["slot"]):
        total = total + np.frombuffer(row["total"], like.dtype).reshape(like.shape)
    return total


@dataclass(frozen=True)
class Centre:
    """The mean of the fit list as whole part and rest: (whole + rest / n) in each dimension."""

    n: int
    whole: np.ndarray
    rest: np.ndarray

    @classmethod
    def of(cls, n: int, sums: np.ndarray) -> Centre:
        return cls(n, sums // max(n, 1), sums % max(n, 1))

    def centred(self, rows: np.ndarray) -> np.ndarray:
        return (rows - self.whole) - self.rest / self.n

    def deviations(self, rows: np.ndarray) -> list[int]:
        """Sum over dimensions of (n * x - S)^2, exact."""
        apart = rows - self.whole
        largest = self.n * (float(np.abs(apart).max(initial=0)) + 1)
        if apart.shape[1] * largest**2 < 2.0**62:
            return ((apart * self.n - self.rest) ** 2).sum(axis=1).tolist()
        rest = self.rest.tolist()
        return [sum((self.n * a - r) ** 2 for a, r in zip(row, rest, strict=True)) for row in apart.tolist()]


def minres(product: Callable[[np.ndarray], np.ndarray], right: np.ndarray, steps: int) -> np.ndarray:
    """Approximate solutions of symmetric systems, a column each, after ``steps`` products."""
    beta = np.linalg.norm(right, axis=0)
    safe = np.where(beta > 0, beta, 1.0)
    v, before = right / safe, np.zeros_like(right)
    x, w, w_before = (np.zeros_like(right) for _ in range(3))
    cosine, sine = -np.ones_like(beta), np.zeros_like(beta)
    d_bar, epsilon, phi_bar = np.zeros_like(beta), np.zeros_like(beta), beta.copy()
    last = np.zeros_like(beta)
    for _ in range(steps):
        p = product(v)
        alpha = (v * p).sum(axis=0)
        p = p - alpha * v - last * before
        following = np.linalg.norm(p, axis=0)
        old_epsilon = epsilon
        delta = cosine * d_bar + sine * alpha
        g_bar = sine * d_bar - cosine * alpha
        epsilon, d_bar = sine * following, -cosine * following
        gamma = np.maximum(np.hypot(g_bar, following), np.finfo(float).tiny)
        cosine, sine = g_bar / gamma, following / gamma
        phi, phi_bar = cosine * phi_bar, sine * phi_bar
        w, w_before = (v - old_epsilon * w_before - delta * w) / gamma, w
        x = x + phi * w
        before, last = v, following
        v = p / np.where(following > 0, following, 1.0)
    return x


def _orthonormal(columns: np.ndarray, against: np.ndarray) -> np.ndarray:
    """Directions of ``columns`` outside the span of ``against``; those lost to rounding go."""
    kept = np.zeros((len(columns), 0))
    for column in columns.T:
        size = np.linalg.norm(column)
        if not np.isfinite(size) or size == 0:
            continue
        column = column / size
        for _ in range(3):
            column = column - against @ (against.T @ column) - kept @ (kept.T @ column)
            length = np.linalg.norm(column)
            if length < 1e-8:
                break
            column = column / length
        else:
            kept = np.column_stack((kept, column))
    return kept


@dataclass(frozen=True)
class Params:
    components: int = 16
    #: directions in the start beyond the wanted ones, so that none of these is missed
    guard: int = 8
    minres_steps: int = 4
    #: search directions kept at most before the space is cut back to the best ones
    space: int = 96
    #: residual over the largest eigenvalue, as a multiple of machine precision and dimension
    precision: float = 4.0
    rounds: int = 200
    floor: float = 1e-12


def leading_pairs(
    product: Callable[[np.ndarray], np.ndarray], width: int, trace: float, params: Params = Params()
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Largest eigenvalues of a symmetric product, falling, with unit vectors and residuals."""
    wanted = min(params.components, width)
    start = np.random.default_rng(13).standard_normal((width, min(width, wanted + params.guard)))
    space = _orthonormal(start, np.zeros((width, 0)))
    image = product(space)
    locked, values = np.zeros((width, 0)), []
    for _ in range(params.rounds):
        small = space.T @ image
        theta, turn = np.linalg.eigh((small + small.T) / 2)
        theta, turn = theta[::-1], turn[:, ::-1]
        ritz, mapped = space @ turn, image @ turn
        residual = mapped - ritz * theta
        scale = max([*values, theta[0] if len(theta) else 0.0, np.finfo(float).tiny])
        tolerance = params.precision * np.finfo(float).eps * width * scale
        sizes = np.linalg.norm(residual, axis=0)
        full = space.shape[1] + locked.shape[1] >= width
        done = 0
        while done < len(theta) and len(values) < wanted and (full or sizes[done] <= tolerance):
            values.append(float(theta[done]))
            done += 1
        locked = np.column_stack((locked, ritz[:, :done]))
        if len(values) >= wanted or done == len(theta):
            break
        space, image, theta, residual = ritz[:, done:], mapped[:, done:], theta[done:], residual[:, done:]
        if space.shape[1] > params.space:
            keep = wanted - len(values) + params.guard
            space, image = space[:, :keep], image[:, :keep]
        aim = min(space.shape[1], wanted - len(values))
        out = np.column_stack((locked, space[:, :aim]))

        def projected(t: np.ndarray, out=out, shift=theta[:aim]) -> np.ndarray:
            t = t - out @ (out.T @ t)
            t = product(t) - t * shift
            return t - out @ (out.T @ t)

        correction = minres(projected, -(residual[:, :aim] - out @ (out.T @ residual[:, :aim])), params.minres_steps)
        fresh = _orthonormal(np.column_stack((correction, residual[:, :aim])), np.column_stack((locked, space)))
        if not fresh.shape[1]:  # nothing outside the space is left to gain
            fresh = _orthonormal(np.eye(width)[:, : params.guard], np.column_stack((locked, space)))
        space, image = np.column_stack((space, fresh)), np.column_stack((image, product(fresh)))
    else:
        raise ArithmeticError("residuals did not reach double precision")
    return _settled(product, locked, trace, params)


def _settled(product, vectors: np.ndarray, trace: float, params: Params) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One more Rayleigh-Ritz step with fresh images; signs by the largest entry; no empty components."""
    basis, _ = np.linalg.qr(vectors)
    image = product(basis)
    small = basis.T @ image
    theta, turn = np.linalg.eigh((small + small.T) / 2)
    theta, turn = theta[::-1], turn[:, ::-1]
    vectors, image = basis @ turn, image @ turn
    keep = theta > params.floor * trace
    theta, vectors, image = theta[keep], vectors[:, keep], image[:, keep]
    if not len(theta):
        return theta, vectors, theta
    signs = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(len(theta))])
    return theta, vectors * signs, np.linalg.norm(image - vectors * theta, axis=0) / theta[0]


@dataclass(frozen=True)
class Fit:
    """Centre, eigenvalues with unit vectors, trace, and how well the list is whitened."""

    centre: Centre
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float
    residual: float

    def whitened(self, rows: np.ndarray) -> np.ndarray:
        return self.centre.centred(rows) @ (self.vectors / np.sqrt(self.values))


def fit(vectors: DataFrame, params: Params = Params()) -> Fit | None:
    """Components of the distinct vectors in column ``x``; None without any variance."""
    width = vectors.agg(F.max(F.size("x"))).first()[0] or 0
    if not width:
        return None
    listed = blocks(vectors, width)
    n, sums = _counted(listed, width)
    centre = Centre.of(n, sums)

    def product(directions: np.ndarray) -> np.ndarray:
        def part(rows: np.ndarray) -> np.ndarray:
            apart = centre.centred(rows)
            return apart.T @ (apart @ directions)

        return summed(listed, width, part) / n

    trace = float(summed(listed, width, lambda rows: (centre.centred(rows) ** 2).sum(axis=0)).sum() / n)
    if trace <= 0:
        return None
    values, found, residuals = leading_pairs(product, width, trace, params)

    def moments(rows: np.ndarray) -> np.ndarray:
        projected = centre.centred(rows) @ (found / np.sqrt(values))
        return np.vstack((projected.sum(axis=0), projected.T @ projected))

    total = summed(listed, width, moments) / n
    covariance = total[1:] - np.outer(total[0], total[0])
    error = float(np.abs(covariance - np.eye(len(values))).max())
    return Fit(centre, values, found, trace, error, float(residuals.max()))


def _counted(listed: DataFrame, width: int) -> tuple[int, np.ndarray]:
    """Number of vectors and the sum of each dimension, exact."""

    def part(rows: np.ndarray) -> np.ndarray:
        # halves of 32 bits, so that no sum leaves 64 bits
        return np.vstack((np.full(width, len(rows)), (rows >> 32).sum(axis=0), (rows & 0xFFFFFFFF).sum(axis=0)))

    count, high, low = summed(listed, width, part).tolist()
    sums = np.array([(h << 32) + v for h, v in zip(high, low, strict=True)], np.int64)
    return count[0], sums


_RESULT = (
    "component int, n long, deviation long, whitened double, explained double, identity_error double, residual double"
)


def whiten(vectors: DataFrame, params: Params = Params()) -> DataFrame:
    """A row for each row of ``vectors`` (``vec_id, x``) and component, from 1 on."""
    found = fit(vectors, params)
    id_type = vectors.schema["vec_id"].dataType.simpleString()
    schema = f"vec_id {id_type}, {_RESULT}"
    if found is None or not len(found.values):
        return vectors.sparkSession.createDataFrame([], schema)
    width, count = found.vectors.shape
    explained = found.values / found.trace
    names = ["vec_id", *(f.split()[0] for f in _RESULT.split(", "))]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, BLOCK_ROWS):
                batch = whole.slice(at, BLOCK_ROWS)
                rows = _matrix(batch.column("x"), width)
                size = len(rows)
                columns = [
                    batch.column("vec_id").take(pa.array(np.repeat(np.arange(size), count))),
                    pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), size)),
                    pa.array(np.full(size * count, found.centre.n)),
                    pa.array(np.repeat(np.array(found.centre.deviations(rows), np.int64), count)),
                    pa.array(found.whitened(rows).ravel()),
                    pa.array(np.tile(explained, size)),
                    pa.array(np.full(size * count, found.identity_error)),
                    pa.array(np.full(size * count, found.residual)),
                ]
                yield pa.RecordBatch.from_arrays(columns, names)

    return vectors.select("vec_id", "x").mapInArrow(task, schema)
