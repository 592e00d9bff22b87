"""Whitening by the leading eigenvectors of a covariance, found with Jacobi-Davidson.

The fit list is each distinct integer vector x once. Its covariance V is never formed: V times a block of
vectors is one Spark job over the fit list, in which every task centres its rows and gives the sums of
(x - mean) ((x - mean) . b), one row of sums for each b. Only blocks of as many numbers as a vector has entries, times
the components, ever reach the driver.

The eigenpairs come from a search space that grows. Rayleigh-Ritz in it gives the approximations; those whose
residual |V u - e u| is as small as double precision allows are locked, leading ones first. For each of the
others the correction equation (1 - U U') (V - e) (1 - U U') t = -r, with U all approximations and locked
vectors, is solved roughly by a few steps of MINRES, all right hand sides in step, so that an inner step is one job
too. The corrections extend the search space; beyond its largest size it shrinks to the best approximations. What is
locked is checked again with a fresh product at the end.

Defined cases: a row with a null vector, or null or non-finite entries, takes no part (the others keep their rows even
if their id is null or repeated); of vectors of different lengths only those of the commonest length do, of
equally common ones the shorter; a component without variance (one distinct vector, constant or dependent
entries) is left out, so there may be fewer of them, or no rows at all; entries are cut to 2^52 either way; a
``deviation`` beyond a long is null. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlume.llm.graph import stored
from postlume.llm.vectors import finite, matrices

EPS = float(np.finfo(np.float64).eps)
_ROWS = 4096


# -- the eigenproblem, for any symmetric operator given by its products ---------------------

def orthonormal(block: np.ndarray, against: np.ndarray) -> np.ndarray:
    """An orthonormal basis of what ``block`` adds to the orthonormal columns ``against``."""
    kept = against
    for i in range(block.shape[1]):
        v = block[:, i]
        size = np.linalg.norm(v)
        if not size or not np.isfinite(size):
            continue
        v = v / size
        for _ in range(3):
            v = v - kept @ (kept.T @ v)
            left = np.linalg.norm(v)
            if left < 1e-10:
                break
            v = v / left
        else:
            kept = np.column_stack([kept, v])
    return kept[:, against.shape[1]:]


def minres(apply: Callable[[np.ndarray], np.ndarray], b: np.ndarray, steps: int) -> np.ndarray:
    """A few steps of MINRES for each column of ``b``, all in step; ``apply`` takes and gives a block."""
    n, m = b.shape
    x, zero = np.zeros((n, m)), np.zeros(m)
    size = np.linalg.norm(b, axis=0)
    v_old, v = np.zeros((n, m)), b / np.where(size > 0, size, 1)
    beta, rest = zero, size.copy()
    c_old, c, s_old, s = np.ones(m), np.ones(m), zero, zero
    d_old, d = np.zeros((n, m)), np.zeros((n, m))
    alive = size > 0
    for _ in range(steps):
        p = apply(v) - v_old * beta
        alpha = (v * p).sum(axis=0)
        p = p - v * alpha
        beta_next = np.linalg.norm(p, axis=0)
        # The new column of the tridiagonal matrix, under the rotations of the last two steps.
        third = s_old * beta
        second = c * c_old * beta + s * alpha
        first = c * alpha - s * c_old * beta
        radius = np.hypot(first, beta_next)
        alive = alive & (radius > 0)
        safe = np.where(alive, radius, 1)
        c_new, s_new = np.where(alive, first / safe, 1), np.where(alive, beta_next / safe, 0)
        d_old, d = d, (v - d_old * third - d * second) / safe
        x = x + np.where(alive, c_new * rest, 0) * d
        rest = -s_new * rest
        alive = alive & (beta_next > EPS * np.abs(alpha))
        v_old, v = v, np.where(alive, p / np.where(beta_next > 0, beta_next, 1), 0)
        beta, c_old, c, s_old, s = beta_next, c, c_new, s, s_new
        if not alive.any():
            break
    return x


def leading_eigenpairs(product: Callable[[np.ndarray], np.ndarray], size: int, wanted: int, inner: int = 4,
                       rounds: int = 300, seed: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues, falling, and their eigenvectors as columns, with residuals of at most
    8 * size * eps times the largest eigenvalue. ``product`` gives V times a block."""
    wanted = min(wanted, size)
    largest, keep = min(size, 4 * wanted + 16), min(size, wanted + wanted // 2 + 4)
    small = 8 * size * EPS
    locked, values = np.zeros((size, 0)), np.zeros(0)
    rng = np.random.default_rng(seed)
    space = orthonormal(rng.standard_normal((size, min(size, wanted + 4))), locked)
    image = product(space)
    for _ in range(rounds):
        inside = space.T @ image
        ritz, turn = np.linalg.eigh((inside + inside.T) / 2)
        ritz, turn = ritz[::-1], turn[:, ::-1]
        space, image = space @ turn, image @ turn
        need = wanted - len(values)
        u, e = space[:, :need], ritz[:need]
        residual = image[:, :need] - u * e
        residual -= locked @ (locked.T @ residual)
        scale = max([abs(x) for x in (*values, *ritz)], default=0.0)
        good = np.linalg.norm(residual, axis=0) <= small * scale
        done = need if good.all() else int(np.argmin(good))
        if done:
            locked, values = np.column_stack([locked, u[:, :done]]), np.append(values, e[:done])
            space, image, residual, ritz = space[:, done:], image[:, done:], residual[:, done:], ritz[done:]
            u, e = u[:, done:], e[done:]
        if len(values) == wanted:
            # Once more by fresh products, of what is locked and of all that is left of the space.
            whole = orthonormal(np.column_stack([locked, space]), np.zeros((size, 0)))
            fresh = product(whole)
            inside = whole.T @ fresh
            values, turn = np.linalg.eigh((inside + inside.T) / 2)
            values, turn = values[::-1], turn[:, ::-1]
            whole, fresh = whole @ turn, fresh @ turn
            left = np.linalg.norm(fresh - whole * values, axis=0)[:wanted]
            if (left <= small * max(np.abs(values))).all():
                return values[:wanted], whole[:, :wanted]
            locked, values, space, image = np.zeros((size, 0)), np.zeros(0), whole, fresh
            if space.shape[1] == size:
                continue
            u, e, residual = space[:, :wanted], values[:wanted], (fresh - whole * values)[:, :wanted]
        basis = np.column_stack([locked, space])
        if basis.shape[1] == size:
            image = product(space)  # the whole space: what is left is rounding in the kept images
            continue
        near = np.column_stack([locked, u])

        def project(block: np.ndarray) -> np.ndarray:
            return block - near @ (near.T @ block)

        shift = e
        correction = minres(lambda z: project(product(project(z)) - project(z) * shift), -project(residual), inner)
        if space.shape[1] + correction.shape[1] > largest:
            space, image = space[:, :keep], image[:, :keep]
            basis = np.column_stack([locked, space])
        new = orthonormal(correction, basis)
        if not new.shape[1]:
            new = orthonormal(rng.standard_normal((size, 1)), basis)
        space, image = np.column_stack([space, new]), np.column_stack([image, product(new)])
    raise RuntimeError(f"no convergence in {rounds} rounds; {len(values)} of {wanted} eigenpairs are found")


# -- the fit over Spark ---------------------------------------------------------------------

@dataclass(frozen=True)
class Whitening:
    """``values`` fall; the columns of ``vectors`` are their unit eigenvectors."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float

    def deviations(self, x: np.ndarray) -> np.ndarray:
        """n * x - sums for each row, as exact integers: int64 where they and their sum of squares fit."""
        floor = [s // self.n for s in self.sums]
        rest = [s - self.n * f for s, f in zip(self.sums, floor)]
        shifted = x - np.array(floor, np.int64)
        most = (int(np.abs(shifted).max(initial=0)) + 1) * self.n
        if most * most * max(1, x.shape[1]) < 1 << 63:
            return shifted * self.n - np.array(rest, np.int64)
        return shifted.astype(object) * self.n - np.array(rest, object)

    def centred(self, x: np.ndarray) -> np.ndarray:
        return self.deviations(x).astype(np.float64) / self.n


def grid(vector: Column, scale: int, offset: int) -> Column:
    """floor(scale * entry) + offset for each entry; null unless all entries are numbers."""
    cut = float(1 << 52)
    whole = F.transform(vector, lambda x: F.floor(F.greatest(F.least(x.cast("double") * scale, F.lit(cut)), F.lit(-cut))) + offset)
    return F.when(finite(vector), whole)


def _sums(fit: DataFrame, task: Callable[[Iterator[np.ndarray]], np.ndarray], size: int) -> np.ndarray:
    """The sum over all tasks of the matrix (k x size) that ``task`` makes of the rows it reads."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def pieces():
            for batch in batches:
                for _, matrix in matrices(batch.column("x")):
                    for at in range(0, len(matrix), _ROWS):
                        yield matrix[at:at + _ROWS]

        total = task(pieces())
        yield pa.record_batch([pa.array(np.arange(len(total))), *(pa.array(c) for c in total.T)], names)

    names = ["k", *(f"c{i}" for i in range(size))]
    parts = fit.select("x").mapInArrow(rows, ", ".join(["k long", *(f"{c} double" for c in names[1:])]))
    summed = parts.groupBy("k").agg(*[F.sum(c).alias(c) for c in names[1:]]).collect()
    out = np.zeros((len(summed), size))
    for r in summed:
        out[r["k"]] = r[1:]
    return out


def _halves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of the upper and the lower bits of each entry, which stay exact, and the number of rows."""
    high, low, n = 0, 0, 0
    for batch in batches:
        for _, matrix in matrices(batch.column("x")):
            high, low, n = high + (matrix >> 26).sum(axis=0), low + (matrix & ((1 << 26) - 1)).sum(axis=0), n + len(matrix)
    if n:
        yield pa.record_batch([pa.array(np.arange(len(high))), pa.array(high), pa.array(low),
                               pa.array(np.full(len(high), n))], ["i", "high", "low", "n"])


def fit_whitening(rows: DataFrame, x: str = "x", components: int = 16) -> Whitening | None:
    """The whitening of the distinct integer vectors in column ``x``, all of one length; None if there is none."""
    fit = stored(rows.select(F.col(x).cast("array<long>").alias("x")).where("x IS NOT NULL").distinct())
    total = fit.mapInArrow(_halves, "i long, high long, low long, n long").groupBy("i").agg(
        *[F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("high", "low", "n")]).orderBy("i").collect()
    if not total:
        return None
    size, n = len(total), int(total[0]["n"])
    empty = Whitening(n, [(int(r["high"]) << 26) + int(r["low"]) for r in total], np.zeros(0), np.zeros((size, 0)), 0.0, 0.0)

    def product(block: np.ndarray) -> np.ndarray:
        def task(pieces):
            out = np.zeros((block.shape[1], size))
            for piece in pieces:
                centred = empty.centred(piece)
                out += (centred @ block).T @ centred
            return out
        return _sums(fit, task, size).T / n

    def squares(pieces):
        out = np.zeros((1, size))
        for piece in pieces:
            out[0] += (empty.centred(piece) ** 2).sum(axis=0)
        return out

    trace = float(_sums(fit, squares, size).sum()) / n
    if not trace:
        return empty
    values, vectors = leading_eigenpairs(product, size, components)
    real = values > 8 * size * EPS * trace
    values, vectors = values[real], vectors[:, real]
    k = len(values)

    def moments(pieces):
        out = np.zeros((k + 1, k))
        for piece in pieces:
            white = empty.centred(piece) @ vectors / np.sqrt(values)
            out[:k] += white.T @ white
            out[k] += white.sum(axis=0)
        return out

    both = _sums(fit, moments, k) / n
    # The mean is rounding only: centring after the sum takes nothing away.
    error = float(np.abs(both[:k] - np.outer(both[k], both[k]) - np.eye(k)).max())
    return Whitening(n, empty.sums, values, vectors, trace, error)


def whitened(rows: DataFrame, model: Whitening, id: str = "vec_id", x: str = "x") -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error), a row for each row and component."""
    k = len(model.values)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scale = np.sqrt(model.values)
        for batch in batches:
            ids = batch.column("id")
            for at, matrix in matrices(batch.column("x")):
                for a in range(0, len(at), _ROWS):
                    piece = matrix[a:a + _ROWS]
                    exact = model.deviations(piece)
                    squared = (exact * exact).sum(axis=1).tolist()
                    white = exact.astype(np.float64) / model.n @ model.vectors / scale
                    m = len(piece)
                    yield pa.record_batch([
                        ids.take(pa.array(np.repeat(at[a:a + _ROWS], k))), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                        pa.array(np.repeat(np.array([s if s < 1 << 63 else -1 for s in squared], np.int64), k),
                                 mask=np.repeat(np.array([s >= 1 << 63 for s in squared], bool), k)),
                        pa.array(white.reshape(-1)), pa.array(np.tile(model.values / model.trace, m))],
                        ["vec_id", "component", "deviation", "whitened", "explained"])

    columns = "vec_id long, component int, deviation long, whitened double, explained double"
    source = rows.select(F.col(id).cast("long").alias("id"), F.col(x).cast("array<long>").alias("x")).where("x IS NOT NULL")
    if not k:
        source = source.limit(0)
    return source.mapInArrow(apply, columns).select(
        "vec_id", "component", F.lit(model.n).cast("long").alias("n"), "deviation", "whitened", "explained",
        F.lit(model.identity_error).alias("identity_error"))


def whiten(rows: DataFrame, id: str = "vec_id", vector: str = "embedding", components: int = 16,
           scale: int = 64, offset: int = 1_000_000) -> DataFrame:
    """Whitened coordinates of every row whose vector holds only numbers, on the grid of ``scale`` and ``offset``."""
    points = rows.select(F.col(id).cast("long").alias("id"), grid(F.col(vector), scale, offset).alias("x")).where("x IS NOT NULL")
    lengths = points.groupBy(F.size("x").alias("size")).count().orderBy(F.col("count").desc(), "size").first()
    if lengths:
        points = points.where(F.size("x") == lengths["size"])
    model = fit_whitening(points, "x", components) or Whitening(0, [], np.zeros(0), np.zeros((0, 0)), 0.0, 0.0)
    return whitened(points, model, "id", "x")
