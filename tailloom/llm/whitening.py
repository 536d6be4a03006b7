"""Whitening of embeddings along the leading eigenvectors of their covariance, by Jacobi-Davidson.

Vectors are put on a grid, and each distinct grid vector counts once (the fit
list).  Its covariance V is never formed: a Spark job over the fit list gives V
times a block of vectors, each vector centred before it is multiplied, with
partial sums of a few numbers for each dimension.  Rayleigh-Ritz on a growing
subspace gives the leading pairs; for each pair not yet exact, MINRES solves the
correction equation (V - theta) t = -r, projected off the pairs found, and t joins
the subspace.  The inner solves go in step, so that one job serves a block of them.
Pairs whose residual is at rounding level are locked; the end comes when all are,
by residuals of fresh products.

The driver holds a subspace (dimensions x at most ``SPACE`` columns), never rows.

Defined results: rows whose vector is null, empty, or holds null or non-finite
entries go, and so do vectors of another length than the most frequent one (the
longer of two as frequent); repeated rows come out alike; null ids come through;
components without variance have no row, so equal vectors give no rows, and
neither do empty tables; other columns are ignored.  Entries are below 2^40 in
size.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from decimal import Decimal
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written

#: Most columns of the subspace, as a multiple of the components wanted, and at least; steps of MINRES for a correction.
SPACE, SPACE_LEAST, INNER = 5, 32, 4
#: A residual is at rounding level below this multiple of the largest eigenvalue, a pair is without variance below that of the trace.
EXACT, NOTHING = 2.0**-44, 2.0**-40
#: Outer steps before giving up.
STEPS = 200
#: Rows of a batch in Python.
ROWS = 2048
Product = Callable[[np.ndarray], np.ndarray]


class Fit(NamedTuple):
    """Of the fit list: vectors, sums by dimension, eigenvalues (falling), eigenvectors (columns), trace, and the identity error."""

    n: int
    sums: np.ndarray
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float


def grid(rows: DataFrame, column: str = "embedding", scale: float = 64.0, shift: int = 1_000_000) -> DataFrame:
    """The rows with complete vectors of the usual length, and x: floor(scale * entry) + shift of each entry, as longs."""
    entries = F.transform(column, lambda c: c.cast("double"))
    whole = rows.where(F.col(column).isNotNull() & (F.size(column) > 0) & F.forall(entries, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf"))))
    usual = whole.groupBy(F.size(column).alias("d")).count().agg(F.max(F.struct("count", "d"))["d"].alias("d")).first()
    whole = whole.where(F.size(column) == (usual["d"] or 0))
    return whole.withColumn("x", F.transform(entries, lambda c: F.floor(c * scale).cast("long") + shift))


def matrix(column: pa.Array) -> np.ndarray:
    """A list column of equal lengths as a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """x - S/n, from the exact n * x - S."""
    return (n * x - sums) / n


def summed(rows: DataFrame, part: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The sum over the batches of rows (a column x) of a matrix of fixed shape, added up by Spark entry by entry."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if len(batch):
                found = part(matrix(batch.column(0)))
                total = found if total is None else total + found
        if total is not None:
            i, j = np.indices(total.shape)
            yield pa.RecordBatch.from_arrays([pa.array(i.ravel()), pa.array(j.ravel()), pa.array(total.ravel())], names=["i", "j", "v"])

    found = rows.select("x").mapInArrow(run, "i long, j long, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).toPandas()
    total = np.zeros((int(found["i"].max()) + 1, int(found["j"].max()) + 1))
    total[found["i"], found["j"]] = found["v"]
    return total


def orthonormal(new: np.ndarray, base: np.ndarray) -> np.ndarray:
    """Columns that span what new adds to the orthonormal columns of base."""
    kept = base
    for column in new.T:
        size = np.linalg.norm(column)
        for _ in range(2):
            column = column - kept @ (kept.T @ column)
        left = np.linalg.norm(column)
        if size > 0 and left > 1e-10 * size:
            column = column / left
            column = column - kept @ (kept.T @ column)
            kept = np.column_stack([kept, column / np.linalg.norm(column)])
    return kept[:, base.shape[1] :]


def minres(product: Product, right: np.ndarray, steps: int) -> np.ndarray:
    """Solutions of A t = right, a column each, after that many MINRES steps in step; product gives A of a block."""
    d, b = right.shape
    solution, beta = np.zeros((d, b)), np.linalg.norm(right, axis=0)
    last, now = np.zeros((d, b)), right / np.where(beta > 0, beta, 1)
    eta, old_w, w = beta.copy(), np.zeros((d, b)), np.zeros((d, b))
    c_old, s_old, c, s = np.ones(b), np.zeros(b), np.ones(b), np.zeros(b)
    before = np.zeros(b)
    for _ in range(steps):
        then = product(now)
        alpha = (now * then).sum(0)
        then = then - alpha * now - before * last
        after = np.linalg.norm(then, axis=0)
        # the rotations so far on the new column of the tridiagonal matrix, then one more
        low = s_old * before
        mid = c_old * c * before + s * alpha
        top = c * alpha - c_old * s * before
        size = np.hypot(top, after)
        safe = np.where(size > 0, size, 1)
        c_new, s_new = np.where(size > 0, top / safe, 1), np.where(size > 0, after / safe, 0)
        direction = np.where(size > 0, (now - mid * w - low * old_w) / safe, 0)
        solution = solution + c_new * eta * direction
        eta, old_w, w = -s_new * eta, w, direction
        c_old, s_old, c, s = c, s, c_new, s_new
        last, now, before = now, then / np.where(after > 0, after, 1), after
    return solution


def leading(product: Product, d: int, k: int, inner: int = INNER, space: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The k largest eigenvalues and orthonormal eigenvectors of the symmetric, positive semidefinite product of dimension d.

    Fewer than k if d is smaller.  Each call of product takes a block of columns.
    """
    k, rng = min(k, d), np.random.default_rng(1)
    space = min(d, space or max(SPACE_LEAST, SPACE * k))
    none = np.zeros((d, 0))
    locked, values = none, np.zeros(0)
    base = orthonormal(rng.standard_normal((d, min(space, k + 4))), none)
    image = product(base)
    for _ in range(STEPS):
        small = base.T @ image
        theta, turn = np.linalg.eigh((small + small.T) / 2)
        order = np.argsort(-theta, kind="stable")
        theta, turn = theta[order], turn[:, order]
        want = k - locked.shape[1]
        ritz, moved = base @ turn[:, :want], image @ turn[:, :want]
        rest = moved - ritz * theta[:want]
        rest -= locked @ (locked.T @ rest)
        scale = max(values.max(initial=0.0), theta[0], 0.0)
        done = np.linalg.norm(rest, axis=0) <= EXACT * scale
        first = int(np.argmin(done)) if not done.all() else want  # lock from the top, so that none is passed over
        if first:
            # residuals of fresh products decide
            fresh = product(ritz[:, :first])
            fresh_theta = (ritz[:, :first] * fresh).sum(0)
            exact = np.linalg.norm(fresh - ritz[:, :first] * fresh_theta, axis=0) <= 2 * EXACT * scale * np.sqrt(d)
            first = int(np.argmin(exact)) if not exact.all() else first
            locked, values = np.column_stack([locked, ritz[:, :first]]), np.concatenate([values, fresh_theta[:first]])
            if locked.shape[1] == k:
                order = np.argsort(-values, kind="stable")
                return values[order], locked[:, order]
        left = slice(first, want)
        whole = base.shape[1] + locked.shape[1] - first >= d
        if first or done[0] or not whole and base.shape[1] >= space:  # start afresh from the best vectors, off the locked ones
            keep = base.shape[1] if whole or base.shape[1] < space else max(want, space // 2)
            base = orthonormal(base @ turn[:, first:keep], locked)
            image = product(base)
        off = np.column_stack([locked, ritz[:, left]])

        def projected(block: np.ndarray, at: np.ndarray = theta[left], off: np.ndarray = off) -> np.ndarray:
            block = block - off @ (off.T @ block)
            found = product(block) - block * at
            return found - off @ (off.T @ found)

        right = -(rest[:, left] - off @ (off.T @ rest[:, left]))
        both = np.column_stack([locked, base])
        new = orthonormal(minres(projected, right, inner), both)
        if not new.shape[1] and both.shape[1] < d:
            new = orthonormal(rng.standard_normal((d, 1)), both)
        if new.shape[1]:
            new = new[:, : max(1, space - base.shape[1])]
            base, image = np.column_stack([base, new]), np.column_stack([image, product(new)])
        else:  # subspace and locked pairs are all there is: only rounding is left, so take fresh images
            base = orthonormal(base, locked)
            image = product(base)
    raise RuntimeError(f"{k - locked.shape[1]} of {k} eigenvectors have residuals over rounding after {STEPS} steps")


def fit(gridded: DataFrame, components: int = 16, inner: int = INNER) -> Fit | None:
    """Of the distinct x of gridded rows; None without rows or variance."""
    listed = written(gridded.select("x").distinct())
    spread = listed.select(F.posexplode("x").alias("i", "v")).groupBy("i").agg(F.count("*").alias("n"), F.sum("v").alias("s")).orderBy("i").collect()
    if not spread:
        return None
    n, sums, d = spread[0]["n"], np.array([r["s"] for r in spread], np.int64), len(spread)
    trace = float(summed(listed, lambda x: np.array([[np.square(centred(x, n, sums)).sum()]]))[0, 0]) / n
    if trace == 0:
        return None

    def product(block: np.ndarray) -> np.ndarray:
        def part(x: np.ndarray) -> np.ndarray:
            y = centred(x, n, sums)
            return y.T @ (y @ block)

        return summed(listed, part) / n

    values, vectors = leading(product, d, components, inner)
    some = values > NOTHING * trace
    values, vectors = values[some], vectors[:, some]
    onto = vectors / np.sqrt(values)
    mean = summed(listed, lambda x: (centred(x, n, sums) @ onto).sum(0)[None])[0] / n

    def outer(x: np.ndarray) -> np.ndarray:
        w = centred(x, n, sums) @ onto - mean
        return w.T @ w

    error = float(np.abs(summed(listed, outer) / n - np.eye(len(values))).max())
    return Fit(n, sums, values, vectors, trace, error)


def deviations(x: np.ndarray, n: int, sums: np.ndarray) -> list[Decimal]:
    """Sum over dimensions of (n * x - S)^2 of each row, exactly."""
    apart = n * x - sums
    if np.abs(apart).max(initial=0) < 2**31 / np.sqrt(x.shape[1]):
        return [Decimal(v) for v in np.square(apart).sum(1).tolist()]
    return [Decimal(sum(v * v for v in row)) for row in apart.tolist()]


def whiten(rows: DataFrame, column: str = "embedding", key: str = "vec_id", components: int = 16, inner: int = INNER) -> DataFrame:
    """key, component (from 1), n, deviation (decimal), whitened, explained and identity_error for each complete row and component."""
    gridded = grid(rows.select(key, column), column)
    found = fit(gridded, components, inner)
    id_type = dict(gridded.dtypes)[key]
    fields = f"{key} {id_type}, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
    if found is None:
        return rows.sparkSession.createDataFrame([], fields)
    onto, k = found.vectors / np.sqrt(found.values), len(found.values)
    share = found.values / found.trace

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, len(whole), ROWS):
                batch = whole.slice(at, ROWS)
                x, each = matrix(batch.column(1)), np.repeat(np.arange(len(batch)), k)
                of = pa.array(deviations(x, found.n, found.sums), pa.decimal128(38, 0)).take(pa.array(each))
                same = lambda v, t: pa.array(np.full(len(each), v), t)
                columns = [batch.column(0).take(pa.array(each)), pa.array(np.tile(np.arange(1, k + 1), len(batch)), pa.int32()), same(found.n, pa.int64()), of]
                columns += [pa.array((centred(x, found.n, found.sums) @ onto).ravel()), pa.array(np.tile(share, len(batch))), same(found.identity_error, pa.float64())]
                yield pa.RecordBatch.from_arrays(columns, names=[key, "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return gridded.select(key, "x").mapInArrow(run, fields)
