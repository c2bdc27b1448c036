"""Embedding whitening: leading components by Jacobi-Davidson, whitened coordinates for every row.

Entries become whole numbers x = floor(256 c), so sums are exact. The fit list
is each distinct x vector once, packed into blocks of BLOCK vectors and written
to shared scratch. Its covariance is never formed: a product with a few columns
is one distributed pass over the blocks, each centred before it is multiplied.
Jacobi-Davidson keeps a search space of such products on the driver (some tens
of columns, one row a dimension), takes Ritz pairs from it, and widens it by
correction equations, projected against the locked vectors and the pair itself
and solved by inner MINRES; all open pairs share each pass. A pair is locked
when its residual reaches double precision.

Rows whose vector is null, empty or holds a null, a non-finite entry or one
whose 256-fold is no long are dropped, and so are rows of another length than
the commonest (the longer of equally common ones). Equal vectors, repeated rows
and null ids stay, a row each. Components without variance (beyond rounding)
have no whitened coordinate and are left out, so a table of equal vectors, or
an empty one, gives no rows. ``deviation`` is null where it exceeds a long.
Other columns of the input are not looked at.
"""

from __future__ import annotations

from collections.abc import Callable
from fractions import Fraction
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticklake.llm.common import stored, table

#: Vectors in one packed block.
BLOCK = 1024
#: Columns of the search space, and those kept when it is full.
MOST_COLUMNS, KEPT_COLUMNS = 120, 16
#: Inner steps of one correction, and rounds of the outer loop before an error.
INNER_STEPS, OUTER_ROUNDS = 8, 200
#: Residuals count as double precision below this times dimensions times the largest eigenvalue.
ROUNDING = 4 * np.finfo(float).eps


class Fit(NamedTuple):
    """What whitening needs: number and sums of the distinct vectors, eigenvalues, components, and checks."""
    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float
    residuals: list[float]
    passes: int


def whole_vectors(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(id, x) of the rows that remain; lengths may differ."""
    c = F.col("v")
    fine = F.forall(c, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < F.lit(2.0 ** 55)))
    return (rows.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
            .filter(c.isNotNull() & (F.size(c) > 0) & fine)
            .select("id", F.transform(c, lambda e: F.floor(e * 256.0)).alias("x")))


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def packed(fit_rows: DataFrame, d: int) -> DataFrame:
    """Distinct vectors in blocks: (n, vectors), written to shared scratch."""
    def run(batches):
        for batch in batches:
            x = _matrix(batch.column(0), d)
            parts = [x[s:s + BLOCK] for s in range(0, len(x), BLOCK)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([len(p) for p in parts], pa.int32()), pa.array([p.astype("<i8").tobytes() for p in parts], pa.binary())],
                names=["n", "vectors"])
    return stored(fit_rows.select("x").distinct().mapInArrow(run, "n int, vectors binary"), "whitening-fit", "zstd")


def _summed(blocks: DataFrame, of_block: Callable[[np.ndarray], np.ndarray], d: int, kind: str = "double") -> np.ndarray:
    """Sum over all blocks of a matrix of few rows, a Spark aggregate over its rows."""
    width = of_block(np.zeros((1, d), np.int64)).shape[1]
    names = [f"c{i}" for i in range(width)]

    def run(batches):
        total = None
        for batch in batches:
            for b in batch.column(0):
                part = of_block(np.frombuffer(b.as_py(), "<i8").reshape(-1, d))
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total)), pa.int32()), *map(pa.array, total.T)],
                                             names=["row", *names])
    schema = ", ".join(["row int", *[f"{c} {kind}" for c in names]])
    found = blocks.select("vectors").mapInArrow(run, schema).groupBy("row").agg(*[F.sum(c).alias(c) for c in names])
    rows = {r[0]: r[1:] for r in found.collect()}
    return np.array([rows[i] for i in sorted(rows)])


class Centred:
    """Products with the covariance of the packed vectors, one pass each."""

    def __init__(self, blocks: DataFrame, d: int):
        # Halves of 32 bits: sums of longs stay exact.
        halves = _summed(blocks, lambda x: np.stack([(x >> 32).sum(0), (x & 0xFFFFFFFF).sum(0),
                                                     np.full(d, len(x), np.int64)], 1), d, "long")
        self.blocks, self.d = blocks, d
        self.n = int(halves[0][2])
        self.sums = [(int(h) << 32) + int(l) for h, l, _ in halves]
        self.whole = [s // self.n for s in self.sums]
        self.part = np.array([float(Fraction(s, self.n) - w) for s, w in zip(self.sums, self.whole)])
        self.passes = 1

    def centre(self) -> Callable[[np.ndarray], np.ndarray]:
        """x - S/n; the whole part of the mean is taken off exactly."""
        whole, part = np.array(self.whole, np.int64), self.part
        return lambda x: (x - whole).astype(np.float64) - part

    def product(self, v: np.ndarray) -> np.ndarray:
        centre = self.centre()

        def of_block(x):
            c = centre(x)
            return c.T @ (c @ v)
        self.passes += 1
        return _summed(self.blocks, of_block, self.d) / self.n

    def trace(self) -> float:
        centre = self.centre()
        self.passes += 1
        return float((_summed(self.blocks, lambda x: (centre(x) ** 2).sum(0)[:, None], self.d) / self.n).sum())

    def identity_error(self, projection: np.ndarray) -> float:
        """Largest entry of the projected vectors' covariance minus the identity, centred before multiplying."""
        centre, k = self.centre(), projection.shape[1]
        mean = _summed(self.blocks, lambda x: (centre(x) @ projection).sum(0)[:, None], self.d).ravel() / self.n

        def of_block(x):
            z = centre(x) @ projection - mean
            return z.T @ z
        self.passes += 2
        return float(np.abs(_summed(self.blocks, of_block, self.d) / self.n - np.eye(k)).max())


def _norms(m: np.ndarray) -> np.ndarray:
    return np.sqrt((m * m).sum(0))


def minres(apply: Callable[[np.ndarray], np.ndarray], b: np.ndarray, steps: int, tolerance: float) -> np.ndarray:
    """Columns x with apply(x) near b, each by its own MINRES recurrence; a step applies once to all columns."""
    size = _norms(b)
    x, w1, w2, v_before = (np.zeros_like(b) for _ in range(4))
    v = b / np.where(size > 0, size, 1)
    cs, sn, dbar, eps, beta = -np.ones_like(size), *(np.zeros_like(size) for _ in range(4))
    left = size.copy()
    for _ in range(steps):
        if not (left > tolerance * size).any():
            break
        y = apply(v)
        alpha = (v * y).sum(0)
        y = y - alpha * v - beta * v_before
        beta = _norms(y)
        delta, gbar = cs * dbar + sn * alpha, sn * dbar - cs * alpha
        old, eps, dbar = eps, sn * beta, -cs * beta
        gamma = np.sqrt(gbar * gbar + beta * beta)
        live = (gamma > 0) & (left > tolerance * size)
        gamma = np.where(live, gamma, 1)
        cs, sn = gbar / gamma, beta / gamma
        w1, w2 = w2, (v - old * w1 - delta * w2) / gamma * live
        x += np.where(live, cs * left, 0) * w2
        left = np.where(live, np.abs(sn) * left, 0)
        v_before, v = v, y / np.where(beta > 0, beta, 1) * live
    return x


def _beside(v: np.ndarray, w: np.ndarray, locked: np.ndarray, new: np.ndarray, made: np.ndarray) -> tuple:
    """The search space ``v`` and its products ``w``, widened by what ``new`` adds; ``made`` are its products.

    The products follow the same combinations, so a column that is mostly in
    the space already would lose digits: it is left out.
    """
    columns, products = [v], [w]
    for c, y in zip(new.T, made.T):
        size = np.sqrt(c @ c)
        if not size:
            continue
        c, y = c / size, y / size
        whole = 1.0
        for _ in range(3):
            c = c - locked @ (locked.T @ c)
            for q, x in zip(columns, products):
                part = q.T @ c
                c, y = c - q @ part, y - x @ part
            left = np.sqrt(c @ c)
            whole *= left
            if whole < 1e-3:
                break
            c, y = c / left, y / left
        else:
            columns.append(c[:, None])
            products.append(y[:, None])
    return np.column_stack(columns), np.column_stack(products)


def jacobi_davidson(product: Callable[[np.ndarray], np.ndarray], d: int, wanted: int,
                    seed: int = 12) -> tuple[np.ndarray, np.ndarray, list[float]]:
    """The ``wanted`` largest eigenvalues, their unit vectors, and the residuals at which they were locked.

    ``product`` multiplies a symmetric, nonnegative d x d operator with columns.
    Each round solves the correction equations of all open pairs at once. Every
    product of the inner solver widens the search space, which so holds the
    corrections themselves. A pair is locked by a product made anew.
    """
    wanted = min(wanted, d)
    rng = np.random.default_rng(seed)
    locked, values, residuals = np.zeros((d, 0)), [], []
    v = np.linalg.qr(rng.standard_normal((d, min(d, 2 * wanted))))[0]
    w = product(v)
    for _ in range(OUTER_ROUNDS):
        h = v.T @ w
        theta, s = np.linalg.eigh((h + h.T) / 2)
        theta, s = theta[::-1], s[:, ::-1]
        v, w = v @ s, w @ s
        k = wanted - len(values)
        limit = ROUNDING * d * max([*values, *np.abs(theta[:1])])

        def rest(columns):
            r = columns - v[:, :k] * theta[:k]
            return r - locked @ (locked.T @ r)

        r = rest(w[:, :k])
        done = 0
        if _norms(r)[0] <= 1000 * limit:
            fresh = product(v[:, :k])
            w = np.column_stack([fresh, w[:, k:]])
            r = rest(fresh)
            while done < k and _norms(r)[done] <= limit:
                done += 1
        if done:
            locked = np.column_stack([locked, v[:, :done]])
            values += theta[:done].tolist()
            residuals += _norms(r)[:done].tolist()
            if len(values) == wanted:
                return np.array(values), locked, residuals
            v, w, theta, r, k = v[:, done:], w[:, done:], theta[done:], r[:, done:], k - done
        if v.shape[1] + k * INNER_STEPS > MOST_COLUMNS:
            v, w = v[:, :KEPT_COLUMNS], w[:, :KEPT_COLUMNS]
        u, shift = v[:, :k], theta[:k]
        seen, made = [], []

        def project(z):
            z = z - locked @ (locked.T @ z)
            return z - u * (u * z).sum(0)

        def corrected(z):
            seen.append(project(z))
            made.append(product(seen[-1]))
            return project(made[-1] - shift * seen[-1])

        minres(corrected, -project(r), INNER_STEPS, 1e-4)
        before = v.shape[1]
        v, w = _beside(v, w, locked, np.column_stack(seen), np.column_stack(made))
        if v.shape[1] == before:
            # Rounding is all that is left of the corrections: products anew, and a look elsewhere.
            more = rng.standard_normal((d, k))
            v = np.linalg.qr(np.column_stack([v, more - locked @ (locked.T @ more)])[:, :d - locked.shape[1]])[0]
            w = product(v)
    raise RuntimeError(f"residuals {_norms(r)} after {OUTER_ROUNDS} rounds, not {limit}")


def fit(x: DataFrame, wanted: int) -> tuple[int, Fit] | None:
    """Commonest length and the fit of the distinct vectors of that length; None without vectors."""
    length = (x.groupBy(F.size("x").alias("d")).agg(F.count(F.lit(1)).alias("rows"))
              .orderBy(F.desc("rows"), F.desc("d")).limit(1).collect())
    if not length:
        return None
    d = length[0].d
    c = Centred(packed(x.filter(F.size("x") == d), d), d)
    trace = c.trace()
    if not trace:
        return d, Fit(c.n, c.sums, np.zeros(0), np.zeros((d, 0)), 0.0, 0.0, [], c.passes)
    values, vectors, residuals = jacobi_davidson(c.product, d, wanted)
    real = values > ROUNDING * d * values[0]
    values, vectors = values[real], vectors[:, real]
    error = c.identity_error(vectors / np.sqrt(values))
    return d, Fit(c.n, c.sums, values, vectors, trace, error, residuals, c.passes)


def _deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Exact sums of (n x - S)^2; None beyond a long."""
    if not len(x):
        return []
    most = n * max(int(x.max()), -int(x.min()), 1) + max(map(abs, sums))
    if most * most * x.shape[1] < 2 ** 63:
        return ((x * n - np.array(sums)) ** 2).sum(1).tolist()
    exact = ((x.astype(object) * n - np.array(sums, object)) ** 2).sum(1)
    return [v if v < 2 ** 63 else None for v in exact.tolist()]


def whiten(rows: DataFrame, wanted: int = 4, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """One row for each remaining row and component: ``n``, ``deviation``, ``whitened``, ``explained``, ``identity_error``."""
    x = whole_vectors(rows, id_col, vector_col)
    id_type = x.schema["id"].dataType.simpleString()
    schema = (f"id {id_type}, component int, n long, deviation long, whitened double, explained double, "
              "identity_error double")
    found = fit(x, wanted)
    if found is None:
        return rows.sparkSession.createDataFrame([], schema).withColumnRenamed("id", id_col)
    d, f = found
    k = len(f.values)
    whole = [s // f.n for s in f.sums]
    part = np.array([float(Fraction(s, f.n) - w) for s, w in zip(f.sums, whole)])
    whole = np.array(whole, np.int64)
    projection, explained = f.vectors / np.sqrt(f.values), f.values / f.trace
    n, sums, error = f.n, f.sums, f.identity_error

    def run(batches):
        for batch in batches:
            m = _matrix(batch.column(1), d)
            z = ((m - whole).astype(np.float64) - part) @ projection
            size = len(m)
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(pa.array(np.repeat(np.arange(size), k))),
                pa.array(np.tile(np.arange(1, k + 1), size), pa.int32()),
                pa.array(np.full(size * k, n), pa.int64()),
                pa.array([v for v in _deviations(m, n, sums) for _ in range(k)], pa.int64()),
                pa.array(z.ravel()), pa.array(np.tile(explained, size)), pa.array(np.full(size * k, error))],
                names=["id", "component", "n", "deviation", "whitened", "explained", "identity_error"])
    return x.filter(F.size("x") == d).mapInArrow(run, schema).withColumnRenamed("id", id_col)


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All embeddings, up to four components."""
    return whiten(table(spark, sf_dir, "embeddings"))
