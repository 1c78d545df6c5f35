"""Embedding whitening by spectral divide and conquer.

A vector's entries c become the integers ``x = floor(64 * c) + 1000000``
(beyond ``MOST`` in size: ``MOST``).  The fit list is each distinct x vector
once; its sums and its centred sums of products are counted exactly, in
integers, so the covariance is exact until it becomes doubles.

Components: the orthogonal polar factor U of the covariance less a shift
times the identity (dynamically weighted Halley iterations, by QR and by
solving) has the eigenvalue 1 where the covariance's is above the shift and
-1 where it is below.  ``(U + I) / 2`` projects on the upper invariant
subspace; in bases of both subspaces the covariance falls into two blocks,
which are divided in turn, the upper one first, until blocks are single
eigenvalues (or equal ones, where any basis does).  The matrices have one
row per dimension, whatever the number of vectors; the components found are
given to every task, which whitens its rows.

Rows whose vector is null, or holds null or non-finite entries, are left
out; so are those of another length than most vectors have (of equally
frequent lengths the longer counts).  Repeated rows and vectors: a result
for each, the vector is fitted once.  A component without variance has null
``whitened`` values.  No rows, or vectors without entries: no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import scratch

SCALE, OFFSET = 64, 1_000_000
MOST = 1 << 46
COMPONENTS = 16
EPS = float(np.finfo(float).eps)


class Fit(NamedTuple):
    n: int  # distinct vectors
    sums: np.ndarray  # of each dimension, Python integers
    values: np.ndarray  # eigenvalues, falling
    vectors: np.ndarray  # one unit column for each
    trace: float


# --- dense matrices of one row per dimension --------------------------------


def polar_factor(a: np.ndarray) -> np.ndarray:
    """The orthogonal polar factor of a symmetric matrix."""
    m = len(a)
    x = a / max(np.abs(a).sum(0).max(), np.finfo(float).tiny)
    try:
        low = 1 / (np.abs(np.linalg.inv(x)).sum(0).max() * np.sqrt(m))
    except np.linalg.LinAlgError:
        low = EPS
    low = min(1.0, max(low, EPS)) if np.isfinite(low) else EPS
    one = np.eye(m)
    for _ in range(12):
        l2 = low * low
        d = np.cbrt(4 * max(1 - l2, 0) / (l2 * l2))
        s = np.sqrt(1 + d)
        wa = s + np.sqrt(8 - 4 * d + 8 * (2 - l2) / (l2 * s)) / 2
        wb = (wa - 1) ** 2 / 4
        wc = wa + wb - 1
        low = min(1.0, low * (wa + wb * l2) / (1 + wc * l2))
        if wc > 100:
            q = np.linalg.qr(np.vstack([np.sqrt(wc) * x, one]))[0]
            new = wb / wc * x + (wa - wb / wc) / np.sqrt(wc) * (q[:m] @ q[m:].T)
        else:
            new = wb / wc * x + (wa - wb / wc) * np.linalg.solve(one + wc * (x.T @ x), x.T).T
        moved = np.linalg.norm(new - x)
        x = (new + new.T) / 2
        if moved <= np.cbrt(4 * EPS) and 1 - low < 10 * EPS:
            break
    return x


def _divided(a: np.ndarray, scale: float) -> tuple[np.ndarray, int] | None:
    """An orthogonal basis whose first columns span the invariant subspace
    of the larger eigenvalues, and their number.  Shifts between the least
    and the largest diagonal entry always lie within the spectrum."""
    m = len(a)
    spin = np.linalg.qr(np.random.default_rng(m).normal(size=(m, m)))[0]
    best = None
    for diagonal in (np.diag(a), np.diag(spin.T @ a @ spin)):
        low, high = diagonal.min(), diagonal.max()
        for shift in (np.median(diagonal), diagonal.mean(), (low + high) / 2, *np.quantile(diagonal, [0.25, 0.75, 0.1, 0.9])):
            u = polar_factor(a - shift * np.eye(m))
            r = int(np.rint((np.trace(u) + m) / 2))
            if not 0 < r < m:
                continue
            upper = (u + np.eye(m)) / 2
            q = np.linalg.qr(upper @ spin[:, :r])[0]
            q = np.linalg.qr(upper @ q, mode="complete")[0]
            rest = np.linalg.norm(q[:, r:].T @ a @ q[:, :r])
            if rest <= 8 * m * EPS * scale:
                return q, r
            if best is None or rest < best[0]:
                best = rest, q, r
    return best and best[1:]


def spectrum(a: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``most`` largest eigenvalues of a symmetric matrix, falling, and
    their unit eigenvectors as columns."""
    scale = np.linalg.norm(a)
    values: list[float] = []
    columns: list[np.ndarray] = []
    open_blocks = [(a, np.eye(len(a)))]
    while open_blocks and len(values) < most:
        block, basis = open_blocks.pop()
        m = len(block)
        even = np.linalg.norm(block - np.trace(block) / m * np.eye(m)) <= 4 * EPS * scale
        cut = None if even or m == 1 else _divided(block, scale)
        if cut is None:
            order = np.argsort(-np.diag(block), kind="stable")
            values += np.diag(block)[order].tolist()
            columns += [basis[:, k] for k in order]
            continue
        q, r = cut
        inner = q.T @ block @ q
        inner = (inner + inner.T) / 2
        open_blocks.append((inner[r:, r:], basis @ q[:, r:]))
        open_blocks.append((inner[:r, :r], basis @ q[:, :r]))
    vectors = np.array(columns[:most]).T.reshape(len(a), -1)
    found = np.einsum("ij,ij->j", vectors, a @ vectors)  # Rayleigh quotients
    order = np.argsort(-found, kind="stable")
    return found[order], vectors[:, order]


# --- exact sums over the fit list -------------------------------------------


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def _products(y: np.ndarray) -> np.ndarray:
    """y' y in exact integers (Python's)."""
    if len(y) and float(np.abs(y).max()) ** 2 * len(y) < 2**52:
        f = y.astype(float)
        return (f.T @ f).astype(np.int64).astype(object)
    y = y.astype(object)
    return y.T @ y


def _totals(fit: DataFrame, d: int, of) -> np.ndarray:  # noqa: ANN001
    """``of(rows as a matrix)`` summed over the fit list, as integers; tasks
    send their sums, which are added by position."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for b in batches:
            part = of(_matrix(b.column(0), d))
            total = part if total is None else total + part
        if total is not None:
            values = pa.array([Decimal(int(v)) for v in total], pa.decimal128(38, 0))
            yield pa.record_batch([pa.array(np.arange(len(total), dtype=np.int32)), values], names=["at", "v"])

    sums = fit.mapInArrow(run, "at int, v decimal(38,0)").groupBy("at").agg(F.sum("v").alias("v")).orderBy("at")
    return np.array([int(r["v"]) for r in sums.collect()], dtype=object)


def quantised(rows: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """vec_id and x of the rows whose vectors are whole."""
    finite = F.forall(vector, lambda c: F.coalesce(F.abs(c.cast("double")) < float("inf"), F.lit(False)))
    steps = F.transform(vector, lambda c: F.least(F.greatest(F.floor(c.cast("double") * SCALE), F.lit(-MOST)), F.lit(MOST)) + OFFSET)
    return rows.where(F.col(vector).isNotNull() & finite).select(F.col(vec_id).alias("vec_id"), steps.alias("x"))


def fit_list(x: DataFrame, d: int) -> DataFrame:
    """Each distinct vector once, written to the scratch folder."""
    path = scratch(x.sparkSession, "vectors")
    x.where(F.size("x") == d).select("x").distinct().write.parquet(path)
    return x.sparkSession.read.parquet(path)


def fit_components(fit: DataFrame, d: int, most: int = COMPONENTS) -> Fit:
    first = _totals(fit, d, lambda m: np.concatenate([[len(m)], m.astype(object).sum(0)]))
    n, sums = int(first[0]), first[1:]
    centre = np.array([round(s / n) for s in sums.tolist()], dtype=np.int64)

    def centred(m: np.ndarray) -> np.ndarray:
        y = m - centre
        return np.concatenate([y.astype(object).sum(0), _products(y).ravel()])

    second = _totals(fit, d, centred)
    left, products = second[:d], second[d:].reshape(d, d)  # left: what the whole centre leaves
    exact = n * products - np.outer(left, left)  # n * n times the covariance
    covariance = np.array([[int(v) / (n * n) for v in row] for row in exact.tolist()])
    trace = int(sum(exact[k, k] for k in range(d))) / (n * n)
    values, vectors = spectrum(covariance, min(most, d))
    return Fit(n, sums, values, vectors, trace)


# --- whitened rows ----------------------------------------------------------


def _deviations(m: np.ndarray, fit: Fit) -> np.ndarray:
    """n * x - S, as 64-bit integers where they surely fit."""
    base = np.array([s // fit.n for s in fit.sums.tolist()], dtype=np.int64)
    rest = np.array([s % fit.n for s in fit.sums.tolist()], dtype=np.int64)
    y = m - base
    if not len(y) or float(np.abs(y).max() + 1) * fit.n < 2**62:
        return y * fit.n - rest
    return y.astype(object) * fit.n - rest.astype(object)


def _whitened(z: np.ndarray, fit: Fit) -> np.ndarray:
    scale = np.where(_varies(fit), np.sqrt(np.maximum(fit.values, 0)), np.nan)
    return (z.astype(float) / fit.n) @ fit.vectors / scale


def _varies(fit: Fit) -> np.ndarray:
    top = max(fit.values[0], 0.0)
    return fit.values > len(fit.vectors) * EPS * top


def _squares(z: np.ndarray) -> pa.Array:
    """Row sums of squares; null beyond 64 bits."""
    if z.dtype != object and (not len(z) or float(np.abs(z).max()) ** 2 * z.shape[1] < 2**62):
        return pa.array((z * z).sum(1), pa.int64())
    wide = z.astype(object)
    return pa.array([v if v < 1 << 63 else None for v in (wide * wide).sum(1).tolist()], pa.int64())


def identity_error(vectors: DataFrame, fit: Fit) -> float | None:
    """The largest entry, in size, of the whitened fit list's covariance
    less the identity, over the components with variance."""
    some = np.flatnonzero(_varies(fit))
    if not len(some):
        return None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(some), len(some) + 1))
        for b in batches:
            w = _whitened(_deviations(_matrix(b.column(0), len(fit.vectors)), fit), fit)[:, some]
            total += np.column_stack([w.T @ w, w.sum(0)])  # the deviations are centred
        yield pa.record_batch([pa.array(np.arange(total.size, dtype=np.int32)), pa.array(total.ravel())], names=["at", "v"])

    sums = vectors.mapInArrow(run, "at int, v double").groupBy("at").agg(F.sum("v").alias("v")).orderBy("at").collect()
    total = np.array([r["v"] for r in sums]).reshape(len(some), -1) / fit.n
    covariance = total[:, :-1] - np.outer(total[:, -1], total[:, -1])
    return float(np.abs(covariance - np.eye(len(some))).max())


def whiten(rows: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """One row per vector and component (numbered from 1): vec_id, component,
    n, deviation, whitened, explained, identity_error."""
    spark = rows.sparkSession
    kind = rows.schema[vec_id].dataType.simpleString()
    schema = f"vec_id {kind}, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    x = quantised(rows, vec_id, vector)
    common = x.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    if common is None or not common["d"]:
        return spark.createDataFrame([], schema)
    d = common["d"]
    vectors = fit_list(x, d)
    fit = fit_components(vectors, d, components)
    error = identity_error(vectors, fit)
    many = len(fit.values)
    explained = fit.values / fit.trace if fit.trace > 0 else np.full(many, np.nan)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            z = _deviations(_matrix(b.column(1), d), fit)
            row = np.repeat(np.arange(b.num_rows), many)
            of = lambda values: pa.array(np.tile(values, b.num_rows), from_pandas=True)  # noqa: E731, B023
            yield pa.record_batch(
                [
                    b.column(0).take(pa.array(row)), of(np.arange(1, many + 1, dtype=np.int32)),
                    pa.array(np.full(len(row), fit.n, np.int64)), _squares(z).take(pa.array(row)),
                    pa.array(_whitened(z, fit).ravel(), from_pandas=True), of(explained),
                    pa.array([error] * len(row), pa.float64()),
                ],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return x.where(F.size("x") == d).mapInArrow(run, schema)
