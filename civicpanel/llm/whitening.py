"""Whitening of embeddings with eigenvectors that are refined in mixed precision.

Entries are fixed-point whole numbers, so sums and products of centred vectors are exact and do
not depend on the order of tasks.  Every task adds up the products of its rows; Spark adds the
tasks.  What reaches the driver is one matrix of the dimension of the vectors.

Its eigenvectors come from a float32 solver.  Ogita-Aishima iterations then correct them by
matrix products alone, first in float64 and at the end in extended precision: each step solves
for the correction E with X + XE nearer to the exact vectors and squares the error.  Pairs of
eigenvalues that the residuals cannot tell apart yet are only made orthogonal; the vectors of
such a cluster are turned by the solution of the small problem inside the cluster, shifted by
its mean, until the iteration can tell them apart too.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

COMPONENTS = 32
STEPS_A_UNIT, OFFSET = 64, 1_000_000
#: Entries below this keep 64 times themselves well inside a long.
LARGEST = 2.0**55
#: An eigenvalue of at most this share of the trace is no variance but rounding.
NOTHING = 1e-14
_EXACT, _LONG = 1 << 53, (1 << 63) - 1
_WHOLE = pa.decimal128(38, 0)


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, embedding) of rows whose vector has nothing but finite entries."""
    rows = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
    return rows.where(F.forall("embedding", lambda c: F.abs(c) < LARGEST))  # null and NaN are not below


def _fixed(batch: pa.RecordBatch, dimension: int) -> np.ndarray:
    flat = np.asarray(batch["embedding"].flatten(), np.float64)
    return (np.floor(STEPS_A_UNIT * flat).astype(np.int64) + OFFSET).reshape(-1, dimension)


def _sums(batches: Iterator[pa.RecordBatch], dimension: int) -> Iterator[pa.RecordBatch]:
    rows, total = 0, [0] * dimension
    for batch in batches:
        x = _fixed(batch, dimension) - OFFSET
        rows += len(x)
        whole = x.sum(0) if len(x) * int(np.abs(x).max(initial=0)) < _LONG else x.astype(object).sum(0)
        total = [a + int(b) for a, b in zip(total, whole, strict=True)]
    if rows:
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(dimension), pa.int32()), pa.array([rows] * dimension, pa.int64()),
             pa.array([Decimal(t + OFFSET * rows) for t in total], _WHOLE)],
            ["i", "n", "total"],
        )


def _products(batches: Iterator[pa.RecordBatch], dimension: int, near: list[int]) -> Iterator[pa.RecordBatch]:
    upper = np.triu_indices(dimension)
    total, middle = None, np.array(near, np.int64)
    for batch in batches:
        z = _fixed(batch, dimension) - middle
        exact = int(np.abs(z).max(initial=0)) ** 2 * len(z) < _EXACT
        own = z.astype(np.float64 if exact else object)
        own = (own.T @ own)[upper]
        own = own.astype(np.int64).astype(object) if exact else own
        total = own if total is None else total + own
    if total is not None:
        i, j = (pa.array(u, pa.int32()) for u in upper)
        yield pa.RecordBatch.from_arrays([i, j, pa.array([Decimal(int(t)) for t in total], _WHOLE)], ["i", "j", "total"])


@dataclass
class Whitening:
    """What a task needs to whiten a vector: exact sums, vectors as columns, eigenvalues."""

    n: int
    near: list[int]  # whole numbers nearest to the means
    rest: list[int]  # sums of the vectors less ``near``
    vectors: np.ndarray
    values: np.ndarray
    explained: np.ndarray

    def centred(self, batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        z = _fixed(batch, len(self.near)) - np.array(self.near, np.int64)
        return z, z - np.array([r / self.n for r in self.rest])

    def project(self, y: np.ndarray) -> np.ndarray:
        return (y @ self.vectors) / np.sqrt(self.values)

    def deviations(self, z: np.ndarray) -> list[int | None]:
        largest = self.n * int(np.abs(z).max(initial=0)) + max(map(abs, self.rest), default=0)
        kind = np.int64 if largest**2 * len(self.near) < _LONG else object
        d = z.astype(kind) * self.n - np.array(self.rest, kind)
        return [int(v) if v <= _LONG else None for v in (d * d).sum(1)]


def _clusters(values: np.ndarray, apart: float) -> np.ndarray:
    """The number of each value's cluster: values at most ``apart`` from a neighbour are in one."""
    order = np.argsort(values, kind="stable")
    label = np.empty(len(values), np.int64)
    label[order] = np.cumsum(np.append(False, np.diff(values[order]) > apart))
    return label


def _refine(a: np.ndarray, x: np.ndarray, kind, rounds: int) -> tuple[np.ndarray, np.ndarray]:
    a, x = a.astype(kind), x.astype(kind)
    unit, size = np.eye(len(a), dtype=kind), np.sqrt((a * a).sum())
    smallest = len(a) * float(np.finfo(kind).eps)
    for _ in range(rounds):
        r = unit - x.T @ x
        s = x.T @ (a @ x)
        s = (s + s.T) / 2  # else the rounding of near values would not be a turn
        values = np.diag(s) / (1 - np.diag(r))
        off = s - np.diag(np.diag(s))
        error = np.sqrt((off**2).sum()) + size * np.sqrt((r * r).sum())
        label = _clusters(values, float(2 * error))
        close = label[None, :] == label[:, None]
        gap = np.where(close, 1, values[None, :] - values[:, None])
        step = np.where(close, r / 2, (s + values[None, :] * r) / gap)
        x = x + x @ step
        turned = False
        for number in np.flatnonzero(np.bincount(label) > 1):
            own = np.flatnonzero(label == number)
            if np.abs(off[np.ix_(own, own)]).max() <= smallest * size:
                continue  # as diagonal as it gets: eigenvalues that are equal
            part, middle = x[:, own], values[own].mean()
            inner = part.T @ (a @ part - middle * part)
            inner = (inner + inner.T) / 2
            scale = np.abs(inner).max()
            if scale > 0:
                x[:, own] = part @ np.linalg.eigh((inner / scale).astype(np.float64))[1].astype(kind)
                turned = True
        if not turned and np.abs(step).max() <= smallest:
            break
    for _ in range(2):
        x = x @ (3 * unit - x.T @ x) / 2
    return np.diag(x.T @ (a @ x)) / (x * x).sum(0), x


def eigenpairs(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues of a symmetric matrix, falling, and unit vectors in columns, to double precision.

    The largest entry of each vector is positive.
    """
    scale = np.abs(a).max(initial=0)
    if not scale:
        return np.zeros(len(a)), np.eye(len(a))
    a = a / scale
    _, x = np.linalg.eigh(a.astype(np.float32))
    _, x = _refine(a, x, np.float64, 12)
    values, x = _refine(a, x, np.longdouble, 12)
    order = np.argsort(-values, kind="stable")
    x = x[:, order] / np.sqrt((x[:, order] ** 2).sum(0))
    top = x[np.abs(x).argmax(0), np.arange(len(a))]
    return (values[order] * scale).astype(np.float64), (x * np.where(top < 0, -1, 1)).astype(np.float64)


def fit(rows: DataFrame, dimension: int, components: int = COMPONENTS) -> Whitening | None:
    """The whitening of ``rows`` (embedding: ``dimension`` finite entries); none for no rows."""
    sums = rows.select("embedding").mapInArrow(partial(_sums, dimension=dimension), "i int, n bigint, total decimal(38,0)")
    sums = sums.groupBy("i").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).orderBy("i").collect()
    if not sums:
        return None
    n, totals = sums[0]["n"], [int(r["total"]) for r in sums]
    near = [(2 * t + n) // (2 * n) for t in totals]
    rest = [t - n * m for t, m in zip(totals, near, strict=True)]
    products = rows.select("embedding").mapInArrow(
        partial(_products, dimension=dimension, near=near), "i int, j int, total decimal(38,0)"
    )
    matrix = np.zeros((dimension, dimension), object)
    for r in products.groupBy("i", "j").agg(F.sum("total").alias("total")).collect():  # one row for each pair of dimensions
        matrix[r["i"], r["j"]] = matrix[r["j"], r["i"]] = int(r["total"])
    shift = np.array(rest, object)
    scaled = n * matrix - np.outer(shift, shift)  # n * n times the covariance, exact
    trace = sum(int(scaled[i, i]) for i in range(dimension))
    values, vectors = eigenpairs(scaled.astype(np.longdouble) / np.longdouble(n) / np.longdouble(n))
    kept = min(components, dimension)
    values, vectors = values[:kept], vectors[:, :kept]
    whole = trace / n / n
    explained = values / whole if trace else np.zeros(kept)
    values = np.where(values > NOTHING * whole, values, np.nan)
    return Whitening(n, near, rest, vectors, values, explained)


def _spread(batches: Iterator[pa.RecordBatch], fitted: Whitening) -> Iterator[pa.RecordBatch]:
    """Sums and sums of products of whitened vectors: dimension -1 stands for the number 1."""
    total = None
    for batch in batches:
        w = fitted.project(fitted.centred(batch)[1])
        w = np.hstack([np.ones((len(w), 1)), w])
        own = w.T @ w
        total = own if total is None else total + own
    if total is not None:
        i, j = np.triu_indices(len(total))
        yield pa.RecordBatch.from_arrays(
            [pa.array(i - 1, pa.int32()), pa.array(j - 1, pa.int32()), pa.array(total[i, j], pa.float64())], ["i", "j", "total"]
        )


def identity_error(rows: DataFrame, fitted: Whitening) -> float:
    """The largest entry by which the covariance of the whitened rows differs from the identity.

    Components without variance are left out.
    """
    found = rows.select("embedding").mapInArrow(partial(_spread, fitted=fitted), "i int, j int, total double")
    sums = {(r["i"], r["j"]): r["total"] for r in found.groupBy("i", "j").agg(F.sum("total").alias("total")).collect()}
    real = [k for k, v in enumerate(fitted.values) if v == v]
    n, worst = fitted.n, 0.0
    for a in real:
        for b in real:
            if a <= b:
                cov = sums[a, b] / n - (sums[-1, a] / n) * (sums[-1, b] / n)
                worst = max(worst, abs(cov - (a == b)))
    return worst


def _whitened(batches: Iterator[pa.RecordBatch], fitted: Whitening, error: float) -> Iterator[pa.RecordBatch]:
    kept = len(fitted.values)
    for batch in batches:
        for a in range(0, batch.num_rows, 1024):
            part = batch.slice(a, 1024)
            z, y = fitted.centred(part)
            w, rows = fitted.project(y), part.num_rows
            at = pa.array(np.repeat(np.arange(rows), kept))
            yield pa.RecordBatch.from_arrays(
                [
                    part["vec_id"].take(at),
                    pa.array(np.tile(np.arange(1, kept + 1, dtype=np.int32), rows)),
                    pa.array(np.full(rows * kept, fitted.n, np.int64)),
                    pa.array(fitted.deviations(z), pa.int64()).take(at),
                    pa.array(w.reshape(-1), pa.float64(), from_pandas=True),  # NaN: null
                    pa.array(np.tile(fitted.explained, rows)),
                    pa.array(np.full(rows * kept, error)),
                ],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )


_COLUMNS = "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"


def whiten(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """Every usable row of ``vectors`` (vec_id, embedding) on the leading components, scaled to variance one.

    Returns vec_id, component (from 1, by falling eigenvalue), n, deviation, whitened, explained
    and identity_error.  All usable rows are fitted.

    Rows are left out whose vector is null or has an entry that is null, not finite, or of
    2**55 and more in size, and, if the lengths of vectors differ, all but those of the most
    frequent length (the longest of equally frequent ones), as a covariance needs one length.
    A component without variance has null in ``whitened``; a deviation beyond a long is
    null.  Null and repeated ids and repeated vectors are rows of their own.  A table
    without usable rows gives no rows; further columns are ignored.
    """
    rows = usable(vectors)
    size = F.size("embedding").alias("size")
    lengths = rows.groupBy(size).count().orderBy(F.col("count").desc(), F.col("size").desc()).head()
    dimension = lengths["size"] if lengths else 0
    rows = rows.where(F.size("embedding") == dimension)
    fitted = fit(rows, dimension, components) if dimension else None
    if fitted is None:
        return vectors.sparkSession.createDataFrame([], _COLUMNS)
    return rows.mapInArrow(partial(_whitened, fitted=fitted, error=identity_error(rows, fitted)), _COLUMNS)
