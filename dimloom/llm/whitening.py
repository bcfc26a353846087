"""Whitening of embeddings: leading principal components at unit variance, from a distributed covariance.

1. Entries become integers x = floor(64 c) + 1,000,000; a vector is kept as its differences from 1,000,000 in the narrowest integer
   type that holds them, so equal vectors are equal bytes. The fit list is the distinct ones.
2. Sums per dimension are exact. Each task centres its vectors (the whole part of S/n as integers, the rest as a double) before it
   multiplies; its partial matrix goes to one of a few adding tasks, and the driver adds what these return: a bounded number of
   matrices of dimension squared.
3. On the driver the covariance is made tridiagonal by Householder reflections; bisection with Sturm counts finds the leading
   eigenvalues, inverse iteration their vectors, orthogonalised again within clusters of close eigenvalues.
4. The projection, one column a component over the root of its eigenvalue, is broadcast. The error of the whitened covariance is
   measured by one more pass over the fit list.

Defined results: vectors that are null or hold null or non-finite entries are dropped; so are vectors of another length than the commonest
(of equals the longest), since no covariance spans both; integers beyond 2**61 count as 2**61; rows of equal id and rows with a null
id are returned as they are; components whose variance is within rounding of zero (under `NO_VARIANCE` of the first) can't be
scaled to 1 and aren't returned, so a table of equal vectors, like an empty one, gives no rows. `deviation` is null where it
exceeds a long; `deviation_exact` has it in decimal text always. Other columns aren't read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import saved, table
from .vectors import by_length, vectors

SCALE, OFFSET, LIMIT = 64, 1_000_000, float(2**61)
COMPONENTS = 16
#: A component of at most this share of the first one's variance has none that rounding leaves visible.
NO_VARIANCE = 1e-10
#: Entries of vectors that a task takes at a time; bytes of matrices that reach the driver.
SLICE, MATRICES = 1 << 20, 1 << 27


def _packed(rows: DataFrame) -> DataFrame:
    """(id, d, x) of the usable rows of (id, vector): length, and packed differences from OFFSET."""
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, raw in by_length(*vectors(batch.column(1))):
                with np.errstate(over="ignore"):
                    x = np.clip(np.floor(SCALE * raw), -LIMIT, LIMIT).astype(np.int64)
                most = np.where(x < 0, -(x + 1), x).max(axis=1)
                packed = np.empty(len(x), object)
                width = np.searchsorted([1 << 7, 1 << 15, 1 << 31], most, side="right")  # the power of two of its bytes
                for w in np.unique(width):
                    fits = np.flatnonzero(width == w)
                    for i, row in zip(fits, x[fits].astype(f"<i{1 << w}")):
                        packed[i] = row.tobytes()
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at)), pa.array(np.full(len(at), x.shape[1]), pa.int32()), pa.array(packed, pa.binary())], names=["id", "d", "x"])

    return rows.mapInArrow(run, f"id {kind}, d int, x binary")


def unpacked(column: pa.Array, d: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, differences from OFFSET) of packed vectors, a slice at a time."""
    width = pa.compute.binary_length(column).to_numpy(zero_copy_only=False) // d
    step = max(1, SLICE // d)
    for w in np.unique(width):
        rows = np.flatnonzero(width == w)
        for at in range(0, len(rows), step):
            some = rows[at : at + step]
            raw = b"".join(column.take(pa.array(some)).to_pylist())
            yield some, np.frombuffer(raw, f"<i{w}").astype(np.int64).reshape(-1, d)


def _sums(fit: DataFrame, d: int) -> tuple[int, list[int]]:
    """Number of vectors, and exact sums of the differences from OFFSET by dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, np.zeros((2, d), np.int64)
        for batch in batches:
            for _, x in unpacked(batch.column(0), d):
                n += len(x)
                total += np.stack(((x >> 31).sum(axis=0), (x & (2**31 - 1)).sum(axis=0)))
        # place -1 holds the number of vectors
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(-1, d)), pa.array(np.append(0, total[0])), pa.array(np.append(n, total[1]))], names=["place", "high", "low"])

    parts = fit.select("x").mapInArrow(run, "place long, high long, low long").groupBy("place").agg(F.sum("high").alias("high"), F.sum("low").alias("low"))
    got = {r["place"]: (r["high"] << 31) + r["low"] for r in parts.collect()}  # one row a dimension
    return got.pop(-1, 0), [got[i] for i in range(d)] if got else []


class Centre:
    """Subtracts S/n: the whole part exactly, the rest as a double."""

    def __init__(self, n: int, sums: list[int]):
        self.n = n
        self.whole = np.array([s // n for s in sums], np.int64)
        self.rest = np.array([s % n for s in sums], np.int64)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return (x - self.whole).astype(np.float64) - self.rest / self.n

    def deviation(self, x: np.ndarray) -> list[int]:
        """Sum over dimensions of (n x - S)**2, exactly."""
        near = x - self.whole
        most = (int(np.abs(near).max(initial=0)) + 1) * self.n
        if x.shape[1] * most * most < 1 << 63:
            return ((self.n * near - self.rest) ** 2).sum(axis=1).tolist()
        return ((self.n * near.astype(object) - self.rest.astype(object)) ** 2).sum(axis=1).tolist()


def _products(fit: DataFrame, d: int, made, width: int) -> np.ndarray:
    """Sum of made(x).T @ made(x) over all vectors of the fit list: partial matrices of tasks, added by a few tasks, then here."""
    adders = max(1, min(32, MATRICES // (8 * width * width)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            for _, x in unpacked(batch.column(0), d):
                y = made(x)
                total += y.T @ y
        yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId() % adders], pa.int32()), pa.array([total.tobytes()])], names=["adder", "total"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for part in batch.column(0):
                part = np.frombuffer(part.as_buffer()).reshape(width, width)
                total = part.copy() if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()])], names=["total"])

    parts = fit.select("x").mapInArrow(run, "adder int, total binary").repartition(adders, "adder").select("total")
    return sum((np.frombuffer(r["total"]).reshape(width, width) for r in parts.mapInArrow(add, "total binary").collect()), np.zeros((width, width)))


# -- eigenvalues and vectors of a symmetric matrix, on the driver ---------


def tridiagonal(v: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """(diagonal, beside, reflectors): v = Q T Q' with Q the product of the Householder reflections I - 2 w w'."""
    a = v.copy()
    n, reflectors = len(a), []
    for k in range(n - 2):
        w = a[k + 1 :, k].copy()
        size = np.sqrt(w @ w)
        if size > 0:
            w[0] += np.copysign(size, w[0])
            w /= np.sqrt(w @ w)
            rest = a[k + 1 :, k + 1 :]
            p = rest @ w
            p -= (w @ p) * w
            rest -= 2 * (np.outer(w, p) + np.outer(p, w))
            a[k + 1 :, k] -= 2 * w * (w @ a[k + 1 :, k])
        reflectors.append(w)
    return np.diag(a).copy(), np.diag(a, -1).copy(), reflectors


def sturm_count(diagonal: np.ndarray, beside: np.ndarray, at: np.ndarray) -> np.ndarray:
    """How many eigenvalues of a tridiagonal matrix are below each value of `at`."""
    tiny = np.finfo(float).tiny / np.finfo(float).eps
    below, q = np.zeros(len(at), np.int64), np.ones(len(at))
    for i, a in enumerate(diagonal):
        q = a - at - (beside[i - 1] ** 2 / q if i else 0)
        q = np.where(np.abs(q) < tiny, -tiny, q)
        below += q < 0
    return below


def leading_values(diagonal: np.ndarray, beside: np.ndarray, k: int) -> np.ndarray:
    """The k largest eigenvalues, falling, by bisection of Gershgorin's interval down to rounding."""
    n = len(diagonal)
    reach = np.abs(np.append(beside, 0)) + np.abs(np.append(0, beside))
    low, high = np.full(k, (diagonal - reach).min()), np.full(k, (diagonal + reach).max())
    wide = max(abs(low[0]), abs(high[0]))
    low, high = low - wide * 1e-15 - 1e-300, high + wide * 1e-15 + 1e-300
    rank = n - 1 - np.arange(k)  # eigenvalues below the one sought
    for _ in range(1100):
        middle = low + (high - low) / 2
        if ((middle <= low) | (middle >= high)).all():
            break
        under = sturm_count(diagonal, beside, middle) <= rank
        low, high = np.where(under, middle, low), np.where(under, high, middle)
    return low + (high - low) / 2


def _solve(diagonal: np.ndarray, beside: np.ndarray, at: float, right: np.ndarray, tiny: float) -> np.ndarray:
    """Solution of (T - at) y = right by elimination with row exchanges; pivots of zero become tiny."""
    n = len(diagonal)
    d, up, up2, x = diagonal - at, np.append(beside, 0.0), np.zeros(n), right.copy()
    for i in range(n - 1):
        low = beside[i]
        if abs(d[i]) >= abs(low):
            if d[i] == 0:
                d[i] = tiny
            m = low / d[i]
            d[i + 1] -= m * up[i]
            x[i + 1] -= m * x[i]
        else:
            m = d[i] / low
            d[i], old = low, up[i]
            up[i], d[i + 1] = d[i + 1], old - m * d[i + 1]
            if i + 1 < n - 1:
                up2[i], up[i + 1] = up[i + 1], -m * up[i + 1]
            x[i], x[i + 1] = x[i + 1], x[i] - m * x[i + 1]
    if abs(d[-1]) < tiny:
        d[-1] = tiny
    x[-1] /= d[-1]
    if n > 1:
        x[-2] = (x[-2] - up[-2] * x[-1]) / (d[-2] if abs(d[-2]) >= tiny else tiny)
    for i in range(n - 3, -1, -1):
        x[i] = (x[i] - up[i] * x[i + 1] - up2[i] * x[i + 2]) / (d[i] if abs(d[i]) >= tiny else tiny)
        if abs(x[i]) > 1e150:
            x /= abs(x[i])
    return x


def leading_vectors(diagonal: np.ndarray, beside: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit eigenvectors (columns) of the tridiagonal matrix for falling eigenvalues, by inverse iteration. Vectors of a cluster, where each
    eigenvalue is within a thousandth of the norm of the one before, are made orthogonal to each other at every step."""
    n, rng = len(diagonal), np.random.default_rng(7)
    norm = max(np.abs(diagonal).max(), np.abs(beside).max(initial=0), np.finfo(float).tiny)
    tiny, out, first, last = norm * np.finfo(float).eps, [], 0, None
    for j, value in enumerate(values):
        if j and values[j - 1] - value > 1e-3 * norm:
            first = j
        # equal eigenvalues are told apart a little, so that the solutions differ
        at = value if last is None or first == j else min(value, last - 4 * tiny)
        last, x = at, rng.standard_normal(n)
        for _ in range(6):
            x = _solve(diagonal, beside, at, x / np.sqrt(x @ x), tiny)
            x /= np.abs(x).max()
            for _ in range(2):
                for other in out[first:j]:
                    x -= (other @ x) * other
            x /= np.sqrt(x @ x)
        out.append(x)
    return np.array(out).T.reshape(n, len(out))


def principal(v: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, unit eigenvectors as columns) of the k leading components of a symmetric matrix, signs fixed by the largest entry."""
    diagonal, beside, reflectors = tridiagonal(v)
    values = leading_values(diagonal, beside, min(k, len(v)))
    found = leading_vectors(diagonal, beside, values)
    for i in range(len(reflectors) - 1, -1, -1):
        w = reflectors[i]
        found[i + 1 :] -= 2 * np.outer(w, w @ found[i + 1 :])
    sign = np.sign(found[np.abs(found).argmax(axis=0), np.arange(found.shape[1])])
    return values, found * sign


def whitened(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = COMPONENTS) -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error, deviation_exact): up to k rows for each usable row."""
    spark = rows.sparkSession
    named = rows.select(F.col(id_col).alias("id"), F.col(vector_col).alias("vector"))
    kind = named.schema["id"].dataType.simpleString()
    schema = f"id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double, deviation_exact string"
    packed = saved(_packed(named), "packed")
    length = packed.groupBy("d").count().orderBy(F.desc("count"), F.desc("d")).first()
    nothing = spark.createDataFrame([], schema).withColumnRenamed("id", id_col)
    if length is None:
        return nothing
    d = length["d"]
    packed = packed.filter(F.col("d") == d)
    fit = saved(packed.select("x").distinct(), "fit")
    n, sums = _sums(fit, d)
    centre = Centre(n, sums)
    v = _products(fit, d, centre, d) / n
    trace = float(np.trace(v))
    if not trace > 0:
        return nothing
    values, vectors_ = principal((v + v.T) / 2, k)
    held = values > NO_VARIANCE * values[0]
    values = values[held]
    shared = spark.sparkContext.broadcast(vectors_[:, held] / np.sqrt(values))  # d numbers a component

    def project(x: np.ndarray) -> np.ndarray:
        return centre(x) @ shared.value

    def with_one(x: np.ndarray) -> np.ndarray:
        y = project(x)
        return np.column_stack((y, np.ones(len(y))))

    moments = _products(fit, d, with_one, len(values) + 1) / n
    mean = moments[:-1, -1]
    error = float(np.abs(moments[:-1, :-1] - np.outer(mean, mean) - np.eye(len(values))).max())
    explained, count = values / trace, len(values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some, x in unpacked(batch.column(1), d):
                exact, y = centre.deviation(x), project(x)
                each = np.repeat(np.arange(len(some)), count)
                fits = pa.array([e if e < 1 << 63 else None for e in exact], pa.int64())
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).take(pa.array(some[each])), pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), len(some))), pa.array(np.full(len(each), n)),
                    fits.take(pa.array(each)), pa.array(y.ravel()), pa.array(np.tile(explained, len(some))), pa.array(np.full(len(each), error)),
                    pa.array([str(e) for e in exact]).take(pa.array(each)),
                ], names=["id", "component", "n", "deviation", "whitened", "explained", "identity_error", "deviation_exact"])

    return packed.select("id", "x").mapInArrow(run, schema).withColumnRenamed("id", id_col)


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whitened leading 16 components of every embedding."""
    return whitened(table(spark, sf_dir, "embeddings"))
