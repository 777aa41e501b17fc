"""Operator 12: embedding whitening from a polarisation covariance.

1. Moments: a vector's entries become whole numbers x. One pass gives the
   number of rows n and the exact sums S of every dimension.
2. Squares: with m the whole part of the mean and y = x - m, every task adds
   up the squares of y for each dimension and of y_i + y_j for each pair of
   dimensions, in whole numbers. A table row per dimension or pair and task is
   all that is shuffled; Spark sums them in two halves of 60 bits, so nothing
   is rounded or overflows.
3. Covariance: the exact sum of squared centred values of a sum of two
   dimensions, less those of each, is twice their cross term. The matrix is
   exact until its one rounding to double, then goes to ``eigh``.
4. Projection: one pass projects and scales, and another measures the result's
   covariance. The driver holds d * d numbers, whatever the number of rows.

Defined results: rows whose vector is null, or holds a null, NaN or infinite
entry, are dropped; of the others only those of the most frequent length above 0
(the larger of equally frequent ones) are kept; a product beyond a long is cut
to the nearest whole number that fits in 62 bits; components without variance
(to rounding) are left out, so constant vectors and empty tables give an empty
result; repeated rows count and return as often as they stand; a null vec_id
is an id like any other; a deviation beyond a long is null; other columns are
not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCALE, SHIFT, COMPONENTS = 64, 1_000_000, 32
HALF = 60                     # bits of the lower half of a sum
LIMIT = 1 << 62
SUMS = "item int, high decimal(38,0), low decimal(38,0)"


class Whitening(NamedTuple):
    """What rows need: exact n and sums, unit eigenvectors by falling eigenvalue."""

    n: int
    sums: list[int]
    values: np.ndarray        # eigenvalues, falling
    vectors: np.ndarray       # one unit eigenvector a row
    trace: float


def vectors(df: DataFrame, column: str = "embedding") -> DataFrame:
    """``vec_id, v`` (doubles) of the rows that hold finite numbers only."""
    v = F.col(column).cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return df.select(F.col("vec_id"), v.alias("v")).filter(F.col("v").isNotNull() & F.coalesce(finite.isNotNull() & finite, F.lit(False)))


def dimension(rows: DataFrame) -> int:
    """The most frequent length above 0 of ``v``, the larger of equal ones; 0 if none."""
    size = F.size("v")
    top = (rows.filter(size > 0).groupBy(size.alias("d")).agg(F.count("*").alias("rows"))
           .agg(F.max(F.struct("rows", "d")).alias("top")).first()["top"])
    return top["d"] if top else 0


def whole(batch: pa.RecordBatch, column: int, d: int) -> np.ndarray:
    """The x of a batch's vectors, a row each."""
    flat = batch.column(column).flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
    scaled = np.floor(flat * SCALE)
    return np.clip(scaled, -LIMIT, LIMIT - SHIFT - 1024).astype(np.int64) + SHIFT


def _exact(x: np.ndarray, rows: int) -> np.ndarray:
    """``x`` as it is where sums of squares of two entries' sums fit in 63 bits,
    else as Python's whole numbers."""
    top = max(int(x.max(initial=0)), -int(x.min(initial=0)))
    return x if 4 * top * top * max(rows, 1) < 1 << 62 else x.astype(object)


def _halves(items: list[int], sums: list[int]) -> pa.RecordBatch:
    kind = pa.decimal128(38, 0)
    return pa.RecordBatch.from_arrays(
        [pa.array(items, pa.int32()), pa.array([s >> HALF for s in sums], kind),
         pa.array([s & (1 << HALF) - 1 for s in sums], kind)], names=["item", "high", "low"])


def _collect(parts: DataFrame) -> dict[int, int]:
    """The exact sum of every item; as many rows as there are items."""
    total = parts.groupBy("item").agg(F.sum("high").alias("high"), F.sum("low").alias("low"))
    return {r["item"]: (int(r["high"]) << HALF) + int(r["low"]) for r in total.collect()}


def moments(rows: DataFrame, d: int) -> tuple[int, list[int]]:
    """(n, exact sum of every dimension)."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(d, dtype=object), 0
        for batch in batches:
            x = whole(batch, 0, d)
            total = total + _exact(x, len(x)).sum(axis=0).astype(object)
            n += len(x)
        if n:
            yield _halves([*range(d), d], [int(t) for t in total] + [n])

    found = _collect(rows.select("v").mapInArrow(add, SUMS))
    return found.get(d, 0), [found.get(i, 0) for i in range(d)]


def pair_squares(rows: DataFrame, means: list[int]) -> dict[int, int]:
    """Exact sums of squares: item ``i * d + j`` (i < j) of y_i + y_j, item
    ``i * d + i`` of y_i, where y = x - means."""
    d = len(means)
    at = [i * d + j for i in range(d) for j in range(i, d)]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, seen = np.zeros(len(at), dtype=object), False
        for batch in batches:
            if not batch.num_rows:
                continue
            seen = True
            x = whole(batch, 0, d)
            low = np.array(means, dtype=np.int64)
            spread = max(abs(int(x.max()) - min(means)), abs(max(means) - int(x.min())))
            y = _exact(x - low, len(x)) if spread < 1 << 62 else x.astype(object) - low.astype(object)
            found = []
            for i in range(d):
                found.append((y[:, i] * y[:, i]).sum(keepdims=True))
                pair = y[:, i:i + 1] + y[:, i + 1:]
                found.append((pair * pair).sum(axis=0))
            total = total + np.concatenate(found).astype(object)
        if seen:
            yield _halves(at, [int(t) for t in total])

    return _collect(rows.select("v").mapInArrow(add, SUMS))


def covariance(n: int, sums: list[int], squares: dict[int, int]) -> np.ndarray:
    """V with divisor n. Squares about the whole part of the mean become squares
    about the mean exactly: the remainder's share is taken off before rounding."""
    d = len(sums)
    rest = [s % n for s in sums]
    # n * sum of (x - S/n)^2, for a dimension and for a sum of two
    own = [n * squares[i * d + i] - rest[i] ** 2 for i in range(d)]
    v = np.empty((d, d))
    for i in range(d):
        v[i, i] = float(Fraction(own[i], n * n))
        for j in range(i + 1, d):
            both = n * squares[i * d + j] - (rest[i] + rest[j]) ** 2
            v[i, j] = v[j, i] = float(Fraction(both - own[i] - own[j], 2 * n * n))
    return v


def fit(rows: DataFrame) -> Whitening | None:
    """The whitening of all ``rows``; None if there is no row or no variance."""
    d = dimension(rows)
    rows = rows.filter(F.size("v") == d)
    n, sums = moments(rows, d) if d else (0, [])
    if not n:
        return None
    v = covariance(n, sums, pair_squares(rows, [s // n for s in sums]))
    e, u = np.linalg.eigh(v)
    e, u = e[::-1], u.T[::-1]
    real = e > max(e[0], 0) * d * np.finfo(float).eps * 8
    return Whitening(n, sums, e[real], u[real], float(np.trace(v))) if real.any() else None


def _centred(x: np.ndarray, w: Whitening) -> np.ndarray:
    """x - S/n in doubles: whole parts exactly, then the remainder."""
    whole_part = np.array([s // w.n for s in w.sums], dtype=np.int64)
    rest = np.array([(s % w.n) / w.n for s in w.sums])
    return (x - whole_part).astype(float) - rest


def identity_error(rows: DataFrame, w: Whitening, components: int) -> float:
    """Largest absolute entry of the whitened rows' covariance minus the identity."""
    k, d = min(components, len(w.values)), len(w.sums)
    to = (w.vectors[:k] / np.sqrt(w.values[:k])[:, None]).T

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gram, mean = np.zeros((k, k)), np.zeros(k)
        for batch in batches:
            z = _centred(whole(batch, 0, d), w) @ to
            gram += z.T @ z
            mean += z.sum(axis=0)
        both = np.concatenate([gram.ravel(), mean])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(both), dtype=np.int32)), pa.array(both)], names=["item", "part"])

    parts = rows.filter(F.size("v") == d).select("v").mapInArrow(add, "item int, part double")
    total = np.zeros(k * k + k)
    for r in parts.groupBy("item").agg(F.sum("part").alias("part")).collect():
        total[r["item"]] = r["part"]
    mean = total[k * k:] / w.n
    return float(np.abs(total[:k * k].reshape(k, k) / w.n - np.outer(mean, mean) - np.eye(k)).max())


def _deviation(x: np.ndarray, w: Whitening) -> list[int | None]:
    """Exact sum over dimensions of (n x - S)^2; None where it exceeds a long."""
    low = np.array([s // w.n for s in w.sums], dtype=np.int64)
    rest = np.array([s % w.n for s in w.sums], dtype=object)
    y = x.astype(object) - low.astype(object)
    top = max((abs(int(v)) for v in (y.max(initial=0), y.min(initial=0))), default=0)
    if (w.n * (top + 1)) ** 2 * len(w.sums) < 1 << 62:
        z = y.astype(np.int64) * w.n - rest.astype(np.int64)
        return (z * z).sum(axis=1).tolist()
    found = ((y * w.n - rest) ** 2).sum(axis=1)
    return [int(f) if f < 1 << 63 else None for f in found]


def whiten(df: DataFrame, column: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """A row per kept row and component: ``vec_id, component, n, deviation,
    whitened, explained, identity_error``."""
    rows = vectors(df, column)
    kind = rows.schema["vec_id"].dataType.simpleString()
    schema = (f"vec_id {kind}, component int, n long, deviation long, whitened double, "
              "explained double, identity_error double")
    w = fit(rows)
    if w is None:
        return df.sparkSession.createDataFrame([], schema)
    k, d = min(components, len(w.values)), len(w.sums)
    error = identity_error(rows, w, k)
    to = (w.vectors[:k] / np.sqrt(w.values[:k])[:, None]).T
    explained = w.values[:k] / w.trace
    names = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 1000):
                part = batch.slice(start, 1000)
                x = whole(part, 1, d)
                size = len(x) * k
                each = np.repeat(np.arange(len(x)), k)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(each)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                     pa.array(np.full(size, w.n)), pa.array(_deviation(x, w), pa.int64()).take(pa.array(each)),
                     pa.array((_centred(x, w) @ to).ravel()), pa.array(np.tile(explained, len(x))),
                     pa.array(np.full(size, error))], names=names)

    return rows.filter(F.size("v") == d).select("vec_id", "v").mapInArrow(project, schema)
