"""Embedding whitening on the leading principal components.

Entries become whole numbers, so sums and the covariance are exact whatever the partitions. The fit
list holds each distinct vector once: vectors are packed into bytes and made distinct by Spark, which
folds copies before the shuffle. Partial sums leave a task as one row per entry of the matrix. The
covariance (dimensions squared, whatever the number of rows) is solved on the driver by `inertia`.

Rows whose vector is NULL, empty or holds a NULL or non-finite entry are dropped, as are vectors of
another length than the most common one of the fit list (the shorter on a tie). Repeated rows and
ids stay, each with its own result. A covariance of lower rank has fewer components; one distinct
vector, or none, has none, so the result is empty. A deviation too large for a long is NULL, entries
beyond 2**62 count as 2**62. Further columns are carried in `row` and not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F, types as T

from .inertia import leading
from .store import written

STEP, ZERO = 64, 1_000_000
LARGEST = 2.0 ** 62
WHOLE = pa.decimal128(38, 0)


def grid(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Grid places (without the common offset) of all entries of the usable vectors, those rows, and their lengths."""
    length = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    values = pc.fill_null(column.flatten().cast(pa.float64()), np.nan).to_numpy(zero_copy_only=False)
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(values))])
    ends = np.cumsum(length)
    fit = (bad[ends] == bad[ends - length]) & (length > 0)
    places = np.floor(np.clip(STEP * np.where(np.isfinite(values), values, 0.0), -LARGEST, LARGEST)).astype(np.int64)
    return places[np.repeat(fit, length)], np.flatnonzero(fit), length[fit]


def matrices(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, their vectors as a matrix) for each length that occurs."""
    places, rows, length = grid(column)
    row = np.repeat(np.arange(len(rows)), length)
    for size in np.unique(length):
        own = length == size
        yield rows[own], places[own[row]].reshape(-1, size)


def packed(matrix: np.ndarray) -> list[bytes]:
    """Each vector as bytes: two per entry where they hold it, else eight; the last byte says which."""
    small = (np.abs(matrix) < 1 << 15).all(axis=1)
    narrow = matrix.astype("<i2")
    return [narrow[k].tobytes() + b"2" if s else matrix[k].astype("<i8").tobytes() + b"8" for k, s in enumerate(small.tolist())]


def unpacked(column: pa.Array, size: int) -> np.ndarray:
    out = np.empty((len(column), size), dtype=np.int64)
    for k, data in enumerate(column.to_pylist()):
        out[k] = np.frombuffer(data[:-1], dtype="<i2" if data[-1:] == b"2" else "<i8")
    return out


def fit_list(rows: DataFrame, vector: Column) -> DataFrame:
    """Distinct usable vectors, packed, with their length."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, matrix in matrices(batch.column(0)):
                yield pa.record_batch([pa.array([matrix.shape[1]] * len(matrix), pa.int32()), pa.array(packed(matrix), pa.binary())],
                                      names=["size", "packed"])

    return rows.select(vector.alias("v")).mapInArrow(pack, "size int, packed binary").distinct()


def products(matrix: np.ndarray) -> np.ndarray:
    """Exact sums of products of all pairs of columns."""
    most = int(np.abs(matrix).max(initial=0))
    if most * most * max(len(matrix), 1) < 1 << 53:
        dense = matrix.astype(float)
        return (dense.T @ dense).astype(np.int64).astype(object)
    dense = matrix.astype(object)
    return dense.T @ dense


def _summed(fit: DataFrame, size: int, partial, kind: pa.DataType, of: str) -> dict[int, object]:
    """Sums over the fit list of the flat arrays that `partial` makes of a batch of vectors."""
    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                own = partial(unpacked(batch.column(0), size))
                total = own if total is None else total + own
        if total is not None:
            values = pa.array([str(x) for x in total], pa.string()).cast(kind) if kind == WHOLE else pa.array(total, kind)
            yield pa.record_batch([pa.array(np.arange(len(total)), pa.int32()), values], names=["at", "x"])

    rows = fit.select("packed").mapInArrow(sums, f"at int, x {of}").groupBy("at").agg(F.sum("x").alias("x"))
    return {r["at"]: r["x"] for r in rows.collect()}   # as many rows as the array has entries


class Whitening:
    """Exact sums, covariance, components and their check for one table of vectors."""

    def __init__(self, rows: DataFrame, vector: Column, components: int):
        fit = written(fit_list(rows, vector), "fit-list")
        most = fit.groupBy("size").count().orderBy(F.desc("count"), "size").first()
        self.size = size = most["size"] if most else 0
        self.n = n = most["count"] if most else 0
        self.values, self.vectors, self.error = np.zeros(0), np.zeros((size, 0)), 0.0
        if not n:
            return
        fit = fit.where(F.col("size") == size)
        total = _summed(fit, size, lambda m: m.sum(axis=0).astype(object) if np.abs(m).max() < 1 << 40 else m.astype(object).sum(axis=0),
                        WHOLE, "decimal(38,0)")
        places = [int(total[k]) for k in range(size)]
        self.sums = [s + n * ZERO for s in places]
        # Centring by whole numbers keeps the products exact; what is left of the means is taken off in whole numbers, too.
        self.centre = centre = np.array([(2 * s + n) // (2 * n) for s in places], dtype=np.int64)
        self.left = left = [s - n * int(c) for s, c in zip(places, centre, strict=True)]
        upper = np.triu_indices(size)
        cross = _summed(fit, size, lambda m: products(m - centre)[upper], WHOLE, "decimal(38,0)")
        self.covariance = np.zeros((size, size))
        for at, (i, j) in enumerate(zip(*map(np.ndarray.tolist, upper), strict=True)):
            self.covariance[i, j] = self.covariance[j, i] = (n * int(cross[at]) - left[i] * left[j]) / (n * n)
        self.values, self.vectors = leading(self.covariance, components)
        k = len(self.values)
        if k:
            seen = _summed(fit, size, lambda m: (lambda w: (w.T @ w).reshape(-1))(self.scores(m)), pa.float64(), "double")
            own = np.array([seen[at] for at in range(k * k)]).reshape(k, k) / n
            self.error = float(np.abs(own - np.eye(k)).max())

    def scores(self, matrix: np.ndarray) -> np.ndarray:
        return (self._off(matrix) / self.n).astype(float) @ self.vectors / np.sqrt(self.values)

    def deviations(self, matrix: np.ndarray) -> list[int | None]:
        off = self._off(matrix)
        if off.dtype != object:
            most = int(np.abs(off).max(initial=0))
            off = off if most * most * self.size < 1 << 63 else off.astype(object)
        return [int(x) if x < 1 << 63 else None for x in (off * off).sum(axis=1).tolist()]

    def _off(self, matrix: np.ndarray) -> np.ndarray:
        """n times each entry's distance from its mean, exactly."""
        own = matrix - self.centre
        most = self.n * int(np.abs(own).max(initial=0)) + max(map(abs, self.left), default=0)
        if most < 1 << 62:
            return self.n * own - np.array(self.left, dtype=np.int64)
        return self.n * own.astype(object) - np.array(self.left, dtype=object)


def whitened(rows: DataFrame, vector: str = "embedding", components: int = 16, carry: Sequence[str] = ()) -> DataFrame:
    """row (the carried columns), component, n, deviation, whitened, explained, identity_error: one row per
    usable vector and component."""
    named = F.struct(*[F.col(f"`{c}`").alias(c) for c in carry], F.lit(0).alias("_")).alias("row")
    fitted = Whitening(rows, F.col(f"`{vector}`"), components)
    k, size = len(fitted.values), fitted.size
    trace = float(np.trace(fitted.covariance)) if fitted.n else 0.0
    explained = fitted.values / trace if k else fitted.values

    def whiten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for own, matrix in matrices(batch.column(1)) if k else ():
                if matrix.shape[1] == size:
                    m = len(own)
                    yield pa.record_batch([
                        batch.column(0).take(pa.array(np.repeat(own, k))), pa.array(np.tile(np.arange(1, k + 1), m), pa.int32()),
                        pa.array([d for d in fitted.deviations(matrix) for _ in range(k)], pa.int64()),
                        pa.array(fitted.scores(matrix).reshape(-1)), pa.array(np.tile(explained, m))],
                        names=["row", "component", "deviation", "whitened", "explained"])

    data = rows.select(named, F.col(f"`{vector}`").alias("v"))
    kinds = T.StructType([data.schema["row"], T.StructField("component", T.IntegerType()), T.StructField("deviation", T.LongType()),
                          T.StructField("whitened", T.DoubleType()), T.StructField("explained", T.DoubleType())])
    return data.mapInArrow(whiten, kinds).select(
        "row", "component", F.lit(fitted.n).cast("bigint").alias("n"), "deviation", "whitened", "explained",
        F.lit(fitted.error).alias("identity_error"))
