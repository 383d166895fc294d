"""Whitening of embeddings: Welford's updates in partitions, merged by the parallel formula, and a symmetric QR eigen-solve.

Entries become whole numbers, floor(64 * entry) + 1,000,000. Means and covariances are over the fit list, which holds every
distinct vector once. A task keeps one state of n, means, centred products and exact sums, updated by each vector in turn
(rank one); states are merged in groups of FAN by one shuffle per level until one is left, so no task and not the driver
sees more than FAN of them. The covariance matrix is as large as the square of a vector's length, whatever the number of
rows; its eigenvectors are found on the driver by Householder tridiagonalisation and implicitly shifted QR steps. Rows are
projected where they are.

Rows without a vector, with null or non-finite entries, or with entries beyond 2**55 (no exact whole numbers) are dropped. If
lengths differ, the most frequent one counts (of equally many the longest), others are dropped. Repeated rows and copies
are all kept and get equal values; null ids are kept. Components whose eigenvalue is below 1e-10 of the largest can't be
told from rounding and aren't given, so equal vectors, one row or an empty table give no rows. Ties of eigenvalues: any
orthonormal basis, the same for all rows. A deviation that doesn't fit a long is null. Very long vectors: a state has the
square of their length. Columns of the input other than those named are not read; clashing names do no harm.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.llm.common import arrow_bounds, lean, settled, table

SCALE, SHIFT = 64, 1_000_000
#: Entries beyond this (times SCALE) are no exact whole numbers with room for SHIFT.
LARGEST = 2.0**61
#: Components at most.
TOP = 16
#: States merged by one group.
FAN = 32
#: Eigenvalues below this share of the largest are rounding.
NOISE = 1e-10
STATES = "part int, n bigint, mean array<double>, products array<double>, high array<bigint>, low array<bigint>"
STATE_TYPES = pa.schema([("part", pa.int32()), ("n", pa.int64()), ("mean", pa.list_(pa.float64())), ("products", pa.list_(pa.float64())), ("high", pa.list_(pa.int64())), ("low", pa.list_(pa.int64()))])


@dataclass
class State:
    """n vectors: their means, the sums of centred products, and exact sums in two parts (of 2**26 and of 1)."""

    n: int
    mean: np.ndarray
    products: np.ndarray
    high: np.ndarray
    low: np.ndarray

    @classmethod
    def empty(cls, d: int) -> State:
        return cls(0, np.zeros(d), np.zeros((d, d)), np.zeros(d, np.int64), np.zeros(d, np.int64))

    def add(self, vector: np.ndarray) -> None:
        """Welford's update by one vector."""
        self.n += 1
        delta = vector - self.mean
        self.mean += delta / self.n
        self.products += np.multiply.outer(delta, delta * ((self.n - 1) / self.n))

    def merge(self, other: State) -> None:
        """The parallel update formula."""
        n = self.n + other.n
        delta = other.mean - self.mean
        self.mean += delta * (other.n / n)
        self.products += other.products + np.multiply.outer(delta, delta) * (self.n * other.n / n)
        self.n = n
        self.high += other.high
        self.low += other.low

    @property
    def sums(self) -> list[int]:
        return [(int(h) << 26) + int(w) for h, w in zip(self.high, self.low, strict=True)]

    @property
    def covariance(self) -> np.ndarray:
        return (self.products + self.products.T) / (2 * self.n)

    def row(self, part: int) -> pa.RecordBatch:
        values = [part, self.n, self.mean, self.products.ravel(), self.high, self.low]
        return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, STATE_TYPES, strict=True)], schema=STATE_TYPES)


def _matrix(lists: pa.Array, d: int) -> np.ndarray:
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def _welford(d: int, shift: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        state = State.empty(d)
        for b in batches:
            rows = _matrix(b.column(0), d)
            for vector in (rows - shift).astype(np.float64):
                state.add(vector)
            if rows.dtype.kind == "i":
                state.high += (rows >> 26).sum(axis=0)
                state.low += (rows & ((1 << 26) - 1)).sum(axis=0)
        if state.n:
            yield state.row(TaskContext.get().partitionId())

    return run


def _state(row: dict, d: int) -> State:
    return State(row["n"], np.array(row["mean"]), np.array(row["products"]).reshape(d, d), np.array(row["high"], np.int64), np.array(row["low"], np.int64))


def _merged(d: int):
    def run(states: pa.Table) -> pa.Table:
        rows = sorted(states.to_pylist(), key=lambda r: r["part"])
        total = _state(rows[0], d)
        for r in rows[1:]:
            total.merge(_state(r, d))
        return pa.Table.from_batches([total.row(rows[0]["part"] // FAN)])

    return run


def moments(vectors: DataFrame, d: int, *, shift: int = 0) -> State | None:
    """n, means and centred products of all vectors (one column, arrays of d numbers); whole numbers are summed exactly too."""
    states = settled(vectors.mapInArrow(lean(_welford(d, shift)), STATES), "whitening-states")
    top = states.agg(F.max("part")).first()[0]
    if top is None:
        return None
    while top > 0:
        states = settled(states.groupBy(F.expr(f"part div {FAN}")).applyInArrow(_merged(d), STATES), "whitening-states")
        top //= FAN
    return _state(states.first().asDict(), d)


def symmetric_qr(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors (rows) of a symmetric matrix: tridiagonal by Householder, then QR steps with Wilkinson's shift."""
    a, n = np.array(matrix, np.float64), len(matrix)
    q = np.eye(n)
    for k in range(n - 2):
        v = a[k + 1 :, k].copy()
        v[0] += np.copysign(np.linalg.norm(v), v[0])
        length = np.linalg.norm(v)
        if length:
            v /= length
            a[k + 1 :] -= 2 * np.outer(v, v @ a[k + 1 :])
            a[:, k + 1 :] -= 2 * np.outer(a[:, k + 1 :] @ v, v)
            q[k + 1 :] -= 2 * np.outer(v, v @ q[k + 1 :])
    d, e = np.diag(a).tolist(), np.diag(a, 1).tolist()
    eps = float(np.finfo(np.float64).eps)
    floor = eps * eps * max(map(abs, d + e), default=0.0)
    high, steps = n - 1, 0
    while high > 0:
        for i in range(high):
            if abs(e[i]) <= max(eps * (abs(d[i]) + abs(d[i + 1])), floor):
                e[i] = 0.0
        if e[high - 1] == 0.0:
            high -= 1
            continue
        low = high - 1
        while low > 0 and e[low - 1] != 0.0:
            low -= 1
        steps += 1
        if steps > 60 * n:
            raise ArithmeticError("the QR steps don't converge")
        half = (d[high - 1] - d[high]) / 2
        shift = d[high] - e[high - 1] ** 2 / (half + np.copysign(np.hypot(half, e[high - 1]), half))
        x, z = d[low] - shift, e[low]
        for k in range(low, high):
            r = float(np.hypot(x, z))
            c, s = (x / r, z / r) if r else (1.0, 0.0)
            if k > low:
                e[k - 1] = r
            dk, ek, dn = d[k], e[k], d[k + 1]
            d[k] = c * c * dk + 2 * c * s * ek + s * s * dn
            d[k + 1] = s * s * dk - 2 * c * s * ek + c * c * dn
            e[k] = c * s * (dn - dk) + (c * c - s * s) * ek
            q[[k, k + 1]] = np.array([[c, s], [-s, c]]) @ q[[k, k + 1]]
            if k < high - 1:
                x, z = e[k], s * e[k + 1]
                e[k + 1] = c * e[k + 1]
    order = np.argsort(-np.array(d), kind="stable")
    return np.array(d)[order], q[order]


@dataclass
class Whitening:
    """What was learned: the fit list's size and sums, components as rows, their eigenvalues and shares of the trace."""

    n: int
    sums: list[int]
    components: np.ndarray
    eigenvalues: np.ndarray
    explained: np.ndarray


def quantised(df: DataFrame, vector: str, keep: list[str]) -> DataFrame:
    """The columns in keep and x, the vectors as whole numbers; rows that have none are dropped."""
    own = df.select(*keep, F.col(vector).cast("array<double>").alias("__v"))
    good = own.where(F.col("__v").isNotNull() & F.forall("__v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c * SCALE) < LARGEST)))
    return good.select(*keep, F.transform("__v", lambda c: F.floor(c * SCALE).cast("bigint") + SHIFT).alias("x"))


def dimension(rows: DataFrame) -> int | None:
    """The most frequent length of x, of equally frequent ones the greatest; None without rows."""
    found = rows.groupBy(F.size("x").alias("d")).count().where("d > 0").orderBy(F.desc("count"), F.desc("d")).first()
    return found["d"] if found else None


def fitted(fit: DataFrame, d: int, top: int = TOP) -> Whitening | None:
    """The whitening of a fit list (x)."""
    state = moments(fit.select("x"), d, shift=SHIFT)
    if state is None:
        return None
    values, vectors = symmetric_qr(state.covariance)
    many = min(top, int((values > NOISE * max(values[0], 0.0)).sum()))
    trace = float(np.trace(state.covariance))
    return Whitening(state.n, state.sums, vectors[:many], values[:many], values[:many] / trace if many else values[:0])


def _deviations(rows: np.ndarray, model: Whitening) -> tuple[np.ndarray, list[int | None]]:
    """n * x - S and the sums of its squares, exact at any size."""
    n, d = model.n, rows.shape[1]
    largest = n * int(np.abs(rows).max(initial=0)) + max(map(abs, model.sums), default=0)
    wide = largest >= 1 << 62
    far = rows.astype(object) * n - np.array(model.sums, object) if wide else rows * n - np.array(model.sums, np.int64)
    most = int(np.abs(far).max(initial=0))
    if d * most * most < 1 << 63:
        return far, np.einsum("ij,ij->i", far, far).tolist() if not wide else [int(v) for v in (far * far).sum(axis=1)]
    squares = [sum(int(v) ** 2 for v in row) for row in far]
    return far, [v if v < 1 << 63 else None for v in squares]


def _projected(model: Whitening, d: int, names: list[str]) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        roots = np.sqrt(model.eigenvalues)
        for b in batches:
            rows = _matrix(b.column(len(names)), d)
            far, deviation = _deviations(rows, model)
            white = (far / model.n).astype(np.float64) @ model.components.T / roots
            offsets = np.arange(0, white.size + 1, len(roots), dtype=np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(white.ravel()))
            yield pa.RecordBatch.from_arrays([*b.columns[: len(names)], pa.array(deviation, pa.int64()), lists], names=[*names, "deviation", "whitened"])

    return run


def whitened(rows: DataFrame, model: Whitening, d: int, keep: list[str]) -> DataFrame:
    """The columns in keep, deviation and whitened (an entry per component) of rows with x."""
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*keep).schema), "deviation bigint", "whitened array<double>"])
    return rows.where(F.size("x") == d).select(*keep, "x").mapInArrow(lean(_projected(model, d, keep)), schema)


def identity_error(fit: DataFrame, model: Whitening, d: int) -> float:
    """The largest absolute entry of the fit list's whitened covariance minus the identity."""
    state = moments(whitened(fit, model, d, []).select("whitened"), len(model.eigenvalues))
    return float(np.abs(state.covariance - np.eye(len(model.eigenvalues))).max())


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every embedding whitened, a row for each component."""
    arrow_bounds(spark)
    rows = settled(quantised(table(spark, sf_dir, "embeddings"), "embedding", ["vec_id"]), "whitening-rows")
    d = dimension(rows)
    fit = settled(rows.where(F.size("x") == d).select("x").distinct(), "whitening-fit") if d else None
    model = fitted(fit, d) if d else None
    if model is None or not len(model.eigenvalues):
        nothing = "component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
        return rows.where("false").select("vec_id", *(F.lit(None).cast(c.split()[1]).alias(c.split()[0]) for c in nothing.split(", ")))
    error = identity_error(fit, model, d)
    out = whitened(rows, model, d, ["vec_id"]).select("vec_id", "deviation", F.posexplode("whitened").alias("i", "whitened"))
    shares = F.array(*(F.lit(float(v)) for v in model.explained))
    return out.select("vec_id", (F.col("i") + 1).alias("component"), F.lit(model.n).cast("bigint").alias("n"), "deviation", "whitened", F.get(shares, F.col("i")).alias("explained"), F.lit(error).alias("identity_error"))
