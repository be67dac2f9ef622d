"""Whitening of embeddings with the leading eigenvectors of their covariance, found by contour integration (FEAST).

Rows are only summed on Spark: exact integer sums, then the centred covariance, a small matrix. Its leading eigenvalues are
bracketed by inertia counts and the brackets cut into intervals at wide gaps. For an interval, solves with the covariance
shifted to points on a circle around it, weighted by a quadrature rule, project a block of vectors onto the interval's
eigenvectors; Rayleigh-Ritz extracts these, and the block is projected again until nothing changes. The solves of all circles
are independent and run as Spark tasks. Inertia counts say how many eigenvalues each interval must hold.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelake.llm.base import settle

#: Quadrature points on the upper half of a circle.
POINTS = 8
#: Eigenvalues per interval, as far as gaps allow.
PER_INTERVAL = 4
#: Components whose variance is a smaller share of the largest one are noise of the arithmetic and have none.
FLOOR = 1e-10
ROUNDS = 60


def tridiagonal(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Diagonal and off-diagonal of an orthogonally similar tridiagonal matrix (Householder)."""
    a = a.copy()
    n = len(a)
    for k in range(n - 2):
        x = a[k + 1 :, k].copy()
        length = np.linalg.norm(x)
        if length == 0 or not np.any(x[1:]):
            continue
        x[0] += math.copysign(length, x[0])
        x /= np.linalg.norm(x)
        block = a[k + 1 :, k + 1 :]
        p = block @ x
        q = p - (x @ p) * x
        block -= 2 * (np.outer(x, q) + np.outer(q, x))
        a[k + 1 :, k] = a[k, k + 1 :] = 0
        a[k + 1, k] = a[k, k + 1] = -math.copysign(length, x[0])
    return np.diag(a).copy(), np.diag(a, -1).copy()


def count_above(diagonal: np.ndarray, off: np.ndarray, shifts: np.ndarray) -> np.ndarray:
    """How many eigenvalues lie above each shift: the positive pivots of the shifted matrix, by Sylvester's law of inertia."""
    tiny = np.finfo(float).eps * max(np.abs(diagonal).max(), np.abs(off).max(initial=0), np.finfo(float).tiny)
    pivot = diagonal[0] - shifts
    count = (pivot > 0).astype(np.int64)
    for d, e in zip(diagonal[1:], off):
        pivot = np.where(np.abs(pivot) < tiny, -tiny, pivot)
        pivot = d - shifts - e * e / pivot
        count += pivot > 0
    return count


def bracket(diagonal: np.ndarray, off: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` largest eigenvalues, falling, by bisection on inertia counts."""
    reach = np.abs(np.concatenate([[0], off])) + np.abs(np.concatenate([off, [0]]))
    low, high = np.full(n, (diagonal - reach).min()), np.full(n, (diagonal + reach).max())
    wanted = np.arange(n)
    for _ in range(56):
        middle = (low + high) / 2
        above = count_above(diagonal, off, middle) > wanted
        low, high = np.where(above, middle, low), np.where(above, high, middle)
    return (low + high) / 2


def intervals(diagonal: np.ndarray, off: np.ndarray, k: int) -> list[tuple[float, float, int]]:
    """(low, high, eigenvalues inside by inertia): disjoint, and together at least the ``k`` largest.

    Cuts lie in the middle of gaps. The last one is the widest among those just below the k-th; runs of more than
    ``PER_INTERVAL`` eigenvalues are cut at their widest gap, unless that is too narrow to be told from a multiple eigenvalue.
    """
    size, n = len(diagonal), k
    top = max(abs(bracket(diagonal, off, 1)[0]), np.finfo(float).tiny)
    while True:
        n = min(size, n + 9)
        near = bracket(diagonal, off, n)
        gaps = near[:-1] - near[1:]
        if n == size or gaps[k - 1 :].max() > 1e-9 * top:
            break
    bottom = near[-1] - 0.1 * top
    if size > k and gaps[k - 1 :].max() > 1e-9 * top:
        at = k - 1 + int(np.argmax(gaps[k - 1 :]))
        bottom, near = (near[at] + near[at + 1]) / 2, near[: at + 1]
        gaps = gaps[:at]
    cuts, todo = [near[0] + 0.1 * top, bottom], [(0, len(near))]
    while todo:
        first, last = todo.pop()
        inner = gaps[first : last - 1]
        if last - first > PER_INTERVAL and inner.max() > 1e-6 * top:
            at = first + int(np.argmax(inner)) + 1
            cuts.append((near[at - 1] + near[at]) / 2)
            todo += [(first, at), (at, last)]
    cuts = np.sort(np.array(cuts))[::-1]
    inside = np.diff(count_above(diagonal, off, cuts))
    return [(low, high, int(n)) for low, high, n in zip(cuts[1:], cuts[:-1], inside) if n]


def circle(low: float, high: float) -> tuple[np.ndarray, np.ndarray]:
    """Gauss-Legendre points and weights on the upper half circle over an interval.

    The projected block is the real part of the sum of weight × (z - V)⁻¹ Y; the lower half gives its conjugate.
    """
    x, w = np.polynomial.legendre.leggauss(POINTS)
    angle, radius = math.pi / 2 * (1 - x), (high - low) / 2
    turn = np.exp(1j * angle)
    return (low + high) / 2 + radius * turn, w * radius * turn / 2


def project(spark: SparkSession, v: np.ndarray, blocks: list[np.ndarray], shifts: list[tuple[np.ndarray, np.ndarray]]) -> list[np.ndarray]:
    """Each block projected by its circle: one row per quadrature point, solved in Spark tasks and summed.

    The matrix and the blocks go to the tasks; they grow with the square of the dimensions, not with the rows.
    """
    shared = spark.sparkContext.broadcast((v, blocks))
    rows = [(i, float(z.real), float(z.imag), float(w.real), float(w.imag)) for i, (points, weights) in enumerate(shifts) for z, w in zip(points, weights)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matrix, given = shared.value
        for batch in batches:
            out = []
            for i, zr, zi, wr, wi in zip(*(batch.column(c).to_pylist() for c in range(5))):
                solved = np.linalg.solve(complex(zr, zi) * np.eye(len(matrix)) - matrix, given[i].astype(complex))
                out.append((complex(wr, wi) * solved).real.astype("<f8").tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], ["i", "part"])

    frame = spark.createDataFrame(rows, "i int, zr double, zi double, wr double, wi double").repartition(min(len(rows), spark.sparkContext.defaultParallelism))
    total = [np.zeros_like(b) for b in blocks]
    for row in sorted(frame.mapInArrow(run, "i int, part binary").collect(), key=lambda r: (r.i, r.part)):
        total[row.i] += np.frombuffer(row.part, "<f8").reshape(total[row.i].shape)
    shared.destroy()
    return total


def feast(spark: SparkSession, v: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues of a symmetric matrix, falling, and their unit eigenvectors as columns.

    Eigenvalues below ``FLOOR`` times the largest, and those not positive, are left out. Raises if the eigenvectors found do not
    come to the number that inertia counts for their interval.
    """
    scale = np.abs(v).max() if v.size else 0.0
    k = min(k, len(v))
    if not scale or not k:
        return np.zeros(0), np.zeros((len(v), 0))
    a = v / scale
    diagonal, off = tridiagonal(a)
    norm = bracket(diagonal, off, 1)[0]
    k = min(k, int(count_above(diagonal, off, np.array([FLOOR * norm]))[0])) if norm > 0 else 0
    if not k:
        return np.zeros(0), np.zeros((len(v), 0))
    tight = 8 * np.finfo(float).eps * math.sqrt(len(a)) * norm
    parts = intervals(diagonal, off, k)
    rng = np.random.default_rng(20)
    blocks = [rng.standard_normal((len(a), min(len(a), 2 * n + 6))) for _, _, n in parts]
    shifts = [circle(low, high) for low, high, _ in parts]
    held: list[np.ndarray | None] = [None] * len(parts)
    before = [math.inf] * len(parts)
    for _ in range(ROUNDS):
        left = [i for i, x in enumerate(held) if x is None]
        if not left:
            break
        for i, block in zip(left, project(spark, a, [blocks[i] for i in left], [shifts[i] for i in left])):
            low, high, wanted = parts[i]
            q, _ = np.linalg.qr(block)
            values, turn = np.linalg.eigh(q.T @ a @ q)
            blocks[i] = q @ turn
            rest = np.linalg.norm(a @ blocks[i] - blocks[i] * values, axis=0)
            inside = (values > low) & (values < high) & (rest < 1e-10 * norm)
            if inside.sum() == wanted:
                # Done at the last digit, or where another round no longer helps.
                now = rest[inside].max()
                if now < tight or now > before[i] / 2:
                    held[i] = blocks[i][:, inside]
                before[i] = now
    if any(x is None for x in held):
        raise ArithmeticError("an interval holds other eigenvalues than inertia counts")
    # All intervals together once more, so that vectors of neighbouring intervals are orthogonal to the last digit.
    q, _ = np.linalg.qr(np.column_stack(held))
    values, turn = np.linalg.eigh(q.T @ a @ q)
    order = np.argsort(-values, kind="stable")[:k]
    return values[order] * scale, (q @ turn)[:, order]


@dataclass
class Whitening:
    """What fit() learned: exact sums, and the components."""

    n: int
    sums: np.ndarray  # Python integers
    trace: float
    values: np.ndarray
    vectors: np.ndarray

    @property
    def mean(self) -> np.ndarray:
        """Whole and fractional part of the mean, so that rows are centred without rounding first."""
        whole = np.array([s // self.n for s in self.sums], object)
        return np.array([[int(w) for w in whole], [(int(s) - int(w) * self.n) / self.n for s, w in zip(self.sums, whole)]], float) if self.n else np.zeros((2, 0))


def quantised(df: DataFrame, vector: str, step: int = 1024, shift: int = 100_000) -> DataFrame:
    """Rows whose vector takes part, with ``x``: floor(step × component) + shift, as longs.

    Null vectors and those with a null, NaN or infinite component take no part. A component beyond a long's range is an error.
    """
    bad = F.exists(vector, lambda c: c.isNull() | F.isnan(c) | (F.abs(c.cast("double")) == float("inf")))
    whole = F.transform(vector, lambda c: F.floor(c.cast("double") * F.lit(float(step))))
    far = F.exists(whole, lambda x: F.abs(x.cast("double")) > 2.0**60)
    safe = F.when(far, F.raise_error(F.lit("a component is too large to be quantised")).cast("array<bigint>")).otherwise(F.transform(whole, lambda x: x.cast("long") + F.lit(shift)))
    return df.where(F.col(vector).isNotNull()).where(~bad).withColumn("x", safe)


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    if (lengths != dims).any():
        raise ValueError(f"vectors of {dims} and of {int(lengths[lengths != dims][0])} components in one table")
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), dims)


def _centred(x: np.ndarray, mean: np.ndarray) -> np.ndarray:
    return (x - mean[0].astype(np.int64)).astype(float) - mean[1]


def _moments(frame: DataFrame, dims: int, rows_of) -> tuple[int, np.ndarray, np.ndarray]:
    """Number, mean and centred second moments of the rows that ``rows_of`` makes of each batch.

    A task merges its batches about their means, Spark's tasks hand over one row per matrix row, and these are merged the same
    way, a group per matrix row: no task holds more than its own moments or one row of each.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, mean, moment = 0, np.zeros(dims), np.zeros((dims, dims))
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                y = rows_of(batch.slice(at, 2048))
                if not len(y):
                    continue
                own = y.mean(axis=0)
                z, step = y - own, own - mean
                moment += z.T @ z + np.outer(step, step) * (n * len(y) / (n + len(y)))
                mean += step * (len(y) / (n + len(y)))
                n += len(y)
        if n:
            yield pa.RecordBatch.from_pydict(
                {"i": list(range(dims)), "n": [n] * dims, "mean": [mean.astype("<f8").tobytes()] * dims, "row": [r.astype("<f8").tobytes() for r in moment]},
                pa.schema([("i", pa.int32()), ("n", pa.int64()), ("mean", pa.binary()), ("row", pa.binary())]),
            )

    def merge(table: pa.Table) -> pa.Table:
        i, n, mean, row = table.column("i")[0].as_py(), 0, np.zeros(dims), np.zeros(dims)
        for m, own, part in sorted(zip(*(table.column(c).to_pylist() for c in ("n", "mean", "row")))):
            own = np.frombuffer(own, "<f8")
            step = own - mean
            row = row + np.frombuffer(part, "<f8") + step[i] * step * (n * m / (n + m))
            mean, n = mean + step * (m / (n + m)), n + m
        return pa.table({"i": pa.array([i], pa.int32()), "n": pa.array([n], pa.int64()), "mean": pa.array([mean.astype("<f8").tobytes()]), "row": pa.array([row.astype("<f8").tobytes()])})

    schema = "i int, n long, mean binary, row binary"
    # Two rounds, so that the last merge meets a bounded number of rows: tasks are first merged in groups of 64.
    parts = frame.mapInArrow(run, schema).withColumn("g", F.pmod(F.spark_partition_id(), F.lit(64)))
    some = parts.groupBy("i", "g").applyInArrow(lambda t: merge(t), schema)
    rows = sorted(some.groupBy("i").applyInArrow(merge, schema).collect())
    if not rows:
        return 0, np.zeros(dims), np.zeros((dims, dims))
    return rows[0].n, np.frombuffer(rows[0].mean, "<f8"), np.array([np.frombuffer(r.row, "<f8") for r in rows])


def _sums(points: DataFrame) -> list:
    """Exact sum and count per dimension: a row per dimension and task, summed as decimals."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, []
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch.column(0), len(batch.column(0)[0]) if not n else len(total))
                # High and low halves apart, as sums of longs need not fit a long.
                part = [(int(h) << 32) + int(w) for h, w in zip((x >> 32).sum(axis=0), (x & 0xFFFFFFFF).sum(axis=0))]
                total, n = [a + b for a, b in zip(total, part)] if n else part, n + len(x)
        if total:
            yield pa.RecordBatch.from_pydict({"i": list(range(len(total))), "n": [n] * len(total), "s": pa.array(total, pa.decimal128(38, 0))}, pa.schema([("i", pa.int32()), ("n", pa.int64()), ("s", pa.decimal128(38, 0))]))

    parts = points.select("x").mapInArrow(run, "i int, n long, s decimal(38,0)")
    return parts.groupBy("i").agg(F.sum("n").alias("n"), F.sum("s").alias("s")).orderBy("i").collect()


def fit(points: DataFrame, k: int = 8) -> Whitening:
    """Components of ``points(x array<long>)``, at most ``k``; fewer if there are fewer dimensions or their variance vanishes.

    The driver holds sums, covariance and eigenvectors: they grow with the dimensions alone.
    """
    sums = _sums(points)
    n = max((r.n for r in sums), default=0)
    if not sums:
        return Whitening(n, np.zeros(0, object), 0.0, np.zeros(0), np.zeros((0, 0)))
    if any(r.n != n for r in sums):
        raise ValueError("vectors of different lengths in one table")
    model = Whitening(n, np.array([int(r.s) for r in sums], object), 0.0, np.zeros(0), np.zeros((len(sums), 0)))
    mean, dims = model.mean, len(sums)
    _, drift, moment = _moments(points.select("x"), dims, lambda batch: _centred(_matrix(batch.column(0), dims), mean))
    v = moment / n + np.outer(drift, drift)
    v = (v + v.T) / 2
    values, vectors = feast(points.sparkSession, v, k)
    model.trace, model.values, model.vectors = float(np.trace(v)), values, vectors
    return model


def whiten(df: DataFrame, vector: str, k: int = 8) -> DataFrame:
    """``df`` without the vector, a row per component: component, n, deviation, whitened, explained, identity_error.

    ``n`` rows take part; those whose vector is null or holds null, NaN or infinite components are left out. ``deviation`` is
    the exact sum over the dimensions of (n·x - S)², an error where it does not fit a long. ``whitened`` is the centred vector
    projected on the component over the root of its eigenvalue; ``explained`` the component's share of the variance;
    ``identity_error`` the largest entry of |covariance of whitened - identity|. Rows that are alike, and null keys, stay. No
    rows come out if all vectors are alike or there are none. Vectors of different lengths are an error. Input columns named
    as one of those added (in any case) are replaced.
    """
    added = T.StructType.fromDDL("component int, n long, deviation long, whitened double, explained double, identity_error double")
    lower = {vector.lower(), *(f.lower() for f in added.names)}
    kept = [c for c in df.columns if c.lower() not in lower]
    bare = df.select(F.struct(F.lit(None).cast("int").alias("_"), *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(kept)]).alias("kept"), F.col(f"`{vector}`").alias("v"))
    points = settle(quantised(bare, "v").select("kept", "x"), "quantised")
    model = fit(points.select("x"), k)
    mean, dims, turn = model.mean, len(model.sums), model.vectors / np.sqrt(model.values)
    n, total = model.n, model.sums

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column(1), dims)
            out = _centred(x, mean) @ turn
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(deviations(x, n, total), pa.int64()), pa.FixedSizeListArray.from_arrays(pa.array(out.ravel()), out.shape[1]).cast(pa.list_(pa.float64()))],
                ["kept", "deviation", "w"],
            )

    fields = T.StructType([points.schema["kept"], *T.StructType.fromDDL("deviation long, w array<double>").fields])
    size = len(model.values)
    turned = settle(points.mapInArrow(run, fields) if size else points.sparkSession.createDataFrame([], fields), "whitened")
    _, _, moment = _moments(turned.select("w"), size, lambda batch: _matrix(batch.column(0), size)) if size else (0, None, np.zeros((0, 0)))
    error = float(np.abs(moment / max(n, 1) - np.eye(size)).max(initial=0))
    shares = F.array(*[F.lit(float(e / model.trace)) for e in model.values]) if size else F.array().cast("array<double>")
    return turned.select("kept", "deviation", F.posexplode("w").alias("at", "whitened")).select(
        *[F.col(f"kept.c{i}").alias(c) for i, c in enumerate(kept)], (F.col("at") + 1).alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened",
        F.element_at(shares, F.col("at") + 1).alias("explained"), F.lit(error).alias("identity_error"),
    )


def deviations(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """Per row the sum of (n·x - S)², exactly: in 64 bits where they are sure to do, with Python's integers elsewhere."""
    if not x.size:
        return np.zeros(len(x), np.int64)
    low, high = x.min(axis=0), x.max(axis=0)
    far = max(max(abs(n * int(a) - int(s)), abs(n * int(b) - int(s))) for a, b, s in zip(low, high, sums))
    if far * far * x.shape[1] < 2**63 and max(abs(int(s)) for s in sums) < 2**62 and n * int(np.abs(x).max()) < 2**62:
        d = x * n - np.array([int(s) for s in sums], np.int64)
        return (d * d).sum(axis=1)
    out = [sum((n * a - int(s)) ** 2 for a, s in zip(row, sums)) for row in x.tolist()]
    if max(out) >= 2**63:
        raise OverflowError("a deviation does not fit a long")
    return np.array(out, np.int64)
