"""Embedding whitening by mixed-precision refinement of eigenvectors (operator 13).

A component c becomes the whole number ``floor(SCALE * c)``. The fit list holds each distinct
vector once. Spark counts it and sums it; then every task centres its vectors on the nearest whole
mean and multiplies them, and the products are added as whole numbers. So the covariance, divisor
n, is exact before its one rounding, whatever the partitions, and a task that runs again after a
lost executor changes no bit. Only the matrix (dimension squared) reaches the driver.

Its eigenvectors are found in single precision and corrected by the iterations of Ogita and
Aishima (2018): matrix products in higher precision (``WIDE``) give the residuals of
orthogonality and of diagonality, and from both a first-order correction of all vectors at once.
Pairs of eigenvalues that the residuals do not tell apart only have their orthogonality
corrected; as in the sequel for clusters (2019), each cluster of such eigenvalues is solved as a
small problem of its own, shifted by its mean, which turns its vectors into place before the next
iteration.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import with_struct, written
from .vector_codes import matrix, usable

SCALE, COMPONENTS = 256, 4
#: Whole numbers stay below this size, so that double precision holds them.
LIMIT = 1 << 52
#: The higher precision: extended where the machine has it, else double.
WIDE = np.longdouble
ROUNDS = 40


def _gram(y: np.ndarray) -> np.ndarray:
    """Exact products of the columns of a matrix of whole numbers, as Python integers."""
    size = int(np.abs(y).max()) if y.size else 0
    if size * size * len(y) < 1 << 53:  # every partial sum is a whole number that a double holds
        f = y.astype(np.float64)
        return (f.T @ f).astype(np.int64).astype(object)
    if size * size * len(y) < 1 << 62:
        return (y.T @ y).astype(object)
    o = y.astype(object)
    return o.T @ o


def distinct_vectors(rows: DataFrame, vector: str, width: int) -> DataFrame:
    """(x): each distinct whole-number vector once."""

    def batch(b: pa.Array) -> pa.Array:
        x = matrix(b, SCALE, width, LIMIT)
        lists = pa.ListArray.from_arrays(np.arange(0, x.size + 1, width, dtype=np.int32), pa.array(x.ravel()))
        return pa.StructArray.from_arrays([lists], ["x"])

    found = with_struct(rows.select(vector), "__white", F.col(vector), "struct<x: array<long>>", batch)
    return written(found.select("__white.x").distinct(), "vectors")


def _whole(column: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    ends = column.offsets.to_numpy()
    return column.values.to_numpy()[ends[0] : ends[-1]].reshape(-1, width)


def moments(vectors: DataFrame, width: int) -> tuple[int, list[int], np.ndarray]:
    """(n, sums, n * n * covariance): whole numbers, exact."""

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, s = 0, np.zeros(width, object)
        for b in batches:
            x = _whole(b.column(0), width)
            n += len(x)
            s += x.sum(axis=0, dtype=np.int64).astype(object) if len(x) else 0
        yield pa.RecordBatch.from_arrays(
            [pa.array([n] * width, pa.int64()), pa.array(range(width), pa.int32()), pa.array([Decimal(int(v)) for v in s], pa.decimal128(38, 0))],
            ["n", "i", "s"],
        )

    found = vectors.mapInArrow(total, "n long, i int, s decimal(38,0)").groupBy("i").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
    rows = found.orderBy("i").collect()  # one row per dimension
    n, sums = rows[0]["n"], [int(r["s"]) for r in rows]
    mean = [round(Fraction(s, n)) for s in sums]
    shift = np.array(mean, np.int64)

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = np.zeros((width, width), object)
        for b in batches:
            if b.num_rows:
                m = m + _gram(_whole(b.column(0), width) - shift)
        i, j = np.triu_indices(width)
        values = [Decimal(int(v)) for v in m[i, j]]
        yield pa.RecordBatch.from_arrays(
            [pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(values, pa.decimal128(38, 0))], ["i", "j", "m"]
        )

    found = vectors.mapInArrow(products, "i int, j int, m decimal(38,0)").groupBy("i", "j").agg(F.sum("m").alias("m"))
    cov = np.zeros((width, width), object)
    rest = [s - n * m for s, m in zip(sums, mean, strict=True)]  # n times what the whole mean leaves of the mean
    for r in found.collect():  # half of dimension squared
        i, j = r["i"], r["j"]
        cov[i, j] = cov[j, i] = n * int(r["m"]) - rest[i] * rest[j]
    return n, sums, cov


def _clusters(values: np.ndarray, apart: float) -> list[np.ndarray]:
    """Runs of two or more sorted positions whose neighbours are not further apart."""
    order = np.argsort(values, kind="stable")
    cut = np.flatnonzero(np.diff(values[order]) > apart) + 1
    return [c for c in np.split(order, cut) if len(c) > 1]


def refined(a: np.ndarray, x: np.ndarray, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, eigenvectors) of the symmetric ``a``, in its precision, from approximate ``x``.

    Each round costs four matrix products and brings the square of the error, as long as the
    residuals are less than the gaps; the sub-solves make that so within clusters.
    """
    kind, d = a.dtype, len(a)
    eps = np.finfo(kind).eps
    one, scale = np.eye(d, dtype=kind), np.abs(a).sum(axis=0).max()
    if not scale:
        return np.zeros(d, kind), one
    x, last = x.astype(kind), np.inf
    for _ in range(rounds):
        r = one - x.T @ x
        s = x.T @ (a @ x)
        s = (s + s.T) / 2
        value = np.diag(s) / (1 - np.diag(r))
        off = np.linalg.norm((s - np.diag(value)).astype(np.float64))
        apart = 2 * (off + float(scale) * np.linalg.norm(r.astype(np.float64)))
        gap = value[None, :] - value[:, None]
        far = np.abs(gap) > apart
        e = np.where(far, (s + value[None, :] * r) / np.where(far, gap, 1), r / 2)
        x = x + x @ e
        for c in _clusters(value.astype(np.float64), apart):
            own = x[:, c]
            mid = value[c].mean()
            small = own.T @ (a @ own - mid * own)
            size = np.abs(small).max()
            if size > eps * scale:  # else the cluster is one eigenvalue: any basis of it will do
                x[:, c] = own @ np.linalg.eigh(((small + small.T) / (2 * size)).astype(np.float64))[1].astype(kind)
        step = float(np.abs(e).max())
        if step < 8 * eps or (step >= last / 2 and step < 1e-16):
            break
        last = step
    x = x / np.sqrt((x * x).sum(axis=0))
    value = ((a @ x) * x).sum(axis=0)
    return value, x


def eigen(n: int, cov: np.ndarray, k: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(largest eigenvalues, their share of the trace, unit vectors in columns) of cov / n / n.

    The largest entry of a vector is positive. Eigenvalues that are zero within rounding are 0.
    """
    whole = np.array([[WIDE(int(v)) for v in row] for row in cov]) / WIDE(n) / WIDE(n)
    size = np.abs(whole).max() if whole.size else 0
    start = np.linalg.eigh((whole / size if size else whole).astype(np.float32))[1]  # single precision
    start = refined(whole.astype(np.float64), start)[1]  # most of the way, where products are fast
    value, x = refined(whole, start)
    order = np.argsort(-value, kind="stable")[:k]
    value, x = value[order], x[:, order]
    trace = np.trace(whole)
    value = np.where(value > 8 * len(whole) * np.finfo(WIDE).eps * trace, value, 0)
    x = x * np.sign(x[np.abs(x).argmax(axis=0), np.arange(x.shape[1])])
    return value.astype(np.float64), (value / trace if trace else value).astype(np.float64), x.astype(np.float64)


class Whitening:
    """A fitted whitening: ``n``, ``sums``, ``values``, ``explained``, ``vectors``."""

    def __init__(self, n: int, sums: list[int], cov: np.ndarray, k: int = COMPONENTS):
        self.n, self.sums, self.width = n, sums, len(sums)
        self.mean = np.array([float(Fraction(s, n)) for s in sums])
        self.values, self.explained, self.vectors = eigen(n, cov, k)
        with np.errstate(divide="ignore"):
            self.turn = self.vectors / np.sqrt(self.values)  # not finite where a value is 0: such components are null

    def whitened(self, x: np.ndarray) -> np.ndarray:
        known = self.values > 0
        out = np.full((len(x), len(known)), np.nan)
        out[:, known] = (x - self.mean) @ self.turn[:, known]
        return out

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """Sums of (n * x - S) ** 2, exact; None beyond 64 bits."""
        if not len(x):
            return []
        far = self.n * int(np.abs(x).max()) + max(abs(s) for s in self.sums)
        kind = np.int64 if far * far * self.width < 1 << 62 else object
        sums = np.array(self.sums, kind)
        total = ((x.astype(kind) * kind(self.n) - sums) ** 2).sum(axis=1) if kind is np.int64 else ((x.astype(object) * self.n - sums) ** 2).sum(axis=1)
        return [int(t) if int(t) < 1 << 63 else None for t in total]


def identity_error(vectors: DataFrame, fitted: Whitening) -> float | None:
    """Largest entry of the whitened fit list's covariance minus the identity; None without a
    component whose eigenvalue is positive."""
    known = fitted.values > 0
    k = int(known.sum())
    if not k:
        return None
    shared = vectors.sparkSession.sparkContext.broadcast(fitted)  # of a size given by the dimension

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k + 1, k + 1))
        for b in batches:
            z = shared.value.whitened(_whole(b.column(0), shared.value.width))[:, known]
            z = np.c_[z, np.ones(len(z))]
            total += z.T @ z
        i, j = np.indices(total.shape)
        yield pa.RecordBatch.from_arrays([pa.array(i.ravel()), pa.array(j.ravel()), pa.array(total.ravel())], ["i", "j", "m"])

    found = vectors.mapInArrow(gather, "i long, j long, m double").groupBy("i", "j").agg(F.sum("m").alias("m"))
    m = np.zeros((k + 1, k + 1))
    for r in found.collect():  # (components + 1) squared rows
        m[r["i"], r["j"]] = r["m"] / fitted.n
    return float(np.abs(m[:k, :k] - np.outer(m[:k, k], m[:k, k]) - np.eye(k)).max())


def fit(rows: DataFrame, vector: str, k: int = COMPONENTS) -> tuple[Whitening, DataFrame] | None:
    """(whitening, fit list) of a table of usable vectors; None if it is empty."""
    first = rows.select(F.size(vector).alias("n")).first()
    if not first:
        return None
    if not first["n"]:
        raise ValueError("vectors have no component")
    vectors = distinct_vectors(rows, vector, first["n"])
    return Whitening(*moments(vectors, first["n"]), k), vectors


def whitened(table: DataFrame, vector_col: str = "embedding", k: int = COMPONENTS, prefix: str = "__white_") -> DataFrame:
    """The rows of ``table`` with a usable vector, once per component (at most ``k``, or the
    dimension), plus ``component``, ``n``, ``deviation``, ``whitened``, ``explained`` and
    ``identity_error`` named by ``prefix``.

    Rows whose vector is null or holds null, NaN or infinite entries are dropped. Repeated rows
    are rows of their own but count once in the fit. A component whose eigenvalue is 0 (a single
    distinct vector, or less rank than components) has null ``whitened``; the error is that of the
    other components, null without any. A deviation beyond 64 bits is null. Of equal eigenvalues,
    any orthonormal vectors are components. An empty table gives an empty table. Vectors of
    different lengths, and entries of 2 ** 44 or more, raise an error. Other columns, whatever
    their names, pass unchanged.
    """
    vector = F.col(f"`{vector_col}`")
    row = F.struct(*[F.col(f"`{c}`") for c in table.columns])
    rows = table.filter(usable(vector)).select(row.alias("row"), vector.cast("array<double>").alias("v"))
    found = fit(rows, "v", k)
    if found:
        fitted, vectors = found
        error = identity_error(vectors, fitted)
        n, width, count = fitted.n, fitted.width, len(fitted.values)
        explained = F.array(*[F.lit(float(e)) for e in fitted.explained])
    else:
        fitted, error, n, width, count, explained = None, None, 0, 0, 0, F.array(F.lit(0.0))

    def batch(b: pa.Array, fitted: Whitening) -> pa.Array:
        x = matrix(b, SCALE, width, LIMIT)
        z = fitted.whitened(x)
        flat = pa.array(z.ravel(), pa.float64(), from_pandas=True)  # NaN as null
        lists = pa.ListArray.from_arrays(np.arange(0, z.size + 1, max(count, 1), dtype=np.int32), flat)
        return pa.StructArray.from_arrays([pa.array(fitted.deviation(x), pa.int64()), lists], ["deviation", "z"])

    shared = table.sparkSession.sparkContext.broadcast(fitted)  # of a size given by the dimension
    done = with_struct(rows, "s", F.col("v"), "struct<deviation: long, z: array<double>>", batch, lambda: shared.value)
    done = done.select("row", F.col("s.deviation").alias("deviation"), F.posexplode("s.z").alias("p", "z"))
    return done.select(
        *[F.col("row").getField(c).alias(c) for c in table.columns],
        (F.col("p") + 1).alias(f"{prefix}component"), F.lit(n).cast("long").alias(f"{prefix}n"), F.col("deviation").alias(f"{prefix}deviation"),
        F.col("z").alias(f"{prefix}whitened"), F.get(explained, F.col("p")).alias(f"{prefix}explained"),
        F.lit(error).cast("double").alias(f"{prefix}identity_error"),
    )


def components(embeddings: DataFrame) -> DataFrame:
    """Per usable row and component: vec_id, component, n, deviation, whitened, explained, identity_error."""
    out = whitened(embeddings.select("vec_id", "embedding"))
    names = ("component", "n", "deviation", "whitened", "explained", "identity_error")
    return out.select("vec_id", *[F.col(f"__white_{c}").alias(c) for c in names])
