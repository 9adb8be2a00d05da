"""Operator 11, embedding whitening with a covariance by polarisation.

Vectors become integers, ``floor(scale * c)``, and each distinct integer vector counts once. With n
such vectors and sums S, every dimension and every sum of two dimensions is centred as ``n * x - S``
and its squares are added up exactly. As ``cov(a, b) = (var(a + b) - var(a) - var(b)) / 2``,
differences of these variances give all covariances, as exact fractions that are rounded once. The
matrix of one entry per pair of dimensions goes to ``eigh`` on the driver; the vectors never leave
the tasks. Tasks return one sum per pair of dimensions, whatever the number of vectors.

Nulls, ties and odd input: rows whose vector is null, empty, or holds null or non-finite entries
are left out, and so are vectors of another length than most have (of lengths equally frequent, the
greatest counts). Entries beyond the 64-bit range stop at its ends. Rows that repeat an id or a
vector each get their result. Components whose variance is zero but for rounding (a share of the
greatest below ``FLAT``) are left out, so a table of one distinct vector gives no rows, as does an
empty one. A ``deviation`` beyond 64 bits is null. The sums of squares must stay under 10^38.
Components of equal variance come in the order of ``eigh``, their sign makes the largest entry
positive. Other columns are never looked at.
"""

from __future__ import annotations

from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedkit.llm.common import column, in_arrow, stage, table

SCALE, COMPONENTS, FLAT = 256.0, 4, 1e-11
#: Vectors a task works on at once.
CHUNK = 2048
_DIGITS = T.DecimalType(38, 0)


def integers(vector: Column, scale: float = SCALE) -> Column:
    """The vector as longs, or null where it is null, empty, or holds a null or non-finite entry."""
    v = vector.cast("array<double>")
    finite = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return F.when((F.size(v) > 0) & finite, F.transform(v, lambda c: F.floor(F.lit(scale) * c).cast("long")))


def _matrices(batches):
    """``(batch, vectors by dimension)`` in chunks."""
    for batch in batches:
        for start in range(0, len(batch), CHUNK):
            part = batch.slice(start, CHUNK)
            lists = part.column("x").flatten().to_numpy(zero_copy_only=False)
            yield part, np.ascontiguousarray(lists.reshape(len(part), -1).T)


def _magnitude(values: np.ndarray) -> int:
    return max(int(values.max()), -int(values.min()))


def _row_sums(values: np.ndarray) -> list[int]:
    """Exact sum of each row of an integer matrix."""
    if _magnitude(values) * values.shape[1] >= 2**63:
        values = values.astype(object)
    return [int(v) for v in values.sum(axis=1)]


def centred(values: np.ndarray, sums: np.ndarray, n: int) -> np.ndarray:
    """``n * x - S``, as Python integers where 64 bits could not hold the sum of two of them."""
    if n * _magnitude(values) + max(abs(int(s)) for s in sums) >= 2**62:
        values = values.astype(object)
    return values * n - sums[:, None].astype(values.dtype)


def square_sums(values: np.ndarray) -> list[int]:
    """Exact sum of squares of each row.

    64-bit arithmetic gives it modulo 2^64, floating point to about 12 digits; together they are exact
    as long as the floating-point error is below 2^63. Larger values are added as Python integers.
    """
    if values.dtype == object or _magnitude(values) >= 2**46:
        return [int(v) for v in (values.astype(object) ** 2).sum(axis=1)]
    low = (values * values).sum(axis=1)
    near = values.astype(np.float64)
    near = np.einsum("ij,ij->i", near, near)
    return [int(w) + round((f - int(w)) / 2**64) * 2**64 for w, f in zip(low, near.tolist(), strict=True)]


def _totals(emit):
    """A task's own totals, one row per pair of dimensions, after its last batch."""

    def add(batches):
        held: np.ndarray | None = None
        for _, x in _matrices(batches):
            new = np.array(emit(x), dtype=object)
            held = new if held is None else held + new
        if held is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(held), dtype=np.int32)),
                                              pa.array([Decimal(int(v)) for v in held], pa.decimal128(38, 0))], names=["place", "total"])

    return add


def _summed(fit: DataFrame, emit) -> list[int]:
    """The totals of all tasks in order of place; their number depends on the dimensions alone."""
    schema = T.StructType([T.StructField("place", T.IntegerType()), T.StructField("total", _DIGITS)])
    parts = in_arrow(fit.select("x"), _totals(emit), schema).groupBy("place").agg(F.sum("total").cast(_DIGITS).alias("total"))
    return [int(r["total"]) for r in parts.orderBy("place").collect()]


def covariance(fit: DataFrame) -> tuple[int, list[int], np.ndarray]:
    """``n``, the sums and the covariance matrix of ``fit(x)``, every vector counted as it stands."""
    n, sums = fit.count(), _summed(fit, _row_sums)
    given = np.array(sums, dtype=object)

    def pairs(x: np.ndarray) -> list[int]:
        u = centred(x, given, n)
        return [total for i in range(len(u)) for total in square_sums(u[i:] + u[i])]

    squares = iter(_summed(fit, pairs))
    d = len(sums)
    of_sum = {(i, j): next(squares) for i in range(d) for j in range(i, d)}
    alone = [of_sum[i, i] // 4 for i in range(d)]  # of x_i + x_i
    v = np.empty((d, d))
    for (i, j), total in of_sum.items():
        v[i, j] = v[j, i] = alone[i] / n**3 if i == j else (total - alone[i] - alone[j]) / (2 * n**3)
    return n, sums, v


def components(v: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Falling eigenvalues and their unit eigenvectors as columns, at most ``most`` and none that is flat."""
    values, vectors = np.linalg.eigh(v)
    values, vectors = values[::-1][:most], vectors[:, ::-1][:, :most]
    kept = (values > 0) & (values > FLAT * values[0])
    values, vectors = values[kept], vectors[:, kept]
    return values, vectors * np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(len(values))])


def _projector(n: int, sums: list[int], values: np.ndarray, vectors: np.ndarray):
    given, onto = np.array(sums, dtype=object), vectors / np.sqrt(values)
    k = len(values)

    def project(batches):
        for part, x in _matrices(batches):
            u = centred(x, given, n)
            deviation = [total if total < 2**63 else None for total in square_sums(u.T)]
            whitened = (u.astype(np.float64) / n).T @ onto
            rows = np.repeat(np.arange(len(part)), k)
            yield pa.RecordBatch.from_arrays(
                [part.column("id").take(pa.array(rows)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(part))),
                 pa.array(deviation, pa.int64()).take(pa.array(rows)), pa.array(np.ascontiguousarray(whitened).ravel())],
                names=["id", "component", "deviation", "whitened"])

    return project


def identity_error(fit: DataFrame, n: int, sums: list[int], values: np.ndarray, vectors: np.ndarray) -> float:
    """Largest absolute entry of the whitened vectors' covariance over ``fit``, less the identity."""
    given, onto, k = np.array(sums, dtype=object), vectors / np.sqrt(values), len(values)

    def whiten(batches):
        for _, x in _matrices(batches):
            w = (centred(x, given, n).astype(np.float64) / n).T @ onto
            yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(w[:, c])) for c in range(k)], names=[f"w{c}" for c in range(k)])

    rows = in_arrow(fit.select("x"), whiten, ", ".join(f"w{c} double" for c in range(k)))
    pairs = [(a, b) for a in range(k) for b in range(a, k)]
    found = rows.agg(*[F.covar_pop(f"w{a}", f"w{b}").alias(f"c{a}_{b}") for a, b in pairs]).first()
    return max(abs(found[f"c{a}_{b}"] - (a == b)) for a, b in pairs)


def whiten(docs: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", most: int = COMPONENTS,
           scale: float = SCALE) -> DataFrame:
    """A row per row of ``docs`` and component: its id, ``component``, ``n``, ``deviation``, ``whitened``,
    ``explained`` and ``identity_error``."""
    spark = docs.sparkSession
    rows = docs.select(column(id_col).alias("id"), integers(column(vector_col), scale).alias("x")).where("x IS NOT NULL")
    schema = T.StructType([T.StructField("id", rows.schema["id"].dataType), T.StructField("component", T.IntegerType()),
                           T.StructField("deviation", T.LongType()), T.StructField("whitened", T.DoubleType())])
    out = [F.col("id").alias(id_col), "component", "n", "deviation", "whitened", "explained", "identity_error"]

    def finished(found: DataFrame, n: int, shares: list[float], error: float) -> DataFrame:
        explained = F.element_at(F.array(*map(F.lit, shares or [0.0])), F.col("component"))
        return found.select("*", F.lit(n).cast("long").alias("n"), explained.alias("explained"), F.lit(error).alias("identity_error")).select(*out)

    lengths = rows.groupBy(F.size("x").alias("d")).agg(F.count("*").alias("rows")).orderBy(F.desc("rows"), F.desc("d")).first()
    if lengths is None:
        return finished(spark.createDataFrame([], schema), 0, [], 0.0)
    rows = rows.where(F.size("x") == lengths["d"])
    fit = stage(rows.select("x").distinct(), "fit")
    n, sums, v = covariance(fit)
    values, vectors = components(v, most)
    if not len(values):
        return finished(spark.createDataFrame([], schema), n, [], 0.0)
    error = identity_error(fit, n, sums, values, vectors)
    found = in_arrow(rows, _projector(n, sums, values, vectors), schema)
    return finished(found, n, [float(e / np.trace(v)) for e in values], error)


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"))
