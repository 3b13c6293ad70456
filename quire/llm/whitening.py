"""Embedding whitening by cyclic Jacobi rotations.

Entries become whole numbers, x = floor(256 * c). The fit list holds each distinct vector once, so copies are taken together before anything
is summed. Its sums and its scatter are made a partition at a time and added up by Spark, all in whole numbers: vectors are centred at the
rounded means before they are multiplied, and what the rounding leaves out (half a unit at most) is put right exactly. So the covariance is
the same however rows are partitioned, and rounded once. The driver, which holds matrices of the dimension's size and nothing that grows
with rows, rotates the covariance until its off-diagonals vanish; small eigenvalues keep their relative accuracy. Each is sent out as one
small matrix, with which every row is projected.

Defined results. Rows whose vector is null or holds null, NaN or infinite entries go, as do rows that haven't the most frequent dimension
(ties: the largest). Null ids and repeated rows are rows like any other. Components whose eigenvalue is zero (at most dimension * 2^-52 of the
largest) aren't given, so one distinct vector, or an empty table, gives no rows. Ties of eigenvalues go by the driver's order; a component's
largest entry is positive. A deviation beyond a long is null there and whole in deviation_whole. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from decimal import Decimal
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.llm.common import written

SCALE, COMPONENTS = 256, 4
Matrix = np.ndarray


def whole(df: DataFrame, column: str = "embedding") -> DataFrame:
    """(vec_id, x) of the rows that stay; x are longs."""
    v = df[column].cast("array<double>")
    usable = v.isNotNull() & ~F.exists(v, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    rows = df.where(usable).select(df["vec_id"].alias("vec_id"), F.transform(v, lambda c: F.floor(c * SCALE).cast("long")).alias("x"))
    sizes = rows.groupBy(F.size("x").alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    return rows.where(F.size("x") == (sizes["d"] if sizes else 0))


def vectors(batch: pa.RecordBatch, name: str = "x") -> Matrix:
    """A column of arrays of one length as a matrix."""
    column = batch.column(name)
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1) if len(column) else np.zeros((0, 0), np.int64)


def gram(x: Matrix) -> Matrix:
    """x'x exactly: in doubles or longs where no sum can leave them, else in whole numbers of any size."""
    top = int(max(abs(int(x.min())), abs(int(x.max())))) ** 2 * len(x)
    if top < 1 << 53:
        x = x.astype(np.float64)
        return (x.T @ x).astype(np.int64).astype(object)
    if top >= 1 << 63:
        x = x.astype(object)
    return (x.T @ x).astype(object)


def totals(fit: DataFrame, of: Callable[[Matrix], Matrix]) -> dict[int, int]:
    """The sum of of(x) over partitions, entry by entry as numbered in its flat order. Each partition sends one row an entry."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if len(batch):
                part = of(vectors(batch)).ravel()
                held = part if held is None else held + part
        if held is not None:
            values = pa.array([Decimal(int(v)) for v in held], pa.decimal128(38, 0))
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(held))), values], ["k", "v"])

    sums = fit.select("x").mapInArrow(run, "k long, v decimal(38,0)").groupBy("k").agg(F.sum("v").alias("v"))
    return {r["k"]: int(r["v"]) for r in sums.collect()}  # as many as of() gives: dimension squared at most


def covariance(fit: DataFrame) -> tuple[int, list[int], Matrix]:
    """n, sums by dimension, and the covariance with divisor n, each entry rounded once from its exact value."""
    n = fit.count()
    sums = totals(fit, lambda x: x.sum(axis=0, dtype=object))
    s = [sums[k] for k in range(len(sums))]
    d, centre = len(s), np.array([round(Fraction(v, n)) for v in s], np.int64)
    upper = np.triu_indices(d)
    scatter = totals(fit, lambda x: gram(x - centre)[upper])
    left = [v - n * int(c) for v, c in zip(s, centre, strict=True)]
    out = np.zeros((d, d))
    for k, (i, j) in enumerate(zip(*upper, strict=True)):
        out[i, j] = out[j, i] = Fraction(n * scatter[k] - left[i] * left[j], n * n)
    return n, s, out


def jacobi(a: Matrix, sweeps: int = 60) -> tuple[Matrix, Matrix]:
    """Eigenvalues of a symmetric matrix and its unit eigenvectors as columns, by falling eigenvalue. Rotations go over all pairs of
    dimensions in turn, until no off-diagonal counts beside its two diagonals."""
    a, d = a.copy(), len(a)
    v = np.eye(d)
    eps = np.finfo(float).eps
    for _ in range(sweeps):
        rotated = False
        for p in range(d - 1):
            for q in range(p + 1, d):
                if abs(a[p, q]) <= eps * np.sqrt(abs(a[p, p] * a[q, q])) or abs(a[p, q]) < np.finfo(float).tiny:
                    continue
                rotated = True
                theta = (a[q, q] - a[p, p]) / (2 * a[p, q])
                t = (1 if theta >= 0 else -1) / (abs(theta) + np.hypot(theta, 1))
                c = 1 / np.hypot(t, 1)
                turn = np.array([[c, t * c], [-t * c, c]])
                app, aqq, apq = a[p, p], a[q, q], a[p, q]
                a[:, [p, q]] = a[:, [p, q]] @ turn
                a[[p, q], :] = a[:, [p, q]].T
                a[p, p], a[q, q], a[p, q], a[q, p] = app - t * apq, aqq + t * apq, 0, 0
                v[:, [p, q]] = v[:, [p, q]] @ turn
        if not rotated:
            break
    else:
        raise ArithmeticError(f"no convergence in {sweeps} sweeps")
    order = np.argsort(-a.diagonal(), kind="stable")
    v = v[:, order] / np.linalg.norm(v[:, order], axis=0)
    v *= np.where(v[np.abs(v).argmax(axis=0), np.arange(d)] < 0, -1, 1)
    return a.diagonal()[order], v


def projected(rows: DataFrame, mean: Matrix, w: Matrix) -> DataFrame:
    """rows with y, the whitened coordinates of x."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = vectors(batch)
            y = (x - mean) @ w if len(x) else np.zeros((0, w.shape[1]))
            offsets = np.arange(len(x) + 1, dtype=np.int32) * y.shape[1]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.ListArray.from_arrays(offsets, y.ravel())], [*batch.schema.names, "y"])

    return rows.mapInArrow(run, T.StructType([*rows.schema, T.StructField("y", T.ArrayType(T.DoubleType()))]))


def deviating(rows: DataFrame, n: int, sums: list[int]) -> DataFrame:
    """rows with deviation_whole, the exact sum of (n*x - S)^2, as n*n*sum(x*x) - 2*n*sum(x*S) + sum(S*S), in place of x."""
    square, s = sum(v * v for v in sums), np.array(sums, object)
    most = max(map(abs, sums), default=0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, others = vectors(batch), batch.drop_columns(["x"])
            if not len(x):
                continue
            top = max(abs(int(x.min())), abs(int(x.max())))
            small = max(top, most) * max(top, 1) * x.shape[1] < 1 << 63  # else whole numbers of any size
            z, t = (x, s.astype(np.int64)) if small else (x.astype(object), s)
            far = [Decimal(n * n * int(a) - 2 * n * int(b) + square) for a, b in zip((z * z).sum(axis=1), z @ t, strict=True)]
            yield pa.RecordBatch.from_arrays([*others.columns, pa.array(far, pa.decimal128(38, 0))], [*others.schema.names, "deviation_whole"])

    return rows.mapInArrow(run, T.StructType([f for f in rows.schema if f.name != "x"] + [T.StructField("deviation_whole", T.DecimalType(38, 0))]))


def identity_error(points: DataFrame, k: int) -> float:
    """The largest entry, without its sign, of the covariance of y minus the identity; means first, so products are of centred values."""
    y = [F.col("y")[i] for i in range(k)]
    means = points.agg(*[F.avg(c) for c in y]).first()
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    got = points.agg(*[F.avg((y[i] - means[i]) * (y[j] - means[j])) for i, j in pairs]).first()
    return max(abs(v - (i == j)) for v, (i, j) in zip(got, pairs, strict=True))


SCHEMA = "component int, n long, deviation long, whitened double, explained double, identity_error double, deviation_whole decimal(38,0)"


def whitened(df: DataFrame, column: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """A row for each remaining row of df and component: vec_id and SCHEMA."""
    rows = whole(df, column)
    fit = written(rows.select("x").distinct(), "whitening-fit")
    spark = df.sparkSession
    if fit.isEmpty() or not fit.select(F.size("x")).first()[0]:
        return spark.createDataFrame([], rows.select("vec_id").schema).select("vec_id", *[F.lit(None).cast(c.split()[1]).alias(c.split()[0]) for c in SCHEMA.split(", ")])
    n, sums, v = covariance(fit)
    values, axes = jacobi(v)
    k = min(components, int((values > len(v) * np.finfo(float).eps * max(values[0], 0)).sum()))
    trace = float(np.trace(v))
    mean = np.array([float(Fraction(s, n)) for s in sums])
    w = axes[:, :k] / np.sqrt(values[:k])
    error = identity_error(projected(fit, mean, w), k) if k else 0.0
    each = F.array(*[F.struct(F.lit(i + 1).alias("component"), F.col("y")[i].alias("whitened"), F.lit(float(values[i] / trace)).alias("explained")) for i in range(k)])
    each = each if k else F.array().cast("array<struct<component: int, whitened: double, explained: double>>")
    out = deviating(projected(rows, mean, w), n, sums).select("vec_id", "deviation_whole", F.explode(each).alias("c"))
    fits = F.when(F.col("deviation_whole") <= F.lit(2**63 - 1), F.col("deviation_whole")).cast("long")
    return out.select("vec_id", "c.component", F.lit(n).cast("long").alias("n"), fits.alias("deviation"), "c.whitened", "c.explained", F.lit(error).alias("identity_error"), "deviation_whole")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitened(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
