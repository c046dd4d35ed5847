"""Whitening of embeddings along the leading components of their covariance.

Vectors become whole numbers, so sums over any number of rows are exact and do not
depend on how rows are dealt out: every batch centres its rows at a whole
number near their mean, multiplies, and the centres are accounted for in whole numbers
without bound.  They travel as limbs of ``LIMB`` bits, which Spark adds up.  The driver
gets one sum for each pair of dimensions, whatever the number of rows, and finds the
components by spectrum slicing (``spectrum``).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm import spectrum
from tidelog.llm.base import small_batches, stage

STEPS = 256  # fixed value: steps of a unit
COMPONENTS = 4
LIMB = 30
#: Whole numbers a double holds without loss.
EXACT = 1 << 53


@dataclass
class Model:
    """What whitening needs: bounded by the number of dimensions."""

    n: int
    sums: list[int]
    vectors: np.ndarray  # (dimension, component)
    values: np.ndarray
    trace: float


def whole_vectors(rows: DataFrame, key: str, vector: str) -> DataFrame:
    """``(key, x)``: entries in whole steps; rows that hold null or a number that is not finite go."""
    c = F.col("_c")
    finite = F.col("_c").isNotNull() & ~F.exists(c, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return (rows.select(F.col(key), F.col(vector).cast("array<double>").alias("_c")).filter(finite)
            .select(F.col(key), F.transform(c, lambda v: F.floor(v * STEPS)).alias("x")))


def usual_length(rows: DataFrame) -> int:
    """The most frequent number of dimensions, the larger of equals; 0 for an empty table."""
    top = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).first()
    return top["d"] if top else 0


def _block(column: pa.Array, d: int) -> np.ndarray:
    """The vectors of a batch as rows of whole numbers."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False).reshape(-1, d)


def _limbs(value: int) -> Iterator[tuple[int, int]]:
    """Digits of ``LIMB`` bits that add up to ``value``; they carry its sign."""
    sign, value, at = (1, -1)[value < 0], abs(value), 0
    while value:
        yield at, sign * (value & ((1 << LIMB) - 1))
        value, at = value >> LIMB, at + 1


def moments(fit: DataFrame, d: int) -> tuple[int, list[int], list[list[int]]]:
    """Exact count, sums and sums of products of the vectors in ``x``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, products = 0, [0] * d, [[0] * d for _ in range(d)]
        for batch in batches:
            x = _block(batch.column(0), d)
            if not len(x):
                continue
            total = x.sum(axis=0, dtype=object)
            centre = [int(t) // len(x) for t in total]
            if max(map(abs, centre)) < EXACT and int(np.abs(x.astype(np.float64)).max()) < EXACT:
                y = x - np.array(centre, np.int64)
            else:
                y = x.astype(object) - np.array(centre, object)
            # In doubles as long as every partial sum is a whole number they hold.
            most = max(int(y.max()), -int(y.min()))
            if most * most * len(y) < EXACT:
                inner = y.astype(np.float64)
                inner = (inner.T @ inner).astype(np.int64).tolist()
            else:
                y = y.astype(object)
                inner = (y.T @ y).tolist()
            rest = [int(t) - c * len(x) for t, c in zip(total, centre, strict=True)]
            for i in range(d):
                sums[i] += int(total[i])
                row = products[i]
                for j in range(i + 1):
                    row[j] += int(inner[i][j]) + centre[i] * rest[j] + centre[j] * rest[i] + centre[i] * centre[j] * len(x)
            n += len(x)
        if n:
            cells = [(-1, 0, n), *((i, -1, s) for i, s in enumerate(sums)),
                     *((i, j, products[i][j]) for i in range(d) for j in range(i + 1))]
            out = [(i, j, k, limb) for i, j, s in cells for k, limb in _limbs(s)]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
                zip(*out, strict=True), (pa.int32(), pa.int32(), pa.int32(), pa.int64()), strict=True)], ["i", "j", "k", "limb"])

    limbs = fit.select("x").mapInArrow(run, "i int, j int, k int, limb long").groupBy("i", "j", "k").agg(F.sum("limb").alias("limb"))
    cells: dict[tuple[int, int], int] = {}
    # A few limbs for each pair of dimensions.
    for i, j, k, limb in limbs.collect():
        cells[i, j] = cells.get((i, j), 0) + (limb << (LIMB * k))
    products = [[cells.get((max(i, j), min(i, j)), 0) for j in range(d)] for i in range(d)]
    return cells.get((-1, 0), 0), [cells.get((i, -1), 0) for i in range(d)], products


def _wide(top: int, bottom: int) -> np.longdouble:
    """A quotient of whole numbers in extended precision."""
    high = top / bottom
    rest = Fraction(top, bottom) - Fraction(high)
    return np.longdouble(high) + np.longdouble(float(rest))


def fit_model(fit: DataFrame, d: int, components: int = COMPONENTS) -> Model:
    """Leading components of the exact covariance of the vectors in ``x``.

    Those without variance are left out.
    """
    n, sums, products = moments(fit, d)
    # n * n times the covariance, in whole numbers.
    exact = [[n * products[i][j] - sums[i] * sums[j] for j in range(i + 1)] for i in range(d)]
    v = np.zeros((d, d), np.longdouble)
    for i in range(d):
        for j in range(i + 1):
            v[i, j] = v[j, i] = _wide(exact[i][j], n * n) if exact[i][j] else 0
    pairs = spectrum.leading(v, components)
    vectors = np.array([p.vector for p in pairs], np.float64).reshape(-1, d).T
    return Model(n, sums, vectors, np.array([float(p.value) for p in pairs]), float(v.trace()))


def _centred(x: np.ndarray, model: Model) -> np.ndarray:
    """``n * x - S``, exactly."""
    bound = model.n * (int(np.abs(x.astype(np.float64)).max()) + 1) + max(abs(s) for s in model.sums)
    if bound < 1 << 62:
        return x * model.n - np.array(model.sums, np.int64)
    return x.astype(object) * model.n - np.array(model.sums, object)


def _whitened(centred: np.ndarray, model: Model) -> np.ndarray:
    return ((centred / model.n).astype(np.float64) @ model.vectors) / np.sqrt(model.values)


def identity_error(fit: DataFrame, model: Model) -> float:
    """How far the covariance of the whitened fit list is from the identity.

    Every batch is centred at its own means; merging adds what the means differ by.
    """
    d, k = len(model.sums), len(model.values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, mean, scatter = 0, np.zeros(k), np.zeros((k, k))
        for batch in batches:
            if batch.num_rows:
                w = _whitened(_centred(_block(batch.column(0), d), model), model)
                n, mean, scatter = _merge((n, mean, scatter), (len(w), w.mean(axis=0), _scatter(w)))
        if n:
            yield pa.RecordBatch.from_pylist([{"n": n, "mean": mean.tolist(), "scatter": scatter.ravel().tolist()}],
                                             schema=pa.schema([("n", pa.int64()), ("mean", pa.list_(pa.float64())),
                                                               ("scatter", pa.list_(pa.float64()))]))

    # One row of a few numbers per task; merged in groups, so that the driver gets a bounded number.
    parts = fit.select("x").mapInArrow(run, "n long, mean array<double>, scatter array<double>")

    def merged(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = (0, np.zeros(k), np.zeros((k, k)))
        schema = None
        for batch in rows:
            schema = batch.schema
            for r in batch.to_pylist():
                total = _merge(total, (r["n"], np.array(r["mean"]), np.array(r["scatter"]).reshape(k, k)))
        if total[0]:
            yield pa.RecordBatch.from_pylist([{"n": total[0], "mean": total[1].tolist(),
                                               "scatter": total[2].ravel().tolist()}], schema=schema)

    total = (0, np.zeros(k), np.zeros((k, k)))
    for r in parts.repartition(16).mapInArrow(merged, parts.schema).collect():
        total = _merge(total, (r.n, np.array(r["mean"]), np.array(r.scatter).reshape(k, k)))
    return float(np.abs(total[2] / total[0] - np.eye(k)).max())


def _scatter(w: np.ndarray) -> np.ndarray:
    y = w - w.mean(axis=0)
    return y.T @ y


def _merge(a: tuple, b: tuple) -> tuple:
    if not a[0]:
        return b
    n, apart = a[0] + b[0], b[1] - a[1]
    return n, a[1] + apart * (b[0] / n), a[2] + b[2] + np.outer(apart, apart) * (a[0] * b[0] / n)


def whiten(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """Whitened coordinates of every vector, one row per vector and component.

    ``rows`` needs ``key`` and ``vector``; other columns are ignored, whatever their
    names.  Rows whose vector is null or holds null or a number that is not
    finite are left out, and so are vectors of another length than the most frequent.
    Copies of a vector and rows that share a key, or have none, each give
    their rows; a vector counts once in the covariance, however many rows have it.  Steps beyond
    64 bits stay at their end.  Result: ``key``, ``component`` from 1, ``n`` (different vectors),
    ``deviation`` (the sum over dimensions of ``(n * x - S)**2``, exact, as a decimal; null beyond
    38 digits), ``whitened``, ``explained`` and ``identity_error``.  Components without variance are left out, so
    an empty table, a single vector, and vectors without entries give nothing.
    """
    spark = rows.sparkSession
    small_batches(spark)
    found = stage(whole_vectors(rows, key, vector), "whole-vectors")
    kind = found.schema[key].dataType.simpleString()
    shape = (f"`{key}` {kind}, component int, n long, deviation decimal(38,0), whitened double, "
             "explained double, identity_error double")
    d = usual_length(found)
    found = found.filter(F.size("x") == d)
    fit = stage(found.select("x").distinct(), "fit-list")
    model = fit_model(fit, d, components) if d else None
    if model is None or not len(model.values):
        return spark.createDataFrame([], shape)
    error, k = identity_error(fit, model), len(model.values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            centred = _centred(_block(batch.column(1), d), model)
            m = len(centred)
            most = max(int(centred.max()), -int(centred.min()))
            squares = (centred if most * most * d < 1 << 63 else centred.astype(object)) ** 2
            deviation = [s if s < 10 ** 38 else None for s in map(int, squares.sum(axis=1))]
            each = np.repeat(np.arange(m), k)
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(pa.array(each)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                pa.array(np.full(m * k, model.n)), pa.array(deviation, pa.decimal128(38, 0)).take(pa.array(each)),
                pa.array(_whitened(centred, model).ravel()), pa.array(np.tile(model.values / model.trace, m)),
                pa.array(np.full(m * k, error))],
                [key, "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return found.select(key, "x").mapInArrow(run, shape)

