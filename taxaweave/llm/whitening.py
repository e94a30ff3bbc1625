"""Whitening of embeddings along their leading principal components.

Vectors are first put on an integer grid, x = floor(scale * c) + SHIFT, and
fitted on each distinct x once. Counts, sums and the covariance are exact: x is
centred at the rounded mean before multiplying, the products are summed as
integers, and what rounding the mean left out is taken off as integers too. Only
sums by dimension reach the driver, where spectrum slicing (``slicing``) finds
the components. A pass over the fit list measures the whitened covariance.

Rows whose vector is null or holds a null or non-finite entry are dropped, an
empty vector has no components. Vectors of different lengths, or with entries
of 2^34 or more, raise. Repeated rows are whitened each and fitted once; a null
id is an id like others. Without vectors, or where all are equal, nothing is
returned: components of no variance (to double precision) cannot be whitened.
Input columns ``whitened`` and ``deviation`` are replaced, all others are kept.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from taxaweave.llm import slicing
from taxaweave.llm.common import query, table, written

#: Grid of the contract; components at most.
SCALE = 64
SHIFT = 1_000_000
COMPONENTS = 16
#: Vector entries worked on at a time.
SLICE = 1 << 20
#: Grid values lie within 2^40 of the shift, so that sums of products fit in 38 digits.
LARGEST = 1 << 40
_WHOLE = 1 << 53  # integers of less than this are exact as doubles
_WIDTHS = [np.dtype(t) for t in ("<i1", "<i2", "<i4", "<i8")]


def on_grid(vectors: pa.Array, scale: int = SCALE) -> tuple[np.ndarray, list[np.ndarray]]:
    """(rows kept, their grid values less SHIFT) of a list column."""
    lengths = vectors.value_lengths().to_numpy(zero_copy_only=False)
    keep, out = [], []
    for row in range(len(vectors)):
        if not lengths[row] > 0:  # null (nan) or empty
            continue
        c = vectors[row].values.to_numpy(zero_copy_only=False).astype(np.float64)  # a null entry is nan
        if np.isfinite(c).all():
            y = np.floor(scale * c)
            if np.abs(y).max() >= LARGEST:
                raise ArithmeticError(f"vector entries must be below {LARGEST // scale}")
            keep.append(row)
            out.append(y.astype(np.int64))
    return np.array(keep, np.int64), out


def packed(y: np.ndarray) -> bytes:
    """Equal for equal vectors only: width of an entry, entries."""
    top = int(np.abs(y).max())
    width = next(w for w in _WIDTHS if top < 1 << (8 * w.itemsize - 1))
    return bytes([width.itemsize]) + y.astype(width).tobytes()


def unpacked(data: list[bytes]) -> np.ndarray:
    return np.stack([np.frombuffer(b, f"<i{b[0]}", offset=1).astype(np.int64) for b in data])


@dataclass
class Whitening:
    n: int  # vectors fitted
    sums: list[int]  # of the grid values, by dimension
    values: np.ndarray  # variances of the components, falling
    vectors: np.ndarray  # components as columns
    trace: float
    identity_error: float = 0.0

    def deviations(self, y: np.ndarray) -> np.ndarray:
        """n * x - S as exact integers (Python's where they may not fit), from grid values less SHIFT."""
        s = [a - self.n * SHIFT for a in self.sums]
        top = (self.n * (int(np.abs(y).max(initial=0)) + 1) + max(map(abs, s))) ** 2 * y.shape[1]
        kind = np.int64 if top < 1 << 62 else object
        return self.n * y.astype(kind) - np.array(s, kind)

    def project(self, deviations: np.ndarray) -> np.ndarray:
        return (deviations / self.n).astype(np.float64) @ self.vectors / np.sqrt(self.values)


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    for b in batches:
        data = b.column(0).to_pylist()
        step = max(1, SLICE // max(1, len(data[0]))) if data else 1
        for lo in range(0, len(data), step):
            yield unpacked(data[lo : lo + step])


def _summed(grid: DataFrame, of: Callable[[np.ndarray], np.ndarray], exact: bool = True) -> dict[tuple[int, int], Decimal | float]:
    """Sums over all vectors of the matrix that ``of`` makes of some of them:
    a task adds its own, Spark the tasks'. As many rows as the matrix has entries."""
    kind = T.DecimalType(38, 0) if exact else T.DoubleType()
    schema = T.StructType([T.StructField("i", T.IntegerType()), T.StructField("j", T.IntegerType()), T.StructField("v", kind)])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for y in _slices(batches):
            part = of(y)
            total = part if total is None else total + part
        if total is not None:
            for i, row in enumerate(total):
                v = pa.array(list(map(Decimal, row)), pa.decimal128(38, 0)) if exact else pa.array(row)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(row), i, np.int32)), pa.array(np.arange(len(row), dtype=np.int32)), v], names=["i", "j", "v"])

    return {(r["i"], r["j"]): r["v"] for r in grid.mapInArrow(add, schema).groupBy("i", "j").agg(F.sum("v").alias("v")).collect()}


def _products(y: np.ndarray) -> np.ndarray:
    """y'y exactly, as Python integers."""
    top = int(np.abs(y).max(initial=0)) ** 2 * len(y)
    if top < _WHOLE:  # every partial sum is exact as a double
        f = y.astype(np.float64)
        return (f.T @ f).astype(np.int64).astype(object)
    y = y.astype(object)
    return y.T @ y


def _with_ones(y: np.ndarray) -> np.ndarray:
    return np.column_stack([np.ones(len(y), y.dtype), y])


def grid_of(vectors: DataFrame, column: str, scale: int) -> DataFrame:
    """The packed grid values of every row kept."""

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array(map(packed, on_grid(b.column(0), scale)[1]), pa.binary())], names=["x"])

    return vectors.select(column).mapInArrow(put, "x binary")


def fit(vectors: DataFrame, column: str = "embedding", components: int = COMPONENTS, scale: int = SCALE) -> Whitening | None:
    """Fits on the distinct grid vectors; None where there are none or all are equal."""
    grid = written(grid_of(vectors, column, scale).distinct(), "grid")
    size = F.octet_length("x") - 1
    lengths = grid.select((size / F.ascii(F.decode(F.substring("x", 1, 1), "ISO-8859-1"))).cast("int").alias("d")).distinct().limit(2).collect()
    if not lengths:
        return None
    if len(lengths) > 1:
        raise ValueError("vectors of different lengths")
    d = lengths[0]["d"]
    first = _summed(grid, lambda y: np.array([[len(y), *y.astype(object).sum(axis=0)]], object))
    n = int(first[0, 0])
    sums = [int(first[0, i + 1]) for i in range(d)]
    mean = np.array([(2 * s + n) // (2 * n) for s in sums], np.int64)
    products = _summed(grid, lambda y: _products(_with_ones(y - mean)))
    rest = [int(products[0, i + 1]) for i in range(d)]
    exact = [[(n * int(products[i + 1, j + 1]) - rest[i] * rest[j]) / (n * n) for j in range(d)] for i in range(d)]
    v = np.array(exact, np.float64)
    trace = float(np.trace(v))
    values, vectors_ = slicing.leading(v, components)
    keep = values > d * slicing.EPS * trace
    if not keep.any():
        return None
    model = Whitening(n, [s + n * SHIFT for s in sums], values[keep], vectors_[:, keep], trace)
    k = int(keep.sum())

    def squares(y: np.ndarray) -> np.ndarray:
        w = _with_ones(model.project(model.deviations(y)))
        return w.T @ w

    seen = _summed(grid, squares, exact=False)
    w = np.array([[seen[i, j] for j in range(k + 1)] for i in range(k + 1)]) / n
    model.identity_error = float(np.abs(w[1:, 1:] - np.outer(w[1:, 0], w[0, 1:]) - np.eye(k)).max())
    return model


def whiten(vectors: DataFrame, model: Whitening, column: str = "embedding", scale: int = SCALE) -> DataFrame:
    """Adds ``whitened`` (one number a component) and ``deviation`` (the squared
    length of n * x - S, exact; null where it does not fit in a long). No shuffle."""
    rows = vectors.drop("whitened", "deviation")
    names, at = rows.columns, rows.columns.index(column)
    schema = T.StructType([*rows.schema.fields, T.StructField("whitened", T.ArrayType(T.DoubleType())), T.StructField("deviation", T.LongType())])

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep, grid = on_grid(b.column(at), scale)
            step = max(1, SLICE // len(model.sums))
            for lo in range(0, len(keep), step):
                deviations = model.deviations(np.stack(grid[lo : lo + step]))
                w = model.project(deviations)
                squared = [int(s) if s < 1 << 63 else None for s in (deviations * deviations).sum(axis=1)]
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(w) + 1) * w.shape[1], pa.int32()), pa.array(w.ravel()))
                yield pa.RecordBatch.from_arrays([*b.take(pa.array(keep[lo : lo + step])).columns, lists, pa.array(squared, pa.int64())], names=[*names, "whitened", "deviation"])

    return rows.mapInArrow(put, schema)


@query("op11_embedding_whitening")
def op11_embedding_whitening(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    model = fit(rows)
    if model is None:
        names = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
        return spark.createDataFrame([], names)
    explained = F.array(*[F.lit(float(e / model.trace)) for e in model.values])
    each = whiten(rows, model).select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    return each.select(
        "vec_id",
        (F.col("at") + 1).alias("component"),
        F.lit(model.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        explained[F.col("at")].alias("explained"),
        F.lit(model.identity_error).alias("identity_error"),
    )
