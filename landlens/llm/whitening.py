"""Embedding whitening (operator 13): exact covariance in Spark, principal components by contour integration.

1. Rows.  A vector that is null, has a null or non-finite entry, or an entry of 2^46
   or more (whose whole number no double holds) is dropped, and so is one of another
   length than the commonest (the longer on a tie; no entries: dropped).  An entry c
   becomes the whole number x = floor(64 c) + 1000000.  The x-vectors are written once.
2. n and the sums S: one row a task and dimension, added up by Spark as 38-digit
   decimals.
3. Covariance: x minus the whole number next to the mean, products exact (20-bit limbs,
   each product of limbs exact in doubles), one row a task and pair of dimensions,
   added up as decimals; the fraction of the mean that was left is taken off exactly.
4. Components: ``feast.largest`` on the d x d matrix on the driver, whose size depends
   on the dimension only (at most ``DIMENSIONS``).
5. Whitening of every row by a d x components matrix, and the check of its covariance.

Defined results: an empty table, or one without usable rows, gives no rows; a
component whose eigenvalue is below ``RANK`` of the largest has no variance to divide
by and is left out (all of them if all vectors are equal); rows with equal ids are
rows of their own; ``deviation`` is null where it exceeds 2^63 - 1, ``deviation_exact``
never is below 10^38.  Other columns are not read and clash with none.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from landlens.session import scratch_path, ship_package

from . import feast

COMPONENTS = 32
SCALE, SHIFT = 64, 1_000_000
#: Dimensions whose covariance the driver holds (two matrices of 16 bytes an entry for each node of the contour).
DIMENSIONS = 2048
RANK = 1e-11
_ENTRY = float(1 << 46)
_LIMB = 20
#: Rows in one product of limbs: 2^(20 + 20 + 12) is exact in a double.
_ROWS = 1 << 12
_LONG = (1 << 63) - 1
_CELLS = "i int, j int, value decimal(38,0)"


@dataclass
class Model:
    """What a fit gives: n, the sums S, the components (columns), their eigenvalues and the covariance's trace."""

    n: int
    sums: list[int]
    vectors: np.ndarray
    values: np.ndarray
    trace: float

    @property
    def near(self) -> np.ndarray:
        """The whole numbers next to the means."""
        return np.array([(2 * s + self.n) // (2 * self.n) for s in self.sums], np.int64)

    @property
    def left(self) -> list[int]:
        """n times what the means have beyond ``near``."""
        return [s - self.n * int(m) for s, m in zip(self.sums, self.near)]


def whole_vectors(rows: DataFrame, path: str, id_col: str = "vec_id", vector_col: str = "embedding") -> tuple[DataFrame, int]:
    """Writes vec_id, x of the usable rows; returns them and the number of dimensions."""
    spark, v = rows.sparkSession, F.col("v")
    d = rows.select(F.col(f"`{id_col}`").alias("vec_id"), F.col(f"`{vector_col}`").cast("array<double>").alias("v"))
    usable = v.isNotNull() & (F.size(v) > 0) & F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < _ENTRY))
    d = d.where(F.coalesce(usable, F.lit(False)))
    d.select("vec_id", F.transform(v, lambda c: F.floor(c * F.lit(float(SCALE))) + F.lit(SHIFT).cast("bigint")).alias("x")).write.parquet(path)
    found = spark.read.parquet(path)
    lengths = found.groupBy(F.size("x").alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("d")).limit(1).collect()
    size = lengths[0].d if lengths else 0
    if size > DIMENSIONS:
        raise ValueError(f"{size} dimensions; at most {DIMENSIONS}")
    return found.where(F.size("x") == size), size


def matrices(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """(rows, their x-vectors as a matrix), at most ``_ROWS`` rows at once."""
    for batch in batches:
        for a in range(0, batch.num_rows, _ROWS):
            part = batch.slice(a, _ROWS)
            yield part, part.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, size)


def limbs(z: np.ndarray) -> list[np.ndarray]:
    """Doubles a, b, ... with z = a + 2^20 b + ..., all but the last below 2^20."""
    out = []
    while np.abs(z).max(initial=0) >= 1 << _LIMB:
        out.append((z & ((1 << _LIMB) - 1)).astype(float))
        z = z >> _LIMB
    return [*out, z.astype(float)]


def whole(x: np.ndarray) -> np.ndarray:
    """Doubles that are whole as Python's unbounded integers."""
    return x.astype(np.int64).astype(object)


def squares(z: np.ndarray) -> np.ndarray:
    """z' z in unbounded integers."""
    parts = limbs(z)
    return sum(whole(p.T @ q) << (_LIMB * (i + j)) for i, p in enumerate(parts) for j, q in enumerate(parts))


def cells(values: dict[tuple[int, int], int]) -> pa.RecordBatch:
    at = list(values)
    return pa.RecordBatch.from_arrays([pa.array([i for i, _ in at], pa.int32()), pa.array([j for _, j in at], pa.int32()),
                                       pa.array([Decimal(int(values[k])) for k in at], pa.decimal128(38, 0))], names=["i", "j", "value"])


def added(x: DataFrame, task: Callable) -> dict[tuple[int, int], int]:
    """The cells that every task gives, added up in Spark; as many rows as there are cells."""
    summed = x.select("x").mapInArrow(task, _CELLS).groupBy("i", "j").agg(F.sum("value").alias("value"))
    return {(r.i, r.j): int(r.value) for r in summed.collect()}


def fit(x: DataFrame, size: int, components: int = COMPONENTS) -> Model | None:
    """The model of the x-vectors; None if there are none."""
    if not size:
        return None

    def sums(batches):
        n, low, high = 0, np.zeros(size, np.int64), np.zeros(size, np.int64)
        for _, m in matrices(batches, size):
            n, low, high = n + len(m), low + (m & 0xFFFFFFFF).sum(0), high + (m >> 32).sum(0)
        if n:
            yield cells({(-1, -1): n} | {(i, -1): (int(high[i]) << 32) + int(low[i]) for i in range(size)})

    got = added(x, sums)
    if not got:
        return None
    n = got[-1, -1]
    model = Model(n, [got[i, -1] for i in range(size)], np.zeros((size, 0)), np.zeros(0), 0.0)
    near = model.near

    def products(batches):
        total = None
        for _, m in matrices(batches, size):
            s = squares(m - near)
            total = s if total is None else total + s
        if total is not None:
            yield cells({(i, j): total[i, j] for i in range(size) for j in range(i, size)})

    got, left = added(x, products), model.left
    covariance = np.zeros((size, size))
    for (i, j), s in got.items():
        covariance[i, j] = covariance[j, i] = float(Fraction(n * s - left[i] * left[j], n * n))
    model.trace = float(np.trace(covariance))
    values, vectors = feast.largest(covariance, components)
    live = values > RANK * values.max(initial=0)
    model.values, model.vectors = values[live], vectors[:, live]
    return model


def projector(model: Model) -> Callable[[np.ndarray], np.ndarray]:
    """Whitened vectors of a matrix of x-vectors."""
    near, beyond, scaled = model.near, np.array([s / model.n for s in model.left]), model.vectors / np.sqrt(model.values)
    return lambda m: ((m - near).astype(float) - beyond) @ scaled


def identity_error(x: DataFrame, size: int, model: Model) -> float:
    """Largest absolute entry of the whitened vectors' covariance minus the identity, measured on all rows."""
    k, project = len(model.values), projector(model)

    def moments(batches):
        first, second = np.zeros(k), np.zeros((k, k))
        for _, m in matrices(batches, size):
            y = project(m)
            first, second = first + y.sum(0), second + y.T @ y
        yield pa.RecordBatch.from_arrays([pa.array(np.r_[np.repeat(np.arange(k), k), np.arange(k)], pa.int32()), pa.array(np.r_[np.tile(np.arange(k), k), np.full(k, -1)], pa.int32()),
                                          pa.array(np.r_[second.ravel(), first])], names=["i", "j", "value"])

    got = {(r.i, r.j): r.value for r in x.select("x").mapInArrow(moments, "i int, j int, value double").groupBy("i", "j").agg(F.sum("value").alias("value")).collect()}
    mean = np.array([got[i, -1] for i in range(k)]) / model.n
    second = np.array([[got[i, j] for j in range(k)] for i in range(k)]) / model.n
    return float(np.abs(second - np.outer(mean, mean) - np.eye(k)).max(initial=0))


def deviations(m: np.ndarray, model: Model) -> list[int]:
    """Sum over the dimensions of (n x - S)^2 of each row, exact."""
    z, left = m - model.near, model.left
    most = model.n * (int(np.abs(z).max(initial=0)) + 1)
    if most * most * m.shape[1] <= _LONG:
        off = z * np.int64(model.n) - np.array(left, np.int64)
        return (off * off).sum(1).tolist()
    off = z.astype(object) * model.n - np.array(left, object)
    return (off * off).sum(1).tolist()


def transform(x: DataFrame, size: int, model: Model) -> DataFrame:
    """vec_id, deviation, deviation_exact, whitened (an array, one entry a component) of every row."""
    project = projector(model)
    schema = T.StructType([T.StructField("vec_id", x.schema["vec_id"].dataType), T.StructField("deviation", T.LongType()),
                           T.StructField("deviation_exact", T.DecimalType(38, 0)), T.StructField("whitened", T.ArrayType(T.DoubleType()))])

    def task(batches):
        for rows, m in matrices(batches, size):
            far, y = deviations(m, model), project(m)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, y.size + 1, y.shape[1]), pa.int32()), pa.array(y.ravel()))
            wide = pa.array([Decimal(v) if v < 10**38 else None for v in far], pa.decimal128(38, 0))
            yield pa.RecordBatch.from_arrays([rows.column("vec_id"), pa.array([v if v <= _LONG else None for v in far], pa.int64()), wide, lists],
                                             names=["vec_id", "deviation", "deviation_exact", "whitened"])

    return x.mapInArrow(task, schema)


def whiten(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """vec_id, component (from 1), n, deviation, whitened, explained, identity_error, deviation_exact of every usable row and component."""
    spark = rows.sparkSession
    ship_package(spark)
    x, size = whole_vectors(rows, scratch_path(spark, "whitening"), id_col, vector_col)
    model = fit(x, size, components)
    if model is None or not len(model.values):
        return (x.limit(0).select("vec_id").withColumns({"component": F.lit(1), "n": F.lit(0).cast("bigint"), "deviation": F.lit(0).cast("bigint"), "whitened": F.lit(0.0),
                                                         "explained": F.lit(0.0), "identity_error": F.lit(0.0), "deviation_exact": F.lit(0).cast("decimal(38,0)")}))
    error = identity_error(x, size, model)
    out = transform(x, size, model).select("vec_id", "deviation", "deviation_exact", F.posexplode("whitened").alias("k", "whitened"))
    explained = F.array(*[F.lit(float(e / model.trace)) for e in model.values])
    return out.select("vec_id", (F.col("k") + 1).alias("component"), F.lit(model.n).cast("bigint").alias("n"), "deviation", "whitened",
                      F.get(explained, F.col("k")).alias("explained"), F.lit(error).alias("identity_error"), "deviation_exact")
