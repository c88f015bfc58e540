"""Whitening of embeddings by principal components, with exact integer moments.

Entries become integers, x = floor(scale * c) + shift. What is multiplied are the centred integers z = n * x - S: tasks cut
them into signed limbs of LIMB bits, of which BLAS multiplies a pair at a time in float64 without rounding, recombine the products
as Python integers of any size, and give one row of sums per dimension. These are added up on executors, row by row as they
come in; the driver gets the finished matrix alone (dimensions squared), divides once and decomposes it. So neither the order of the rows
nor how they were dealt to tasks can change a digit of the covariance, however large shift and n are.

Four scans of the vector column (sums, products, check of the result, result) and no shuffle of vectors.

Defined cases: rows whose vector is null, empty, or holds null or non-finite entries drop out, and so do vectors of another
length than the commonest (of equally common ones the longest); repeated rows count each; ids are not looked at, null ones stay;
entries beyond 2**61 / scale count as that; a component without variance (an eigenvalue that is 0 to double precision) whitens to null; an
empty table, or one without usable vectors, gives no rows; all columns pass through, and an output whose name is taken gets an
underscore more. Vectors may have 32,768 dimensions.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import fresh

#: Bits of a limb, and rows that are multiplied at once: 2 * (LIMB - 1) bits a product and 12 for the rows fit in 53.
LIMB, ROWS = 20, 1 << 12
LARGEST = 2.0**61
WHOLE = "decimal(38,0)"


@dataclass
class Whitening:
    """A fitted whitening. ``components`` holds unit eigenvectors as rows, by falling eigenvalue; trace is that of the covariance."""

    scale: int
    shift: int
    dims: int
    n: int
    sums: list[int]
    components: np.ndarray
    values: np.ndarray
    trace: float

    @property
    def explained(self) -> list[float]:
        return [float(e / self.trace) if self.trace > 0 else 0.0 for e in self.values]

    def floor(self) -> float:
        """Eigenvalues up to here are 0 to double precision."""
        return self.dims * np.finfo(float).eps * max(float(self.values[0]), 0.0)


def _usable(vectors: DataFrame, column: str) -> tuple[DataFrame, str]:
    """Rows with a whole, finite vector, and the name of a further column that holds it as doubles."""
    name = fresh("_vector", vectors.columns)
    c = F.col(column).cast("array<double>")
    finite = F.forall(c, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vectors.where(c.isNotNull() & (F.size(c) > 0) & finite).withColumn(name, c), name


def _integers(vectors: pa.Array, dims: int, scale: int, shift: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        scaled = np.floor(vectors.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims) * scale)
    return np.clip(scaled, -LARGEST, LARGEST).astype(np.int64) + shift


def _centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n * x - sums, in 64 bits where they hold it, else as Python integers."""
    most = int(np.abs(x).max(initial=0)) * n + max(map(abs, sums))
    kind = np.int64 if most < 2**62 else object
    return x.astype(kind) * n - np.array(sums, kind)


def limbs(z: np.ndarray) -> list[np.ndarray]:
    """Signed digits to the base 2**LIMB, lowest first, as float64."""
    half, out = 1 << (LIMB - 1), []
    while True:
        low = ((z + half) & (2 * half - 1)) - half
        out.append(low.astype(np.float64))
        z = (z - low) >> LIMB
        if not z.any():
            return out


def _recombined(parts: list[np.ndarray], product: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> np.ndarray:
    """The sum over all pairs of limbs of their product, shifted by their places, as Python integers."""
    total: np.ndarray | int = 0
    for p, a in enumerate(parts):
        for q, b in enumerate(parts):
            total = total + (product(a, b).astype(np.int64).astype(object) << LIMB * (p + q))
    return np.asarray(total)


def gram(z: np.ndarray) -> np.ndarray:
    """z.T @ z of integers, exact."""
    return sum((_recombined(limbs(z[k : k + ROWS]), lambda a, b: a.T @ b) for k in range(0, len(z), ROWS)), np.zeros((z.shape[1],) * 2, object))


def squares(z: np.ndarray) -> list[int]:
    """By row, the sum of squares of integers, exact."""
    return [v for k in range(0, len(z), ROWS) for v in _recombined(limbs(z[k : k + ROWS]), lambda a, b: np.einsum("ij,ij->i", a, b)).tolist()]


def _sums(rows: DataFrame, name: str, scale: int, shift: int) -> tuple[int, int, list[int]]:
    """Dimensions, number and sums by dimension of the vectors of the commonest length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = pc.list_value_length(batch.column(0))
            for dims in pc.unique(lengths).to_pylist():
                x = _integers(batch.column(0).filter(pc.equal(lengths, dims)), dims, scale, shift)
                # halves are added apart, as a sum of many large entries is longer than 64 bits
                total = [(int(h) << 31) + int(low) for h, low in zip((x >> 31).sum(0), (x & (2**31 - 1)).sum(0), strict=True)]
                yield pa.record_batch(
                    [pa.array([dims] * dims, pa.int32()), pa.array(range(dims), pa.int32()), pa.array([len(x)] * dims, pa.int64()), pa.array(list(map(Decimal, total)), pa.decimal128(38, 0))],
                    names=["dims", "i", "n", "s"],
                )

    summed = rows.select(name).mapInArrow(run, f"dims int, i int, n long, s {WHOLE}").groupBy("dims", "i").agg(F.sum("n").alias("n"), F.sum("s").cast(WHOLE).alias("s"))
    # an entry per dimension, and of all lengths the one row that is used
    by_length = summed.groupBy("dims").agg(F.max("n").alias("n"), F.array_sort(F.collect_list(F.struct("i", "s"))).alias("s"))
    best = by_length.orderBy(F.desc("n"), F.desc("dims")).first()
    return (best["dims"], best["n"], [int(r["s"]) for r in best["s"]]) if best is not None else (0, 0, [])


def _products(rows: DataFrame, name: str, dims: int, n: int, sums: list[int], scale: int, shift: int) -> list[list[int]]:
    """The sums of products of the centred integers, one row and column a dimension."""

    def multiplied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                one = gram(_centred(_integers(batch.column(0), dims, scale, shift), n, sums))
                total = one if total is None else total + one
        if total is not None:
            yield pa.record_batch([pa.array(range(dims), pa.int32()), pa.array([list(map(str, r)) for r in total.tolist()])], names=["i", "sums"])

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[int]] = {}
        for batch in batches:
            for i, said in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                row = list(map(int, said))
                held[i] = [a + b for a, b in zip(held[i], row, strict=True)] if i in held else row
        yield pa.record_batch([pa.array(list(held), pa.int32()), pa.array([list(map(str, r)) for r in held.values()], pa.list_(pa.string()))], names=["i", "sums"])

    schema = "i int, sums array<string>"
    found = rows.select(name).mapInArrow(multiplied, schema).repartition("i").mapInArrow(merged, schema).collect()
    return [list(map(int, r["sums"])) for r in sorted(found, key=lambda r: r["i"])]


def fit(vectors: DataFrame, column: str = "embedding", components: int = 8, scale: int = 1024, shift: int = 100_000) -> Whitening | None:
    """The whitening of all usable vectors; None if there are none."""
    rows, name = _usable(vectors, column)
    dims, n, sums = _sums(rows, name, scale, shift)
    if not n:
        return None
    rows = rows.where(F.size(name) == dims)
    products = _products(rows, name, dims, n, sums, scale, shift)
    # integers of any size, divided once and rounded rightly
    covariance = np.array([[p / n**3 for p in row] for row in products])
    values, vectors_ = np.linalg.eigh(covariance)
    kept = vectors_.T[::-1][:components]
    signs = np.sign(kept[np.arange(len(kept)), np.abs(kept).argmax(1)])
    return Whitening(scale, shift, dims, n, sums, kept * signs[:, None], values[::-1][:components], sum(products[i][i] for i in range(dims)) / n**3)


def _whitened(x: np.ndarray, model: Whitening) -> tuple[np.ndarray, np.ndarray]:
    """The centred integers, and the whitened values; those of a component without variance are NaN."""
    z = _centred(x, model.n, model.sums)
    centred = (z / model.n).astype(np.float64)
    e = np.where(model.values > model.floor(), model.values, np.nan)
    return z, centred @ model.components.T / np.sqrt(e)


def _rows(vectors: DataFrame, column: str, model: Whitening) -> tuple[DataFrame, str]:
    rows, name = _usable(vectors, column)
    return rows.where(F.size(name) == model.dims), name


def apply(vectors: DataFrame, model: Whitening | None, column: str = "embedding") -> DataFrame:
    """The usable rows with whitened (array, one entry a component) and deviation (the sum over dimensions of (n * x - S)**2,
    exact; null beyond 38 digits)."""
    whitened, deviation = (fresh(x, vectors.columns) for x in ("whitened", "deviation"))
    if model is None:
        none = vectors.limit(0)
        return none.select("*", F.lit(None).cast("array<double>").alias(whitened), F.lit(None).cast(WHOLE).alias(deviation))
    rows, name = _rows(vectors, column, model)
    schema = T.StructType([*vectors.schema.fields, T.StructField(whitened, T.ArrayType(T.DoubleType())), T.StructField(deviation, T.DecimalType(38, 0))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            z, w = _whitened(_integers(batch.column(batch.num_columns - 1), model.dims, model.scale, model.shift), model)
            flat = pa.array(w.ravel(), from_pandas=True)  # NaN: null
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(w) + 1, dtype=np.int32) * w.shape[1]), flat)
            far = pa.array([Decimal(v) if v < 10**38 else None for v in squares(z)], pa.decimal128(38, 0))
            yield pa.record_batch([*batch.columns[:-1], lists, far], names=[*batch.schema.names[:-1], whitened, deviation])

    return rows.select(*vectors.columns, name).mapInArrow(run, schema)


def identity_error(vectors: DataFrame, model: Whitening | None, column: str = "embedding") -> float | None:
    """The largest absolute entry of the whitened vectors' covariance minus the identity, over the components with variance;
    centred by batch, and batches merged by their means. Null without vectors or such components."""
    if model is None:
        return None
    rows, name = _rows(vectors, column, model)
    names = ["i", "j", "n", "a", "b", "m"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                _, w = _whitened(_integers(batch.column(0), model.dims, model.scale, model.shift), model)
                w = w[:, model.values > model.floor()]
                mean = w.mean(0)
                m = (w - mean).T @ (w - mean)
                i, j = np.triu_indices(len(mean))
                yield pa.record_batch([pa.array(x) for x in (i, j, np.full(len(i), len(w)), mean[i], mean[j], m[i, j])], names=names)

    moments = rows.select(name).mapInArrow(run, "i long, j long, n long, a double, b double, m double").groupBy("i", "j").agg(
        F.sum("n").alias("n"), F.sum(F.col("n") * F.col("a")).alias("a"), F.sum(F.col("n") * F.col("b")).alias("b"), F.sum(F.col("m") + F.col("n") * F.col("a") * F.col("b")).alias("m")
    )
    n = F.col("n")
    covariance = (F.col("m") - F.col("a") * F.col("b") / n) / n
    return moments.agg(F.max(F.abs(covariance - F.when(F.col("i") == F.col("j"), 1.0).otherwise(0.0)))).first()[0]


def by_component(rows: DataFrame, model: Whitening | None, *keep: Column | str) -> DataFrame:
    """A row for each row of apply() and component: keep, component (from 1), whitened, explained."""
    shares = F.array(*[F.lit(x) for x in (model.explained if model is not None else [])]).cast("array<double>")
    out = rows.select(*keep, F.posexplode("whitened").alias("component", "whitened"))
    return out.withColumn("component", F.col("component") + 1).withColumn("explained", F.element_at(shares, F.col("component")))
