"""Embedding whitening by a weighted multiplicity covariance (operator 12).

1. Rows with the same integer vector meet in one fit row with their count. Its
   weight in the fit is that count or one.
2. Sums are exact integers. Each task centres its fit rows and adds up one weighted
   matrix product; the products are summed in Spark, so that the driver sees only
   the d x d covariance and its eigenvectors.
3. Each distinct vector is whitened once and joined back to its rows by the vector
   itself. Spark splits the join where one vector has very many rows.

Defined cases: null vectors and vectors with a null or non-finite component take no
part; rows without an id keep a null id; repeated rows each get a result; missing
components of shorter vectors are 0; components whose variance is nothing but
rounding (at most d times the machine's precision of the largest) are left out, so
one distinct vector, or none, gives no components; an empty table gives no rows;
integer components beyond 2^52 are an error; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakelens.llm.common import settled, table
from lakelens.llm.vectors import extent, matrix, scaled, usable

COMPONENTS = 16
SCALE, SHIFT = 64, 1_000_000


def _floats(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy().reshape(len(column), width)


def sums(rows: DataFrame, column: str, width: int, weighted: bool) -> tuple[int, list]:
    """(total weight, weighted sum by dimension); exact for integers."""
    integer = dict(rows.dtypes)[column] == "array<bigint>"
    number = "decimal(38,0)" if integer else "double"

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                weight = batch.column("copies").to_numpy() if weighted else np.ones(batch.num_rows, np.int64)
                if integer:
                    total = [Decimal(int(t)) for t in (matrix(batch.column(column), width).astype(object) * weight[:, None]).sum(axis=0)]
                else:
                    total = list(weight @ _floats(batch.column(column), width))
                first = Decimal(int(weight.sum())) if integer else float(weight.sum())
                yield pa.RecordBatch.from_arrays([pa.array(range(-1, width), pa.int32()), pa.array([first, *total], pa.decimal128(38, 0) if integer else pa.float64())],
                                                 names=["dim", "total"])

    found = rows.select(column, "copies").mapInArrow(add, f"dim int, total {number}").groupBy("dim").agg(F.sum("total").alias("total")).collect()
    by = {r.dim: (int(r.total) if integer else r.total) for r in found}
    return int(by.get(-1, 0)), [by.get(i, 0) for i in range(width)]


def covariance(rows: DataFrame, width: int, centred: Callable[[pa.RecordBatch], np.ndarray], weighted: bool) -> np.ndarray:
    """Weighted sum of outer products of the centred rows (not yet divided)."""

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            y = centred(batch)
            total += (y * batch.column("copies").to_numpy()[:, None] if weighted else y).T @ y
        i, j = np.triu_indices(width)
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(total[i, j])], names=["i", "j", "value"])

    found = rows.mapInArrow(products, "i int, j int, value double").groupBy("i", "j").agg(F.sum("value").alias("value")).collect()
    out = np.zeros((width, width))
    for r in found:
        out[r.i, r.j] = out[r.j, r.i] = r.value
    return out


def principal(moment: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, unit eigenvectors as columns) by falling eigenvalue, without those
    that are rounding; the largest entry of each vector is positive."""
    values, vectors = np.linalg.eigh(moment)
    values, vectors = values[::-1], vectors[:, ::-1]
    real = int((values > len(values) * np.finfo(float).eps * max(values[0], 0.0)).sum())
    values, vectors = values[:min(real, most)], vectors[:, :min(real, most)]
    sign = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(len(values))])
    return values, vectors * sign


def whiten(rows: DataFrame, components: int = COMPONENTS, weighted: bool = False, id_col: str = "vec_id", vector_col: str = "x",
           missing: int = 0) -> DataFrame:
    """(vec_id, n long, deviation decimal, whitened array<double>, explained
    array<double>, identity_error double) for every row of ``rows``, which have an
    array of longs. ``n`` is the total weight of the fit, ``deviation`` the exact sum of
    (n * x - S)^2. Shorter vectors are filled up with ``missing``."""
    spark = rows.sparkSession
    vectors = rows.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("x"))
    schema = "vec_id long, n long, deviation decimal(38,0), whitened array<double>, explained array<double>, identity_error double"
    size = extent(vectors, "x")
    if size.most > 1 << 52:
        raise ValueError(f"components up to {size.most} leave the range of exact centring")
    if not size.width:
        return spark.createDataFrame([], schema)
    if size.shortest < size.width:
        vectors = vectors.withColumn("x", F.concat("x", F.array_repeat(F.lit(missing).cast("long"), F.lit(size.width) - F.size("x"))))
    width = size.width
    distinct = settled(vectors.groupBy("x").agg(F.count("*").alias("copies")), "distinct-vectors")
    n, total = sums(distinct, "x", width, weighted)
    base = np.array([s // n for s in total], np.int64)
    rest = [s % n for s in total]
    shares = np.array([r / n for r in rest])

    def centred(batch: pa.RecordBatch) -> np.ndarray:
        return (matrix(batch.column("x"), width) - base) - shares

    moment = covariance(distinct, width, centred, weighted) / n
    values, axes = principal(moment, components)
    kept, trace = len(values), float(np.trace(moment))
    if not kept:
        return spark.createDataFrame([], schema)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            y = centred(batch)
            z = y @ (axes / np.sqrt(values))
            from_base = matrix(batch.column("x"), width) - base
            # n * x - S, in 64 bits where its squares surely fit.
            far = int(np.abs(from_base).max(initial=0)) + 1
            small = width * (n * far) ** 2 < 1 << 62
            off = n * (from_base if small else from_base.astype(object)) - np.array(rest, np.int64 if small else object)
            deviation = pa.array([Decimal(int(d)) for d in (off * off).sum(axis=1)], pa.decimal128(38, 0))
            flat = pa.ListArray.from_arrays(pa.array(np.arange(0, len(z) * kept + 1, kept), pa.int32()), pa.array(z.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column("x"), batch.column("copies"), deviation, flat], names=["x", "copies", "deviation", "whitened"])

    once = settled(distinct.mapInArrow(project, "x array<long>, copies long, deviation decimal(38,0), whitened array<double>"), "whitened-vectors")
    mean = np.array(sums(once, "whitened", kept, weighted)[1]) / n
    again = covariance(once.select("whitened", "copies"), kept, lambda batch: _floats(batch.column("whitened"), kept) - mean, weighted) / n
    error = float(np.abs(again - np.eye(kept)).max())
    explained = F.array(*[F.lit(float(v / trace)) for v in values])
    return vectors.join(once.drop("copies"), "x").select(
        "vec_id", F.lit(n).cast("long").alias("n"), "deviation", "whitened", explained.alias("explained"), F.lit(error).alias("identity_error"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").filter(usable("embedding"))
    found = whiten(rows.select("vec_id", scaled("embedding", SCALE, SHIFT).alias("x")), missing=SHIFT)
    each = found.select("*", F.posexplode(F.arrays_zip("whitened", "explained")).alias("at", "value"))
    return each.select("vec_id", (F.col("at") + 1).alias("component"), "n", F.col("deviation").cast("long").alias("deviation"),
                       F.col("value.whitened").alias("whitened"), F.col("value.explained").alias("explained"), "identity_error")
