"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import string
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakelens.session import ensure_checkpoint_dir


def shared_path(spark: SparkSession, name: str) -> str:
    """A new folder name below the shared checkpoint folder of the session."""
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    This cuts lineage so that a lost executor costs a re-read, not a
    recomputation, and fixes values such as row numbers once and for all."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def settled(df: DataFrame, name: str) -> DataFrame:
    """``written`` for large intermediate tables: the shuffle files of the write go as
    soon as it has ended, not when the driver happens to collect its garbage."""
    spark, key = df.sparkSession, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "true")
    try:
        return written(df, name, "zstd")
    finally:
        spark.conf.set(key, before)


def released(*tables: DataFrame) -> None:
    """Empty the files of tables from ``written`` or ``settled`` that nothing reads any
    more; only what has been computed from them may still be used."""
    for df in tables:
        files = df.inputFiles()
        if files:
            # No rows from Python: those would start a worker for each core, which stay.
            none = df.sparkSession.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in df.schema])
            none.write.mode("overwrite").parquet(files[0].rsplit("/", 1)[0])


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only. Pure ASCII texts take the byte-wise ``lower``."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@contextmanager
def small_batches(spark: SparkSession, rows: int = 1000) -> Iterator[None]:
    """Arrow batches of at most ``rows`` rows for the jobs run inside; both ends hold
    a batch several times while it is built and read."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    if not 0 < int(before) <= rows:
        spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def given_back(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run`` for ``mapInArrow``: between batches and when a task ends, its Python worker,
    which stays for later tasks and stages, returns the memory that it no longer uses to
    the system."""

    def give_back() -> None:
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
        if trim:
            trim(0)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch
            del batch
            give_back()

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(each(batches))
        finally:
            give_back()

    return whole
