"""Readers for landed logs, artifacts and remote catalogs (S-9 .. S-14, S-16).

All return lazy DataFrames; schemas are declared (no inference pass over the
data). Remote reads are partitioned so that every executor pulls a slice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fields of a MySQL-style audit CSV line.
AUDIT_CSV_SCHEMA = T.StructType([
    T.StructField("timestamp_us", T.LongType()), T.StructField("server", T.StringType()),
    T.StructField("user", T.StringType()), T.StructField("host", T.StringType()),
    T.StructField("conn_id", T.LongType()), T.StructField("query_id", T.LongType()),
    T.StructField("statement_type", T.StringType()), T.StructField("database", T.StringType()),
    T.StructField("query", T.StringType()), T.StructField("code", T.IntegerType()),
])


def text_log(spark: SparkSession, path: str) -> DataFrame:
    """S-13: one row per line with (file, line_no) so that later windows can
    order lines of a file. Lines keep their file order inside a split; the
    number is (split position, offset) and stable on recomputation."""
    df = spark.read.text(path).withColumn("file", F.input_file_name())
    return df.withColumn("line_no", F.monotonically_increasing_id())


def audit_csv(spark: SparkSession, path: str) -> DataFrame:
    """S-14: audit CSV with single-quoted fields and backslash escapes; rows
    whose statement type is not QUERY are dropped (the reference logs them
    and still processes them; we drop them on purpose)."""
    df = spark.read.csv(path, schema=AUDIT_CSV_SCHEMA, quote="'", escape="\\", mode="PERMISSIVE")
    return df.filter(F.upper("statement_type") == "QUERY") \
        .withColumn("start_time", F.timestamp_micros("timestamp_us").cast("timestamp_ntz"))


def json_lines(spark: SparkSession, path: str, column: str = "entry") -> DataFrame:
    """S-12: JSON-lines log files as raw text (parsed later with a declared
    schema by ``operators.logs.audit_jobs``)."""
    return spark.read.text(path).withColumnRenamed("value", column)


def whole_files(spark: SparkSession, path: str, column: str = "content") -> DataFrame:
    """S-16 / S-17 / S-20: one row per artifact file (manifest, run results,
    API spec, catalog dump) with its full text and path."""
    return spark.read.text(path, wholetext=True).withColumnRenamed("value", column) \
        .withColumn("file", F.input_file_name())


def jdbc_range(spark: SparkSession, url: str, table: str, column: str, lower, upper, partitions: int,
               properties: dict | None = None) -> DataFrame:
    """S-9 / S-10 / S-11: a catalog or history table read in ``partitions``
    parallel slices of ``column`` (e.g. the start time of a query log); a
    filter on the result becomes a pushed-down WHERE in every slice."""
    return spark.read.jdbc(url, table, column=column, lowerBound=lower, upperBound=upper,
                           numPartitions=partitions, properties=properties or {})


def jdbc_predicates(spark: SparkSession, url: str, table: str, predicates: list[str],
                    properties: dict | None = None) -> DataFrame:
    """S-9: one slice per predicate (e.g. one per database or schema)."""
    return spark.read.jdbc(url, table, predicates=predicates, properties=properties or {})
