"""Readers for the landed parquet tables.

Everything is lazy: the returned DataFrame is a parquet scan, so Catalyst prunes
columns and pushes filters into it. Passing ``columns`` only documents intent;
pruning happens anyway.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str, columns: list[str] | None = None) -> DataFrame:
    df = spark.read.parquet(table_path(sf_dir, name))
    return df.select(*columns) if columns else df


def spread(df: DataFrame, rows_per_part: int | None = None) -> DataFrame:
    """``df`` over all cores, for jobs whose work per row outweighs moving the row: a
    scan with fewer splits than cores is dealt round-robin, a larger one stays as it is.
    With ``rows_per_part`` a larger one is dealt too where its splits hold more rows, so
    that no task's work grows with the table."""
    splits = df.rdd.getNumPartitions()
    parts = df.sparkSession.sparkContext.defaultParallelism
    if rows_per_part is not None:
        parts = max(parts, -(-df.count() // rows_per_part))
    return df.repartition(parts) if splits < parts else df


def register_views(spark: SparkSession, sf_dir: str) -> None:
    """Expose every table as a temp view, for SQL-first callers."""
    for name in TABLES:
        if os.path.exists(table_path(sf_dir, name)):
            read_table(spark, sf_dir, name).createOrReplaceTempView(name)
