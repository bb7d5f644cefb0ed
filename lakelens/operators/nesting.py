"""Nested lists of bounded length.

A list per key cannot grow with the data: a key with a third of all rows would end in
one row. ``nested_lists`` cuts each key's rows, in order, into chunks of at most
``size``; most keys have one chunk.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakelens.session import cut_lineage

LENGTH = 1000


def positions(df: DataFrame, keys: Sequence[str], order: Sequence[str], out: str = "pos") -> DataFrame:
    """``df`` with each row's place (from 0) within ``keys`` by ``order``, without a key in
    one task: rows are range-partitioned by key and order, numbered inside the partition,
    and the counts of a key's earlier partitions are added."""
    by = [F.col(c) for c in (*keys, *order)]
    rows = cut_lineage(df.repartitionByRange(*by).withColumn("__part", F.spark_partition_id()))
    inside = rows.withColumn("__at", F.row_number().over(Window.partitionBy("__part", *keys).orderBy(*order)) - 1)
    counts = rows.groupBy(*keys, "__part").agg(F.count("*").alias("__n"))  # more than one row only for keys that span partitions
    before = Window.partitionBy(*keys).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], F.col("__part").alias("__p"), F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__base"))
    same = (F.col("__part") == F.col("__p"))
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"__k{i}"))
    return inside.join(bases, same).withColumn(out, F.col("__base") + F.col("__at")).select(*df.columns, out)


def nested_lists(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: Column, out: str, size: int = LENGTH) -> DataFrame:
    """(keys, chunk_no, ``out``): lists of ``value`` in order, at most ``size`` in each."""
    placed = positions(df, keys, order).withColumn("chunk_no", F.floor(F.col("pos") / size).cast("int"))
    item = F.struct(F.col("pos"), value.alias("value"))
    return placed.groupBy(*keys, "chunk_no").agg(F.array_sort(F.collect_list(item)).alias("__items")).select(
        *keys, "chunk_no", F.col("__items.value").alias(out))
