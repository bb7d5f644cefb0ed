"""Sharding by a two-pass external shuffle (operator 3).

Pass 1 scatters the records uniformly into memory-sized buckets by a seeded
hash. Pass 2 loads one bucket per task, shuffles it with a seeded Fisher-Yates
permutation and writes it. The written buckets, one after the other, are one
random order of all records; position ``p`` of it goes to shard ``p mod shards``
as slot ``p div shards``, so that shard sizes in rows differ by one at most
(the ``rows`` law).

Defined cases: a null text has size 1 and the checksum of an empty text;
repeated rows and null ids are scattered like any other row (the row's place in
the scan is part of its hash); an empty table gives no rows; all other columns
travel in ``record``, so that their names cannot clash.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakelens.llm.common import table, written

SEED = 20_240_229
SHARDS = 16
BUCKET_BYTES = 64 << 20


def shuffled_records(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = SEED,
                     bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """(record, size, text_crc32, bucket, place): the written, shuffled buckets."""
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(""))
    total = docs.agg(F.sum(F.octet_length(text) + 1)).first()[0] or 0
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // bucket_bytes))
    crc = F.crc32(F.encode(text, "UTF-8"))
    rows = docs.select(F.struct("*").alias("record"), (F.octet_length(text) + 1).cast("long").alias("size"), crc.alias("text_crc32"),
                       F.xxhash64(F.lit(seed), F.col(id_col), crc, F.monotonically_increasing_id()).alias("tie"))
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64(F.lit(seed), "tie"), F.lit(buckets)))

    def shuffle(bucket: pa.Table) -> pa.Table:
        at = bucket.column("bucket")[0].as_py()
        canonical = np.argsort(bucket.column("tie").to_numpy(), kind="stable")  # arrival order is by chance
        order = canonical.copy()
        np.random.default_rng([seed, at]).shuffle(order)  # Fisher-Yates
        out = bucket.drop_columns(["tie"]).take(pa.array(order))
        return out.append_column("place", pa.array(np.arange(len(order), dtype=np.int64)))

    schema = rows.drop("tie").withColumn("place", F.lit(0).cast("long")).schema
    return written(rows.groupBy("bucket").applyInArrow(shuffle, schema), "shuffled-buckets")


def shard_documents(docs: DataFrame, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text",
                    seed: int = SEED, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """(record, size, text_crc32, shard, slot) for every row of ``docs``.

    The table of bucket offsets has a row per bucket (100 TB make 1.6 million)."""
    rows = shuffled_records(docs, id_col, text_col, seed, bucket_bytes)
    counts = rows.groupBy("bucket").agg(F.count("*").alias("n"))
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    at = F.col("start") + F.col("place")
    return rows.join(F.broadcast(offsets), "bucket").select(
        "record", "size", "text_crc32", (at % shards).cast("int").alias("shard"), F.floor(at / shards).cast("long").alias("slot"))


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder per shard; files hold ``slot`` and the record's columns."""
    sharded.select("shard", "slot", "record.*").write.partitionBy("shard").parquet(path)


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    sharded = shard_documents(table(spark, sf_dir, "documents"))
    return sharded.select("record.doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                          F.lit(None).cast("int").alias("grown_shard"))
