"""Structured Streaming forms of the log operators (T-1 .. T-5).

* T-3 usage over closed days: event-time windows of one day with a one-day
  watermark, appended only once closed; longer look-backs are sums of days.
* T-4 de-duplication within the watermark.
* T-1 session pairing is in ``pairing``.
* T-2 ``resume`` goes on where the last run of a query over the same folder ended.
* T-5 ``foreachBatch`` sink that packs every micro-batch into size-bounded
  batch files.

Sinks are files under a per-run folder of the shared checkpoint directory;
``run_available_now`` drives a query to the end of its input (trigger
availableNow) and returns what it wrote as a batch DataFrame.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lakelens.session import ensure_checkpoint_dir

# State with timers needs this store; others may use it too.
STATE_CONF = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}


@contextmanager
def state_conf(spark: SparkSession) -> Iterator[None]:
    """The settings under which state is written and read."""
    before = {key: spark.conf.get(key, None) for key in STATE_CONF}
    for key, value in STATE_CONF.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def run_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder for one streaming run (sink + checkpoint) in the shared checkpoint dir."""
    root = ensure_checkpoint_dir(spark)
    return os.path.join(root, "streams", f"{name}-{uuid.uuid4().hex[:12]}")


def resume(stream: DataFrame, folder: str, output_mode: str = "append", fmt: str = "parquet") -> StreamingQuery:
    """T-2: run ``stream`` over what its source has that earlier runs with this ``folder``
    have not read, and append to the folder's sink. The source's position, the state
    and the sink's list of committed files live in ``folder``, so a run that was ended
    between writing and committing is repeated without doubles. Returns the ended
    query; ``landed`` reads the sink."""
    with state_conf(stream.sparkSession):
        q = (stream.writeStream.format(fmt).outputMode(output_mode).option("path", os.path.join(folder, "out"))
             .option("checkpointLocation", os.path.join(folder, "checkpoint")).trigger(availableNow=True).start())
        q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return q


def landed(spark: SparkSession, folder: str, fmt: str = "parquet") -> DataFrame:
    """What the runs of ``resume`` with this ``folder`` have committed."""
    return spark.read.format(fmt).load(os.path.join(folder, "out"))


def run_available_now(stream: DataFrame, name: str, output_mode: str = "append", fmt: str = "parquet",
                      read: Callable[[SparkSession, str], DataFrame] | None = None) -> DataFrame:
    """One run over everything in the source, in a folder of its own; ``read`` makes the
    result from that folder, where what the sink holds is not all."""
    folder = run_dir(stream.sparkSession, name)
    resume(stream, folder, output_mode, fmt)
    if read is None:
        return landed(stream.sparkSession, folder, fmt)
    with state_conf(stream.sparkSession):
        return read(stream.sparkSession, folder)


def closed_day_counts(events: DataFrame, ts: str, keys: list[str], watermark: str = "1 day") -> DataFrame:
    """T-3: per closed UTC day and key, the number of events. Event time must be
    a TIMESTAMP (a TIMESTAMP_NTZ column is cast)."""
    t = F.col(ts).cast("timestamp")
    x = events.withColumn("__ts", t).withWatermark("__ts", watermark)
    return x.groupBy(F.window("__ts", "1 day").alias("w"), *keys).agg(F.count(F.lit(1)).alias("n")) \
        .select(F.col("w.start").alias("day_start"), F.col("w.end").alias("day_end"), *keys, "n")


def dedup_within_watermark(events: DataFrame, ts: str, keys: list[str], watermark: str = "1 hour") -> DataFrame:
    """T-4: drop later copies of a key seen within the watermark delay."""
    return events.withColumn("__ts", F.col(ts).cast("timestamp")).withWatermark("__ts", watermark) \
        .dropDuplicatesWithinWatermark(keys).drop("__ts")


def packed_batch_sink(path: str, order: str, size: str, items_per_chunk: int, chunk_size: int):
    """T-5: a foreachBatch function that packs each micro-batch (K-4) and writes
    it as JSON partitioned by (epoch, batch). A micro-batch that is
    run again after a failure overwrites its own epoch folder (dynamic
    partition overwrite) instead of appending a second copy."""
    from lakelens.operators import emit

    def write(batch_df: DataFrame, epoch_id: int) -> None:
        packed = emit.pack(batch_df, order, size, items_per_chunk, chunk_size).withColumn("epoch", F.lit(epoch_id))
        (packed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("epoch", "batch").json(path))
    return write
