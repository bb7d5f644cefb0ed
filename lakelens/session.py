"""Session helpers: a local session for tests and benches, and checkpoint setup.

On a cluster the session is built by the caller; the library only reads its
settings. ``spark.checkpoint.dir`` must name a shared folder there; only when it
is unset (local tests) do we pick a private scratch folder of our own.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | str = "*", partitions: int = 8, memory: str = "16g") -> SparkSession:
    """A local session configured the way the tests and the bench expect."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("lakelens")
    for key, value in DEFAULT_CONF.items():
        builder = builder.config(key, value)
    builder = builder.config("spark.sql.shuffle.partitions", str(partitions))
    # Local runs keep managed tables out of the working directory.
    builder = builder.config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="lakelens-warehouse-"))
    builder = builder.config("spark.driver.memory", memory)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Make sure RDD/Dataset checkpoints have a folder and return it.

    The cluster names a shared, fault-tolerant folder in ``spark.checkpoint.dir``;
    we use it as is. Only if nothing is configured (a local test session) do we
    create a scratch folder of our own.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if sc.master != "local" and not sc.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a shared, fault-tolerant folder: iterative jobs "
                               "checkpoint there and streaming jobs keep their sinks and offsets there")
        configured = tempfile.mkdtemp(prefix="lakelens-ckpt-")  # local tests only
    sc.setCheckpointDir(configured)
    return configured


def cut_lineage(df):
    """Reliable checkpoint (survives executor loss), used by iterative loops."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def groups_for(rows: int, rows_per_group: int = 1_000_000, minimum: int = 1) -> int:
    """Number of hash buckets / salts so that each holds about
    ``rows_per_group`` rows: the fan-out grows with the data instead of being
    a constant (a fixed 8 buckets would put 1/8 of 100 TB in one task)."""
    return max(minimum, -(-int(rows) // rows_per_group))
