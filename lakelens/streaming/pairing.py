"""T-1: statement / duration pairing of log sessions as an event-time stream.

Sessions are dealt over ``shards`` and their lines kept by (shard, hour), so that the
number of keys, and of calls between the state store and Python, depends on hours and
shards and not on sessions. Lines wait in list state, the lines of one call packed as
one value, until the watermark has passed their hour; then an event-time timer pairs
them in order and drops the state. Lines behind the watermark are late and dropped, as
everywhere in Structured Streaming.

With ``gap_seconds`` a statement pairs with a duration line at most that much later:
lines of the last minutes of an hour also go to the next hour, where they can only be
the statement that a duration line refers to. Without, a duration line takes the line
before it however old: every hour also tells the edges of its sessions, and
``whole_pairs`` joins them, the hours that are still open included.
"""

from __future__ import annotations

import os
from collections.abc import Iterable, Iterator, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from lakelens.functions.scalars import duration_text_seconds

OUT = T.StructType([
    T.StructField("session", T.StringType()), T.StructField("user_name", T.StringType()), T.StructField("database", T.StringType()),
    T.StructField("start_time", T.TimestampNTZType()), T.StructField("line_no", T.LongType()), T.StructField("sql", T.StringType()),
    T.StructField("duration_seconds", T.DoubleType()),
])
# Also the edges of a session's hour: its "first" line, if that is a duration line, and
# its "last" line (no sql: not a statement).
EDGED = T.StructType([*OUT.fields, T.StructField("edge", T.StringType()), T.StructField("hour", T.LongType())])
LINE = ("session", "micros", "line_no", "user_name", "database", "context", "spent", "sql", "seconds")
PACKED = T.StructType([T.StructField("packed", T.BinaryType())])


def pack(lines: pd.DataFrame) -> bytes:
    table = pa.Table.from_pandas(lines[list(LINE)], preserve_index=False)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="lz4")) as writer:
        writer.write_table(table)
    return sink.getvalue().to_pybytes()


def unpack(values: Iterable[bytes]) -> pd.DataFrame:
    lots = [pa.ipc.open_stream(value).read_all() for value in values]
    return pa.concat_tables(lots, promote_options="permissive").to_pandas()


def pairs_of(lines: pd.DataFrame, hour: int, gap_micros: int | None) -> pd.DataFrame:
    """Rows of the duration lines among the ``lines`` (LINE) of some sessions in one
    hour: OUT with a gap, EDGED without."""
    lines = lines.sort_values(["session", "micros", "line_no"], kind="stable", ignore_index=True)
    before = lines.shift(1)
    inside = lines["session"].eq(before["session"]).fillna(False).astype(bool)
    spent = lines["spent"].astype(bool)
    hit = inside & spent & ~lines["context"].astype(bool) & before["sql"].notna()
    if gap_micros is not None:
        hit &= lines["micros"] - before["micros"] <= gap_micros
    said, at = before[hit], lines[hit]
    pairs = pd.DataFrame({"session": at["session"], "user_name": at["user_name"], "database": at["database"],
                          "start_time": pd.to_datetime(said["micros"].astype("int64"), unit="us"), "line_no": said["line_no"].astype("int64"),
                          "sql": said["sql"], "duration_seconds": at["seconds"].astype("float64")})
    if gap_micros is not None:
        return pairs
    ends = ~lines["session"].eq(lines["session"].shift(-1)).fillna(False).astype(bool)
    edges = [lines[~inside & spent].assign(edge="first"), lines[ends].assign(edge="last")]
    told = pd.concat([pairs.assign(edge=None)] + [
        pd.DataFrame({"session": e["session"], "user_name": e["user_name"], "database": e["database"],
                      "start_time": pd.to_datetime(e["micros"].astype("int64"), unit="us"), "line_no": e["line_no"].astype("int64"),
                      "sql": e["sql"], "duration_seconds": e["seconds"].astype("float64"), "edge": e["edge"]}) for e in edges], ignore_index=True)
    return told.assign(hour=hour)


class SessionHours(StatefulProcessor):
    """State of one (shard, hour): its lines until the hour is closed."""

    def __init__(self, gap_seconds: int | None, hour_seconds: int):
        self.gap, self.hour = None if gap_seconds is None else gap_seconds * 1_000_000, hour_seconds
        self.columns = (OUT if gap_seconds is not None else EDGED).fieldNames()

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.lines = handle.getListState("lines", PACKED)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        self.lines.appendList([(pack(frame),) for frame in rows])
        self.handle.registerTimer((int(key[1]) + 1) * self.hour * 1000)
        yield pd.DataFrame(columns=self.columns)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        lines = unpack(value[0] for value in self.lines.get())
        self.lines.clear()
        yield pairs_of(lines, int(key[1]), self.gap)[self.columns]

    def close(self) -> None:
        pass


def pair_sessions(parsed: DataFrame, excluded_users: Sequence[str] = (), gap_seconds: int | None = 600, hour_seconds: int = 3600,
                  delay: str = "1 hour", shards: int = 64) -> DataFrame:
    """Streaming ``parsed`` log lines to pairs, appended once their hour is closed; the
    same pairs as ``logs.pair_statement_duration`` with that gap. Without a gap, the
    sink also takes edges and is read by ``whole_pairs``. ``shards`` stays the same
    over the runs of one folder; a key holds one hour's lines of the sessions of a shard."""
    timed = parsed.withColumn("event_time", F.col("log_time").cast("timestamp")).withWatermark("event_time", delay)
    lines = timed.filter((F.col("log_level") == "LOG") & F.col("event_time").isNotNull())  # without a time a line has no place
    if excluded_users:
        lines = lines.filter(~F.col("user_name").isin(list(excluded_users)))
    micros = F.unix_micros("event_time")
    hour = F.floor(micros / (hour_seconds * 1_000_000)).cast("long")
    head = F.ltrim(F.get("body", F.lit(0)))
    statement = (F.size("body") >= 2) & (head.startswith("statement") | head.startswith("execute"))
    kept = lines.select(
        F.pmod(F.xxhash64("session"), F.lit(shards)).cast("int").alias("shard"), hour.alias("hour"), "session", "event_time", micros.alias("micros"),
        F.col("line_no").cast("long").alias("line_no"), "user_name", "database", F.lit(False).alias("context"),
        F.coalesce(head.startswith("duration"), F.lit(False)).alias("spent"),
        F.when(statement, F.ltrim(F.array_join(F.slice("body", F.lit(2), F.size("body")), ":"))).alias("sql"),
        F.when(head.startswith("duration"), duration_text_seconds(F.get("body", F.lit(1)))).alias("seconds"))
    if gap_seconds is not None:
        near_end = (F.col("hour") + 1) * hour_seconds * 1_000_000 - F.col("micros") <= gap_seconds * 1_000_000
        seats = F.array(F.struct("hour", "context"), F.when(near_end, F.struct((F.col("hour") + 1).alias("hour"), F.lit(True).alias("context"))))
        kept = kept.withColumn("seat", F.explode(seats)).filter("seat IS NOT NULL").withColumn("hour", F.col("seat.hour")) \
            .withColumn("context", F.col("seat.context")).drop("seat")
    return kept.groupBy("shard", "hour").transformWithStateInPandas(
        SessionHours(gap_seconds, hour_seconds), OUT if gap_seconds is not None else EDGED, "Append", "EventTime")


def _open_hours(spark: SparkSession, folder: str) -> DataFrame:
    """EDGED rows of the hours whose lines still wait in the state."""
    waiting = spark.read.format("statestore").option("stateVarName", "lines").load(os.path.join(folder, "checkpoint"))
    waiting = waiting.select(F.col("key.shard").alias("shard"), F.col("key.hour").alias("hour"), F.col("list_element.packed").alias("packed"))
    names = EDGED.fieldNames()

    def closed(key, frame: pd.DataFrame) -> pd.DataFrame:
        return pairs_of(unpack(frame["packed"]), int(key[1]), None)[names]
    return waiting.groupBy("shard", "hour").applyInPandas(closed, EDGED)


def whole_pairs(spark: SparkSession, folder: str) -> DataFrame:
    """OUT rows of everything that the runs in ``folder`` of a stream without a gap have
    read: pairs within closed hours, pairs within open hours, and pairs across hours (per
    session one row an hour is compared). The open hours are written to ``folder``; their
    state stays, and a later run goes on with it."""
    still_open = os.path.join(folder, "open")
    _open_hours(spark, folder).write.mode("overwrite").parquet(still_open)
    told = spark.read.schema(EDGED).parquet(os.path.join(folder, "out")).unionByName(spark.read.schema(EDGED).parquet(still_open))
    edges = told.filter("edge IS NOT NULL").groupBy("session", "hour").agg(*[
        F.max(F.when(F.col("edge") == edge, F.struct("user_name", "database", "start_time", "line_no", "sql", "duration_seconds"))).alias(edge)
        for edge in ("first", "last")])
    across = edges.withColumn("said", F.lag("last").over(Window.partitionBy("session").orderBy("hour"))) \
        .filter("first IS NOT NULL AND said.sql IS NOT NULL") \
        .select("session", "first.user_name", "first.database", "said.start_time", "said.line_no", "said.sql", "first.duration_seconds")
    return told.filter("edge IS NULL").select(*OUT.fieldNames()).unionByName(across)
