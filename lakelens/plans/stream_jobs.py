"""Streaming jobs (T-1, T-3, T-4, T-5): each reads ``events`` as a file stream,
runs to the end of the input (availableNow) and returns what the sink wrote."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from lakelens.operators import logs
from lakelens.plans.common import r6
from lakelens.plans.log_jobs import EXCLUDED_USERS, LOG_SQL
from lakelens.plans.emit_jobs import cuts_sql
from lakelens.plans.registry import register
from lakelens.session import groups_for
from lakelens.sources.tables import read_table, table_path
from lakelens.streaming import jobs, pairing


def event_stream(spark, sf_dir, overlapping: bool = False):
    """``events`` file by file. Of ``overlapping`` files one may make the lines of another
    late; those present come in one micro-batch, in which no line is late."""
    path = table_path(sf_dir, "events")
    stream = spark.readStream.schema(spark.read.parquet(path).schema)
    if not overlapping:
        stream = stream.option("maxFilesPerTrigger", 1)
    return stream.parquet(os.path.join(os.path.dirname(path), "events*.parquet"))


@register("stream_usage_closed_days", """WITH d AS (SELECT date_trunc('day', ts) AS day_start, event_type FROM events),
c AS (SELECT day_start, event_type, CAST(count(*) AS BIGINT) AS n FROM d GROUP BY day_start, event_type)
SELECT day_start, day_start + INTERVAL 1 DAY AS day_end, event_type, n FROM c
WHERE day_start + INTERVAL 1 DAY <= (SELECT max(ts) FROM events) - INTERVAL 1 DAY""")
def stream_usage_closed_days(spark, sf_dir):
    """T-3: daily counts per event type, appended once the day has closed
    (watermark one day); the open tail is withheld."""
    out = jobs.run_available_now(jobs.closed_day_counts(event_stream(spark, sf_dir), "ts", ["event_type"]), "usage_days")
    return out.select(F.col("day_start").cast("timestamp_ntz").alias("day_start"),
                      F.col("day_end").cast("timestamp_ntz").alias("day_end"), "event_type", "n")


@register("stream_dedup", "SELECT event_id, ts FROM events")
def stream_dedup(spark, sf_dir):
    """T-4: a log landed twice, de-duplicated by id within the watermark."""
    s = event_stream(spark, sf_dir).select("event_id", "ts")
    twice = s.unionByName(event_stream(spark, sf_dir).select("event_id", "ts"))
    out = jobs.run_available_now(jobs.dedup_within_watermark(twice, "ts", ["event_id"]), "dedup")
    return out.select("event_id", "ts")


@register("stream_log_pairing", f"""WITH {LOG_SQL}
SELECT session, user_name, database, prev_time AS start_time, prev_line AS line_no,
  ltrim(array_to_string(prev_body[2:], ':')) AS sql,
  round(round(CAST(regexp_extract(body[2], '([0-9]+(?:[.][0-9]+)?) ms', 1) AS DOUBLE) / 1000.0, 10), 6) AS duration_seconds
FROM lagged
WHERE starts_with(ltrim(body[1]), 'duration') AND prev_body IS NOT NULL AND len(prev_body) >= 2
  AND (starts_with(ltrim(prev_body[1]), 'statement') OR starts_with(ltrim(prev_body[1]), 'execute'))""")
def stream_log_pairing(spark, sf_dir):
    """T-1: statement / duration pairing as a stateful stream, every line of the log: days
    that are still open when the stream ends, and statements of any age."""
    from lakelens.plans.log_jobs import text_log_from
    parsed = logs.parse_prefixed_log(text_log_from(event_stream(spark, sf_dir, overlapping=True)))
    shards = groups_for(read_table(spark, sf_dir, "events").count(), 100_000, 16)
    paired = pairing.pair_sessions(parsed, EXCLUDED_USERS, gap_seconds=None, hour_seconds=86400, delay="1 day", shards=shards)
    out = jobs.run_available_now(paired, "pairing", read=pairing.whole_pairs)
    return out.withColumn("duration_seconds", r6("duration_seconds"))


@register("stream_tail", "SELECT event_id, event_type, ts FROM events")
def stream_tail(spark, sf_dir):
    """T-2: events that land in two lots, each read by a run of its own; the second run
    goes on where the first one ended."""
    base = jobs.run_dir(spark, "tail")
    land, events = os.path.join(base, "land"), spark.read.parquet(table_path(sf_dir, "events")).select("event_id", "event_type", "ts")
    for lot in (0, 1):
        events.filter(F.col("event_id") % 2 == lot).write.mode("append").parquet(land)
        jobs.resume(spark.readStream.schema(events.schema).parquet(land), os.path.join(base, "run"))
    return jobs.landed(spark, os.path.join(base, "run"))


# The table is one file, so all rows come in one micro-batch.
@register("stream_packed_sink", f"""WITH {cuts_sql("SELECT event_id AS id, length(props) AS size FROM events", 500, 4096)}
SELECT id AS event_id, 0 AS epoch, CAST(no AS INTEGER) AS batch FROM cuts""")
def stream_packed_sink(spark, sf_dir):
    """T-5: micro-batches packed into size-bounded batches by a foreachBatch sink."""
    base = jobs.run_dir(spark, "packed")
    out, ckpt = os.path.join(base, "out"), os.path.join(base, "checkpoint")
    s = event_stream(spark, sf_dir).select("event_id", F.length("props").alias("size"), "event_type")
    q = (s.writeStream.foreachBatch(jobs.packed_batch_sink(out, "event_id", "size", 500, 4096))
         .option("checkpointLocation", ckpt).trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.json(out).select("event_id", "epoch", "batch")
