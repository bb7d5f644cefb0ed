"""Streams that go on after a restart, and the state they leave."""

import datetime
import glob
import os

from pyspark.sql import functions as F

from lakelens.operators import logs
from lakelens.streaming import jobs, pairing

LINES = "line_no long, log_time timestamp_ntz, user_name string, database string, session string, log_level string, body array<string>"
START = datetime.datetime(2024, 5, 1, 10)


def line(n, seconds, session="s1", body=("  statement", " select 1"), user="ann", level="LOG"):
    return (n, START + datetime.timedelta(seconds=seconds), user, "tides", session, level, list(body))


SPENT = ("  duration", " 12.5 ms")


def batch_pairs(spark, rows, gap):
    return sorted(map(tuple, logs.pair_statement_duration(spark.createDataFrame(rows, LINES), ["bob"], gap_seconds=gap).collect()), key=str)


def stream_of(spark, land):
    return spark.readStream.schema(LINES).parquet(land)


def test_pairs_across_batches_hours_and_a_restart(spark, tmp_path):
    land, folder = str(tmp_path / "land"), str(tmp_path / "run")
    run = lambda: jobs.resume(pairing.pair_sessions(stream_of(spark, land), ["bob"], 600, 3600, "30 minutes"), folder)
    put = lambda rows: spark.createDataFrame(rows, LINES).coalesce(1).write.mode("append").parquet(land)
    first = [line(1, 10), line(2, 3590), line(4, 3590, "s2"), line(6, 3000, "s3"), line(7, 20, user="bob"), line(8, 21, level="ERROR"), line(9, 60, body=SPENT)]
    second = [line(3, 3605, body=SPENT), line(5, 4500, "s2", body=SPENT), line(10, 3700), line(11, 3650, body=SPENT),  # lines come out of order
              line(12, 3601, "s3", body=SPENT), line(13, 3000, "s3", body=("  execute x", " a", " b:c"))]
    put(first)
    run()
    assert jobs.landed(spark, folder).count() == 0  # the hour is not closed
    put(second)
    run()
    put([line(99, 4 * 3600, "s9")])  # closes the hours before
    run()
    got = sorted(map(tuple, jobs.landed(spark, folder).collect()), key=str)
    want = batch_pairs(spark, first + second, 600)
    assert got == want and [r[4] for r in sorted(want, key=lambda r: r[4])] == [1, 2] and batch_pairs(spark, first + second, None) != want
    late = [line(50, 30, "s1", body=SPENT), line(51, 4 * 3600 + 1, "s9", body=SPENT), line(52, 9 * 3600, "s9")]
    put(late)  # a late line is dropped, others go on
    run()
    assert jobs.landed(spark, folder).count() == len(want) + 1
    key = "spark.sql.streaming.stateStore.providerClass"
    spark.conf.set(key, jobs.STATE_CONF[key])
    try:
        state = spark.read.format("statestore").option("stateVarName", "lines").load(os.path.join(folder, "checkpoint"))
        assert {r.key.hour - state.selectExpr("min(key.hour)").first()[0] for r in state.select("key").collect()} == {0}  # only the open hour
    finally:
        spark.conf.unset(key)


def test_a_tail_is_read_once(spark, tmp_path):
    land, folder = str(tmp_path / "land"), str(tmp_path / "run")
    put = lambda a, b: spark.range(a, b).coalesce(1).write.mode("append").parquet(land)
    read = lambda: sum(p["numInputRows"] for p in jobs.resume(spark.readStream.schema("id long").parquet(land), folder).recentProgress)
    put(0, 100)
    assert read() == 100
    put(100, 130)
    assert read() == 30 and read() == 0
    # A run that ended after writing and before committing is repeated.
    for commit in sorted(glob.glob(os.path.join(folder, "checkpoint", "commits", "*")))[-1:] + glob.glob(os.path.join(folder, "checkpoint", "commits", ".1.crc")):
        os.rename(commit, os.path.join(str(tmp_path), os.path.basename(commit)))
    put(130, 140)
    read()
    assert sorted(r.id for r in jobs.landed(spark, folder).collect()) == list(range(140))


def test_pairs_of_any_age_and_of_days_still_open(spark, tmp_path):
    land = str(tmp_path / "land")
    rows = [line(1, 10), line(2, 4000, body=SPENT), line(3, 10, "s2"), line(4, 3 * 86400, "s2", body=SPENT), line(5, 50, "s2", level="ERROR"),
            line(6, 9 * 86400, "s3"), line(7, 9 * 86400 + 1, "s3", body=SPENT), line(8, 9 * 86400 + 2, "s3", body=SPENT), line(9, 20, user="bob"),
            line(10, 5, "s4", body=SPENT), line(11, 86400, "s4", body=("  execute x", " a", " b:c")), line(12, 2 * 86400, "s4", body=SPENT)]
    for lot in (rows[6:], rows[:6]):  # the later lines land first
        spark.createDataFrame(lot, LINES).coalesce(1).write.mode("append").parquet(land)
    paired = pairing.pair_sessions(stream_of(spark, land), ["bob"], gap_seconds=None, hour_seconds=86400, delay="1 day", shards=2)
    got = sorted(map(tuple, jobs.run_available_now(paired, "pairing", read=pairing.whole_pairs).collect()), key=str)
    assert got == batch_pairs(spark, rows, None) and sorted(r[4] for r in got) == [1, 3, 6, 11]
