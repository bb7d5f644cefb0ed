"""Skew-safe operators agree with their single-window forms."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from lakelens.operators import logs


def test_lag_within_matches_plain_lag(spark):
    # One hot session (key 0) with 5000 lines over ~14 hours, plus small ones.
    df = spark.range(6000).select(
        F.when(F.col("id") < 5000, F.lit(0)).otherwise(F.col("id") % 7 + 1).alias("session"),
        (F.lit("2024-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.col("id") * 10))
        .alias("ts"),
        F.col("id").alias("seq"))
    got = logs.lag_within(df, "session", "ts", "seq", F.col("seq"), bucket_seconds=300)
    want = df.withColumn("want", F.lag("seq").over(Window.partitionBy("session").orderBy("ts", "seq")))
    bad = got.join(want, ["session", "ts", "seq"]).filter(~F.col("prev").eqNullSafe(F.col("want"))).count()
    assert bad == 0 and got.count() == 6000


def test_top_n_salted_matches_window(spark):
    df = spark.range(20000).select((F.col("id") % 3).alias("k"), ((F.col("id") * 7919) % 10007).alias("v"))
    got = logs.top_n_per_key(df, ["k"], [F.col("v").desc()], 5, salts=32)
    want = df.withColumn("r", F.row_number().over(Window.partitionBy("k").orderBy(F.col("v").desc()))).filter("r <= 5")
    assert sorted((r.k, r.v) for r in got.collect()) == sorted((r.k, r.v) for r in want.collect())


def test_last_per_key_matches_window(spark):
    df = spark.range(5000).select((F.col("id") % 4).alias("k"), F.col("id").alias("seq"), (F.col("id") * 3).alias("val"))
    got = {r.k: (r.seq, r.val, r.first) for r in logs.last_per_key(df, ["k"], "seq", first_col="first").collect()}
    assert got == {k: (4996 + k, (4996 + k) * 3, k) for k in range(4)}
