"""Usage counts and popularity percentiles (A-6 .. A-8, W-2).

Counts: one ``groupBy`` with a ``count_if`` per look-back window (strict ``>``
``as_of - n days``). Partial aggregation combines map-side, so a dataset that
holds a third of all log rows costs one partial row per task, not a hot shuffle.

Percentile (mean rank) of a positive count ``c`` among ``n`` positive counts:
``0.5 + (less(c) - greater(c) + 1) / (2 n)``; zero counts get 0. It needs a
prefix sum over the sorted distinct counts. We never sort all rows in one task:
  1. histogram the counts (``groupBy(count)``; distinct counts only),
  2. cut the count axis into fixed log-scale buckets (``floor(16*log2(c))``,
     monotone, at most a few thousand buckets whatever the data),
  3. prefix-sum bucket totals (a window over that bounded bucket table),
  4. prefix-sum inside each bucket (a window partitioned by bucket),
  5. join the per-count percentile back.
Within-table column percentiles partition by the table instead.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakelens.functions.scalars import col_of

WINDOWS = (1, 7, 30, 90, 365)


def window_counts(access: DataFrame, keys: Sequence[str], ts: str, as_of: Column,
                  windows: Sequence[int] = WINDOWS) -> DataFrame:
    """A-6/A-7: per key, number of log rows with ``ts > as_of - n days`` for each n."""
    t = F.col(ts)
    aggs = [
        F.count_if(t > (as_of - F.make_dt_interval(F.lit(n)))).cast("long").alias(f"last_{n}d")
        for n in windows
    ]
    return access.groupBy(*keys).agg(*aggs)


def to_long(counts: DataFrame, keys: Sequence[str], windows: Sequence[int] = WINDOWS) -> DataFrame:
    """Wide window counts -> (keys..., window_days, cnt)."""
    stack = F.inline(F.array(*[
        F.struct(F.lit(n).alias("window_days"), F.col(f"last_{n}d").alias("cnt")) for n in windows
    ]))
    return counts.select(*keys, stack)


def mean_rank_percentile(df: DataFrame, value: str, by: Sequence[str] = (), out: str = "percentile") -> DataFrame:
    """A-8 / W-2: add ``out`` = mean-rank percentile of ``value`` within ``by``
    (global when empty)."""
    by = list(by)
    v = F.col(value)
    hist = df.filter(v > 0).groupBy(*by, value).agg(F.count(F.lit(1)).alias("__h"))
    if by:
        w = Window.partitionBy(*by).orderBy(value)
        scored = (
            hist.withColumn("__le", F.sum("__h").over(w.rowsBetween(Window.unboundedPreceding, 0)))
            .withColumn("__n", F.sum("__h").over(Window.partitionBy(*by)))
        )
    else:
        scored = _global_prefix(hist, value)
    pct = F.lit(0.5) + ((F.col("__le") - F.col("__h")) - (F.col("__n") - F.col("__le")) + 1) / (2.0 * F.col("__n"))
    scored = scored.select(*by, value, pct.alias(out))
    return (
        df.join(scored, on=[*by, value], how="left")
        .withColumn(out, F.when(F.col(value) > 0, F.col(out)).otherwise(F.lit(0.0)))
    )


def _global_prefix(hist: DataFrame, value: str) -> DataFrame:
    bucket = F.floor(F.log2(F.col(value).cast("double")) * 16).cast("long")
    hb = hist.withColumn("__b", bucket)
    # Bounded table: one row per log-scale bucket.
    totals = hb.groupBy("__b").agg(F.sum("__h").alias("__bt"))
    all_rows = Window.orderBy("__b").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = Window.orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        "__b",
        F.coalesce(F.sum("__bt").over(before), F.lit(0)).alias("__off"),
        F.sum("__bt").over(all_rows).alias("__n"),
    )
    w = Window.partitionBy("__b").orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    return (
        hb.join(F.broadcast(offsets), "__b")
        .withColumn("__le", F.col("__off") + F.sum("__h").over(w))
    )


def table_usage(access: DataFrame, dataset: str, ts: str, as_of: Column,
                windows: Sequence[int] = WINDOWS) -> DataFrame:
    """Per dataset and window: count and table percentile (zero -> 0)."""
    counts = to_long(window_counts(access, [dataset], ts, as_of, windows), [dataset], windows)
    # Percentiles are ranked separately per window: the window is a key of the
    # histogram, the ranking is global within it.
    return mean_rank_percentile_grouped(counts, "cnt", group="window_days")


def mean_rank_percentile_grouped(df: DataFrame, value: str, group: str, out: str = "percentile") -> DataFrame:
    """A-8 / W-2: global-per-group percentile where ``group`` has few values (e.g. the five
    windows): buckets are keyed by (group, log bucket)."""
    v = F.col(value)
    hist = df.filter(v > 0).groupBy(group, value).agg(F.count(F.lit(1)).alias("__h"))
    hb = hist.withColumn("__b", F.floor(F.log2(v.cast("double")) * 16).cast("long"))
    totals = hb.groupBy(group, "__b").agg(F.sum("__h").alias("__bt"))
    before = Window.partitionBy(group).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        group, "__b",
        F.coalesce(F.sum("__bt").over(before), F.lit(0)).alias("__off"),
        F.sum("__bt").over(Window.partitionBy(group)).alias("__n"),
    )
    w = Window.partitionBy(group, "__b").orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    scored = (
        hb.join(F.broadcast(offsets), [group, "__b"])
        .withColumn("__le", F.col("__off") + F.sum("__h").over(w))
    )
    pct = F.lit(0.5) + ((F.col("__le") - F.col("__h")) - (F.col("__n") - F.col("__le")) + 1) / (2.0 * F.col("__n"))
    scored = scored.select(group, value, pct.alias(out))
    return (
        df.join(scored, on=[group, value], how="left")
        .withColumn(out, F.when(v > 0, F.col(out)).otherwise(F.lit(0.0)))
    )


def column_usage(access: DataFrame, dataset: str, column: str, ts: str, as_of: Column,
                 windows: Sequence[int] = WINDOWS) -> DataFrame:
    """Per (dataset, column, window) with count > 0, and the column percentile
    within its dataset and window."""
    counts = to_long(window_counts(access, [dataset, column], ts, as_of, windows), [dataset, column], windows)
    counts = counts.filter(F.col("cnt") > 0)
    return mean_rank_percentile(counts, "cnt", by=[dataset, "window_days"])


def user_usage(access: DataFrame, dataset: str, user: str, ts: str, as_of: Column,
               windows: Sequence[int] = WINDOWS) -> DataFrame:
    """Per (dataset, user, window) with count > 0 (users get no percentile)."""
    counts = to_long(window_counts(access, [dataset, user], ts, as_of, windows), [dataset, user], windows)
    return counts.filter(F.col("cnt") > 0)


def usage_grouping_sets(access: DataFrame, dataset: str, column: str, user: str, ts: str, as_of: Column,
                        windows: Sequence[int] = WINDOWS) -> DataFrame:
    """A-6 + A-7 in one pass over the log: GROUPING SETS ((d), (d, column), (d, user)).
    ``level`` is grouping_id(): 1 = per column, 2 = per user, 3 = per dataset."""
    t = F.col(ts)
    aggs = [
        F.count_if(t > (as_of - F.make_dt_interval(F.lit(n)))).cast("long").alias(f"last_{n}d")
        for n in windows
    ]
    d, c, u = F.col(dataset), F.col(column), F.col(user)
    return (
        access.groupingSets([[d], [d, c], [d, u]], d, c, u)
        .agg(F.grouping_id().alias("level"), *aggs)
    )
