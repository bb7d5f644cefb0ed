"""Usage jobs (A-6 .. A-8, A-12, J-4) over an access log derived from the tables.

Access log: one row per lineitem = one query touching one dataset.
dataset = lower(p_brand), column = lower(p_type), user = o_custkey,
time = o_orderdate; ``as_of`` = newest order date (a scalar subquery).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from lakelens.operators import usage
from lakelens.plans.common import r6, sql_r6
from lakelens.plans.registry import register
from lakelens.sources.tables import read_table

WINDOWS = usage.WINDOWS


def access_log(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber")
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type")
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return (
        li.join(part, li.l_partkey == part.p_partkey)
        .join(orders, li.l_orderkey == orders.o_orderkey)
        .select(
            F.lower("p_brand").alias("dataset"),
            F.lower("p_type").alias("column_name"),
            F.col("o_custkey").alias("user_id"),
            F.col("o_orderdate").alias("ts"),
        )
    )


def as_of(spark, sf_dir):
    return read_table(spark, sf_dir, "orders").select(F.max("o_orderdate")).scalar()


ACCESS_SQL = """acc AS (
  SELECT lower(p.p_brand) AS dataset, lower(p.p_type) AS column_name, o.o_custkey AS user_id, o.o_orderdate AS ts
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey JOIN orders o ON l.l_orderkey = o.o_orderkey),
asof_t AS (SELECT max(o_orderdate) AS as_of FROM orders)"""


def _counts_sql(keys: str) -> str:
    cols = ", ".join(f"CAST(count_if(ts > as_of - INTERVAL {n} DAY) AS BIGINT) AS last_{n}d" for n in WINDOWS)
    return f"SELECT {keys}, {cols} FROM acc CROSS JOIN asof_t GROUP BY {keys}"


def _long_sql(keys: str) -> str:
    unions = " UNION ALL ".join(f"SELECT {keys}, {n} AS window_days, last_{n}d AS cnt FROM w" for n in WINDOWS)
    return unions


def _pct_sql(part: str) -> str:
    """Mean-rank percentile of ``cnt`` among positive counts within ``part``."""
    return f"""pos AS (
  SELECT DISTINCT {part}, cnt,
    (rank() OVER (PARTITION BY {part} ORDER BY cnt) - 1) AS less,
    count(*) OVER (PARTITION BY {part} ORDER BY cnt RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS le,
    count(*) OVER (PARTITION BY {part}) AS n
  FROM lng WHERE cnt > 0)"""


@register("usage_counts", f"WITH {ACCESS_SQL} {_counts_sql('dataset')}")
def usage_counts(spark, sf_dir):
    return usage.window_counts(access_log(spark, sf_dir), ["dataset"], "ts", as_of(spark, sf_dir))


@register("usage_counts_by_column", f"WITH {ACCESS_SQL} {_counts_sql('dataset, column_name')}")
def usage_counts_by_column(spark, sf_dir):
    return usage.window_counts(access_log(spark, sf_dir), ["dataset", "column_name"], "ts", as_of(spark, sf_dir))


@register("usage_counts_by_user", f"""WITH {ACCESS_SQL}, w AS ({_counts_sql('dataset, user_id')}),
lng AS ({_long_sql('dataset, user_id')})
SELECT dataset, user_id, window_days, cnt FROM lng WHERE cnt > 0""")
def usage_counts_by_user(spark, sf_dir):
    return usage.user_usage(access_log(spark, sf_dir), "dataset", "user_id", "ts", as_of(spark, sf_dir))


@register("usage_percentile_tables", f"""WITH {ACCESS_SQL}, w AS ({_counts_sql('dataset')}),
lng AS ({_long_sql('dataset')}), {_pct_sql('window_days')}
SELECT l.dataset, l.window_days, l.cnt,
  CASE WHEN l.cnt > 0 THEN {sql_r6('0.5 + (p.less - (p.n - p.le) + 1) / (2.0 * p.n)')} ELSE 0.0 END AS percentile
FROM lng l LEFT JOIN pos p ON l.window_days = p.window_days AND l.cnt = p.cnt""")
def usage_percentile_tables(spark, sf_dir):
    out = usage.table_usage(access_log(spark, sf_dir), "dataset", "ts", as_of(spark, sf_dir))
    return out.select("dataset", "window_days", "cnt", r6("percentile").alias("percentile"))


@register("usage_percentile_columns", f"""WITH {ACCESS_SQL}, w AS ({_counts_sql('dataset, column_name')}),
lng AS (SELECT * FROM ({_long_sql('dataset, column_name')}) WHERE cnt > 0), {_pct_sql('dataset, window_days')}
SELECT l.dataset, l.column_name, l.window_days, l.cnt,
  {sql_r6('0.5 + (p.less - (p.n - p.le) + 1) / (2.0 * p.n)')} AS percentile
FROM lng l JOIN pos p ON l.dataset = p.dataset AND l.window_days = p.window_days AND l.cnt = p.cnt""")
def usage_percentile_columns(spark, sf_dir):
    out = usage.column_usage(access_log(spark, sf_dir), "dataset", "column_name", "ts", as_of(spark, sf_dir))
    return out.select("dataset", "column_name", "window_days", "cnt", r6("percentile").alias("percentile"))


@register("usage_grouping_sets", f"""WITH {ACCESS_SQL}
SELECT dataset, column_name, user_id, CAST(GROUPING(dataset, column_name, user_id) AS BIGINT) AS level,
  {", ".join(f"CAST(count_if(ts > as_of - INTERVAL {n} DAY) AS BIGINT) AS last_{n}d" for n in WINDOWS)}
FROM acc CROSS JOIN asof_t
GROUP BY GROUPING SETS ((dataset), (dataset, column_name), (dataset, user_id))""")
def usage_grouping_sets(spark, sf_dir):
    out = usage.usage_grouping_sets(access_log(spark, sf_dir), "dataset", "column_name", "user_id", "ts",
                                    as_of(spark, sf_dir))
    return out.withColumn("level", F.col("level").cast("long"))


@register("history_access_join", """SELECT o.o_orderkey AS query_id, CAST(count(*) AS BIGINT) AS objects_accessed,
  CAST(sum(l.l_quantity) AS DOUBLE) AS rows_touched
FROM orders o JOIN lineitem l ON o.o_orderkey = l.l_orderkey
WHERE o.o_orderdate >= TIMESTAMP '1997-01-01' AND o.o_orderdate < TIMESTAMP '1998-01-01'
  AND l.l_shipdate >= TIMESTAMP '1997-01-01' AND l.l_shipdate < TIMESTAMP '1998-03-01'
GROUP BY o.o_orderkey""")
def history_access_join(spark, sf_dir):
    """J-4: query history joined with access history on the query id, each side
    restricted to its own time range. Both ranges are pushed into the scans."""
    orders = read_table(spark, sf_dir, "orders").filter(
        (F.col("o_orderdate") >= F.lit("1997-01-01").cast("timestamp_ntz"))
        & (F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz")))
    li = read_table(spark, sf_dir, "lineitem").filter(
        (F.col("l_shipdate") >= F.lit("1997-01-01").cast("timestamp_ntz"))
        & (F.col("l_shipdate") < F.lit("1998-03-01").cast("timestamp_ntz")))
    return (
        orders.join(li, orders.o_orderkey == li.l_orderkey)
        .groupBy(F.col("o_orderkey").alias("query_id"))
        .agg(F.count(F.lit(1)).alias("objects_accessed"), F.sum("l_quantity").cast("double").alias("rows_touched"))
    )


@register("query_count_window", """SELECT CAST(count(*) AS BIGINT) AS query_count
FROM orders o JOIN lineitem l ON o.o_orderkey = l.l_orderkey
WHERE o.o_orderdate > TIMESTAMP '1997-01-01' AND o.o_orderdate <= TIMESTAMP '1998-01-01'""")
def query_count_window(spark, sf_dir):
    """A-12: number of (query, object) rows in a (start, end] window."""
    orders = read_table(spark, sf_dir, "orders").filter(
        (F.col("o_orderdate") > F.lit("1997-01-01").cast("timestamp_ntz"))
        & (F.col("o_orderdate") <= F.lit("1998-01-01").cast("timestamp_ntz")))
    li = read_table(spark, sf_dir, "lineitem").select("l_orderkey")
    return orders.join(li, orders.o_orderkey == li.l_orderkey).agg(F.count(F.lit(1)).alias("query_count"))
