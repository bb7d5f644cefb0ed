"""Profile jobs (A-1 .. A-4) on the landed tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakelens.operators.profile import ProfileSwitches, Sampling, apply_sampling, profile
from lakelens.plans.common import round_doubles, sql_r6
from lakelens.plans.registry import register
from lakelens.sources.tables import read_table

LINEITEM_COLS = [
    ("l_orderkey", True), ("l_partkey", True), ("l_suppkey", True), ("l_linenumber", True),
    ("l_quantity", True), ("l_extendedprice", True), ("l_discount", True), ("l_tax", True),
    ("l_returnflag", False), ("l_linestatus", False), ("l_shipdate", False),
]
CUSTOMER_COLS = [
    ("c_custkey", True), ("c_name", False), ("c_nationkey", True), ("c_acctbal", True), ("c_mktsegment", False),
]
OUT = ["field_path", "row_count", "distinct_value_count", "null_value_count", "nonnull_value_count",
       "min_value", "max_value", "average", "std_dev"]


def profile_sql(source: str, cols: list[tuple[str, bool]], switches: ProfileSwitches = ProfileSwitches()) -> str:
    parts = []
    for name, numeric in cols:
        def num(agg: str, on: bool) -> str:
            return sql_r6(f"{agg}({name})") if numeric and on else "CAST(NULL AS DOUBLE)"
        dist = f"CAST(count(DISTINCT {name}) AS DOUBLE)" if switches.unique_count else "CAST(NULL AS DOUBLE)"
        nulls = f"CAST(count(*) - count({name}) AS DOUBLE)" if switches.null_count else "CAST(NULL AS DOUBLE)"
        nonnull = f"CAST(count({name}) AS DOUBLE)" if switches.null_count else "CAST(NULL AS DOUBLE)"
        parts.append(
            f"SELECT '{name}' AS field_path, CAST(count(*) AS DOUBLE) AS row_count, {dist} AS distinct_value_count, "
            f"{nulls} AS null_value_count, {nonnull} AS nonnull_value_count, "
            f"{num('min', switches.min_value)} AS min_value, {num('max', switches.max_value)} AS max_value, "
            f"{num('avg', switches.avg_value)} AS average, {num('stddev_samp', switches.std_dev)} AS std_dev "
            f"FROM {source}"
        )
    return "\nUNION ALL\n".join(parts)


def _profile_job(table: str, sampling: Sampling | None = None, switches: ProfileSwitches = ProfileSwitches(),
                 distinct: str = "exact"):
    def job(spark, sf_dir):
        df = read_table(spark, sf_dir, table)
        df, _ = apply_sampling(df, sampling)
        return round_doubles(profile(df, switches, distinct=distinct).select(*OUT))
    return job


register("profile_lineitem", profile_sql("lineitem", LINEITEM_COLS))(_profile_job("lineitem"))
register("profile_customer", profile_sql("customer", CUSTOMER_COLS))(_profile_job("customer"))

_SAMPLING = Sampling(percentage=10, key="l_orderkey")
register(
    "profile_sampled_hash",
    profile_sql("(SELECT * FROM lineitem WHERE l_orderkey % 100 < 10) AS s", LINEITEM_COLS),
)(_profile_job("lineitem", _SAMPLING))

_PARTIAL = ProfileSwitches(unique_count=False, std_dev=False)
register("profile_switches", profile_sql("orders", [
    ("o_orderkey", True), ("o_custkey", True), ("o_orderstatus", False), ("o_totalprice", True),
    ("o_orderdate", False), ("o_orderpriority", False),
], _PARTIAL))(_profile_job("orders", switches=_PARTIAL))


@register("profile_wide_sliced", profile_sql("lineitem", LINEITEM_COLS))
def profile_wide_sliced(spark, sf_dir):
    """A-4: the same profile computed in slices of at most 20 aggregate expressions."""
    df = read_table(spark, sf_dir, "lineitem")
    return round_doubles(profile(df, max_exprs=20).select(*OUT))


@register("profile_approx_distinct")
def profile_approx_distinct(spark, sf_dir):
    """HLL++ distinct counts (no value shuffle); rows-only check (approximate)."""
    df = read_table(spark, sf_dir, "lineitem")
    return round_doubles(profile(df, distinct="approx").select(*OUT))


@register("table_row_count", "SELECT CAST(count(*) AS BIGINT) AS row_count FROM events")
def table_row_count(spark, sf_dir):
    """A-18: relation row count."""
    return read_table(spark, sf_dir, "events").agg(F.count(F.lit(1)).alias("row_count"))
