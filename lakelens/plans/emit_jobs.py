"""Emit jobs (K-1 .. K-4, K-6): events from catalog rows, conformance checks,
size-bounded batches."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakelens.functions import names
from lakelens.operators import emit
from lakelens.plans.naming import supplier_catalog
from lakelens.plans.registry import register
from lakelens.sources.tables import read_table


@register("event_union", """SELECT 'dataset' AS kind,
  'DATASET~' || upper(md5('{"name":' || to_json(lower(r.r_name || '.' || n.n_name || '.' || s.s_name)) || ',"platform":"SNOWFLAKE"}')) AS entity_id,
  '{"dataset":{"logicalId":{"name":' || to_json(lower(r.r_name || '.' || n.n_name || '.' || s.s_name)) || ',"platform":"SNOWFLAKE"},'
  || '"structure":{"database":' || to_json(r.r_name) || ',"schema":' || to_json(n.n_name) || ',"table":' || to_json(s.s_name) || '}'
  || CASE WHEN s.s_suppkey % 2 = 0 THEN ',"description":' || to_json('supplier ' || CAST(s.s_suppkey AS VARCHAR)) ELSE '' END
  || ',"tags":[' || CASE WHEN s.s_suppkey % 3 = 0 THEN '"pii"' ELSE '' END || ']}}' AS event
FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey
UNION ALL
SELECT 'person', 'PERSON~' || upper(md5('{"email":' || to_json(lower(c_name) || '@example.com') || '}')),
  '{"person":{"logicalId":{"email":' || to_json(lower(c_name) || '@example.com') || '}}}'
FROM customer""")
def event_union(spark, sf_dir):
    """K-1 / K-2 / U-5: entities of two kinds as one event table; null fields
    are left out of the JSON, empty lists kept."""
    c = supplier_catalog(spark, sf_dir)
    name = names.dotted_name("db", "schema", "tbl")
    ds = c.select(
        names.dataset_id(name, F.lit("SNOWFLAKE")).alias("entity_id"),
        F.struct(
            F.struct(name.alias("name"), F.lit("SNOWFLAKE").alias("platform")).alias("logicalId"),
            F.struct(F.col("db").alias("database"), F.col("schema").alias("schema"), F.col("tbl").alias("table")).alias("structure"),
            F.when(F.col("s_suppkey") % 2 == 0, F.concat(F.lit("supplier "), F.col("s_suppkey").cast("string"))).alias("description"),
            emit.drop_null_items(F.array(F.when(F.col("s_suppkey") % 3 == 0, F.lit("pii")))).alias("tags"),
        ).alias("entity"))
    cu = read_table(spark, sf_dir, "customer")
    email = F.concat(F.lower("c_name"), F.lit("@example.com"))
    people = cu.select(names.person_id(email).alias("entity_id"),
                       F.struct(F.struct(email.alias("email")).alias("logicalId")).alias("entity"))
    return emit.union_events({"dataset": ds, "person": people})


def rules():
    """Named rules (built when a job runs: Columns need an active session)."""
    return {
        "positive_price": F.col("o_totalprice") > 0,
        "known_status": F.col("o_orderstatus").isin("F", "O"),
        "priority_format": F.col("o_orderpriority").rlike(r"^[1-5]-"),
        "not_future": F.col("o_orderdate") < F.lit("2001-06-01").cast("timestamp_ntz"),
    }


@register("conformance", """SELECT o_orderkey,
  concat_ws(',', CASE WHEN NOT coalesce(o_totalprice > 0, FALSE) THEN 'positive_price' END,
                 CASE WHEN NOT coalesce(o_orderstatus IN ('F', 'O'), FALSE) THEN 'known_status' END,
                 CASE WHEN NOT coalesce(regexp_matches(o_orderpriority, '^[1-5]-'), FALSE) THEN 'priority_format' END,
                 CASE WHEN NOT coalesce(o_orderdate < TIMESTAMP '2001-06-01', FALSE) THEN 'not_future' END) AS failed_rules,
  coalesce(o_totalprice > 0, FALSE) AND coalesce(o_orderstatus IN ('F', 'O'), FALSE)
    AND coalesce(regexp_matches(o_orderpriority, '^[1-5]-'), FALSE) AND coalesce(o_orderdate < TIMESTAMP '2001-06-01', FALSE) AS valid
FROM orders""")
def conformance(spark, sf_dir):
    """K-3: rows split into valid / quarantined by named rules (failed names listed)."""
    out, _ = emit.check(read_table(spark, sf_dir, "orders"), rules())
    return out.select("o_orderkey", F.array_join("failed_rules", ",").alias("failed_rules"), "valid")


def cuts_sql(rows: str, most: int, limit: int, reach: bool = False) -> str:
    """The law of the cuts in SQL: (id, size, i, no, start) of ``rows`` (id, size). A group
    begins at the first row that its predecessor cannot take; the recursion takes a
    step per group."""
    over = "x.upto - x.size - g.before >= " if reach else "x.upto - g.before > "
    return f"""RECURSIVE x AS (SELECT id, size, row_number() OVER w - 1 AS i, CAST(sum(size) OVER (w ROWS UNBOUNDED PRECEDING) AS BIGINT) AS upto
  FROM ({rows}) WINDOW w AS (ORDER BY id, size)),
g(no, start, before) AS (SELECT CAST(0 AS BIGINT), CAST(0 AS BIGINT), CAST(0 AS BIGINT) UNION ALL
  SELECT g.no + 1, n.i, n.before FROM g, LATERAL (SELECT min(x.i) AS i, CAST(min(x.upto - x.size) AS BIGINT) AS before FROM x
    WHERE x.i > g.start AND (x.i >= g.start + {most} OR {over}{limit})) n WHERE n.i IS NOT NULL),
cuts AS (SELECT x.id, x.size, x.i, g.no, g.start FROM x ASOF JOIN g ON x.i >= g.start)"""


# The length of a JSON text of four columns.
_ORDER_JSON = """length('{"o_orderkey":' || CAST(o_orderkey AS VARCHAR) || ',"o_custkey":' || CAST(o_custkey AS VARCHAR)
  || ',"o_orderstatus":"' || o_orderstatus || '","o_orderpriority":"' || o_orderpriority || '"}')"""


@register("batches", f"""WITH {cuts_sql(f"SELECT o_orderkey AS id, {_ORDER_JSON} AS size FROM orders", 200, 15_000)}
SELECT id AS o_orderkey, CAST(no AS INTEGER) AS batch, CAST(size AS INTEGER) AS size FROM cuts""")
def batches(spark, sf_dir):
    """K-4: orders as events packed into batches of at most 200 events and
    15 000 bytes of JSON, in order over the whole table."""
    o = read_table(spark, sf_dir, "orders")
    ev = o.select("o_orderkey", F.length(F.to_json(F.struct("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"))).alias("size"))
    return emit.pack(ev, "o_orderkey", "size", 200, 15_000).select("o_orderkey", "batch", "size")


_LOG_ROWS = """SELECT CAST(l_orderkey AS BIGINT) * 10 + l_linenumber AS id, length('{"l_orderkey":' || CAST(l_orderkey AS VARCHAR)
  || ',"l_linenumber":' || CAST(l_linenumber AS VARCHAR) || ',"l_partkey":' || CAST(l_partkey AS VARCHAR) || ',"l_returnflag":"' || l_returnflag || '"}') AS size
  FROM lineitem"""


@register("query_log_batches", f"""WITH {cuts_sql(_LOG_ROWS, 20 * 200, 200_000, reach=True)},
files AS (SELECT no, count(*) AS n FROM cuts GROUP BY no),
bases AS (SELECT no, coalesce(sum((n + 19) // 20) OVER (ORDER BY no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS base FROM files)
SELECT id AS log_seq, CAST(base + (i - start) // 20 AS INTEGER) AS event_no, CAST(no AS INTEGER) AS file_no FROM cuts JOIN bases USING (no)""")
def query_log_batches(spark, sf_dir):
    """K-6: query logs (one per line item) into events of 20 logs and files
    of 200 events or 200 000 bytes, in order over the whole table."""
    li = read_table(spark, sf_dir, "lineitem")
    logs = li.select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("log_seq"),
                     F.length(F.to_json(F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_returnflag"))).alias("size"))
    return emit.query_log_batches(logs, "log_seq", "size", 20, 200, 200_000).select("log_seq", "event_no", "file_no")
