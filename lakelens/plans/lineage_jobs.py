"""Lineage and graph jobs (A-9, A-10, A-16, U-6, J-9, G-1, G-2, G-3, G-4, G-5, G-6, G-13, J-24)."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakelens.operators import graph, lineage, logs
from lakelens.plans.log_jobs import audit_log
from lakelens.plans.naming import supplier_catalog
from lakelens.plans.registry import register
from lakelens.sources.tables import read_table


def _edges(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem")
    return li.select(
        F.concat(F.lit("DB.SCH.PART_"), (F.col("l_partkey") % 40).cast("string")).alias("src"),
        F.concat(F.lit("DB.SCH.SUPPLIER_"), F.col("l_suppkey").cast("string")).alias("dst"),
        F.concat(F.lit("C"), F.col("l_linenumber").cast("string")).alias("src_col"),
        F.concat(F.lit("Q"), (F.col("l_quantity") % 5).cast("int").cast("string")).alias("dst_col"),
        F.col("l_shipdate").alias("ts"),
    )


@register("lineage_tables", """SELECT DISTINCT lower('DB.SCH.PART_' || CAST(l_partkey % 40 AS VARCHAR)) AS source_table,
  lower('DB.SCH.SUPPLIER_' || CAST(l_suppkey AS VARCHAR)) AS target_table
FROM lineitem WHERE l_shipdate >= TIMESTAMP '1997-01-01' AND l_shipdate < TIMESTAMP '1999-01-01'""")
def lineage_tables(spark, sf_dir):
    """A-9: distinct table edges inside the look-back window (long form)."""
    e = _edges(spark, sf_dir)
    return lineage.table_edges(e, "src", "dst", "ts", F.lit("1997-01-01").cast("timestamp_ntz"),
                               F.lit("1999-01-01").cast("timestamp_ntz"))


@register("lineage_fan_in", """SELECT target_table, CAST(count(*) AS BIGINT) AS n_sources, min(source_table) AS first_source FROM (
  SELECT DISTINCT lower('DB.SCH.PART_' || CAST(l_partkey % 40 AS VARCHAR)) AS source_table,
    lower('DB.SCH.SUPPLIER_' || CAST(l_suppkey AS VARCHAR)) AS target_table
  FROM lineitem WHERE l_shipdate >= TIMESTAMP '1997-01-01' AND l_shipdate < TIMESTAMP '1999-01-01') GROUP BY target_table""")
def lineage_fan_in(spark, sf_dir):
    """A-16 (aggregated form): number of distinct upstreams per target."""
    e = lineage_tables(spark, sf_dir)
    return e.groupBy("target_table").agg(F.count(F.lit(1)).alias("n_sources"), F.min("source_table").alias("first_source"))


@register("lineage_columns", """SELECT DISTINCT lower('DB.SCH.SUPPLIER_' || CAST(l_suppkey AS VARCHAR)) AS target_table,
  lower('Q' || CAST(CAST(l_quantity % 5 AS INTEGER) AS VARCHAR)) AS target_column,
  lower('DB.SCH.PART_' || CAST(l_partkey % 40 AS VARCHAR)) AS source_table, lower('C' || CAST(l_linenumber AS VARCHAR)) AS source_column
FROM lineitem""")
def lineage_columns(spark, sf_dir):
    """A-10: distinct column-level edges."""
    return lineage.column_edges(_edges(spark, sf_dir), "src", "src_col", "dst", "dst_col")


@register("lineage_no_self", """SELECT DISTINCT 'tbl_' || CAST(l_partkey % 10 AS VARCHAR) AS source_table, 'tbl_' || CAST(l_suppkey % 10 AS VARCHAR) AS target_table
FROM lineitem WHERE l_partkey % 10 <> l_suppkey % 10""")
def lineage_no_self(spark, sf_dir):
    """U-6: self edges removed."""
    li = read_table(spark, sf_dir, "lineitem")
    e = li.select(F.concat(F.lit("tbl_"), (F.col("l_partkey") % 10).cast("string")).alias("s"),
                  F.concat(F.lit("tbl_"), (F.col("l_suppkey") % 10).cast("string")).alias("d"))
    return lineage.drop_self(lineage.table_edges(e, "s", "d"))


def _dataset_keys(spark, sf_dir):
    c = supplier_catalog(spark, sf_dir).select(F.lower(F.concat_ws(".", "db", "schema", "tbl")).alias("key"))
    p = read_table(spark, sf_dir, "part").select(F.lower(F.concat_ws(
        ".", "p_type", "p_brand", F.replace(F.col("p_name"), F.lit(" "), F.lit("_")))).alias("key"))
    return c.unionByName(p).distinct()


def _partials(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    p = read_table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_name")
    k = F.col("l_linenumber") % 3
    name = (F.when(k == 0, F.lower(F.concat(F.col("p_brand"), F.lit("."), F.replace(F.col("p_name"), F.lit(" "), F.lit("_")))))
            .when(k == 1, F.replace(F.col("p_name"), F.lit(" "), F.lit("_")))
            .otherwise(F.concat(F.lit("supplier#"), F.lpad(F.col("l_suppkey").cast("string"), 9, "0"))))
    return li.join(p, li.l_partkey == p.p_partkey).select("l_orderkey", "l_linenumber", name.alias("name"))


@register("suffix_resolve", """WITH keys AS (
  SELECT DISTINCT key FROM (
    SELECT lower(concat_ws('.', r.r_name, n.n_name, s.s_name)) AS key
    FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey
    UNION ALL SELECT lower(concat_ws('.', p_type, p_brand, replace(p_name, ' ', '_'))) FROM part)),
partials AS (
  SELECT l.l_orderkey, l.l_linenumber,
    CASE l.l_linenumber % 3 WHEN 0 THEN lower(p.p_brand || '.' || replace(p.p_name, ' ', '_'))
                            WHEN 1 THEN replace(p.p_name, ' ', '_')
                            ELSE 'supplier#' || lpad(CAST(l.l_suppkey AS VARCHAR), 9, '0') END AS name
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey),
res AS (SELECT d.name, CASE WHEN count(k.key) = 1 THEN min(k.key) END AS resolved
        FROM (SELECT DISTINCT name FROM partials) d LEFT JOIN keys k ON ends_with(k.key, d.name) GROUP BY d.name)
SELECT p.l_orderkey, p.l_linenumber, p.name, r.resolved FROM partials p JOIN res r ON p.name = r.name""")
def suffix_resolve(spark, sf_dir):
    """J-9: partially qualified names resolved to the only key ending with them."""
    return lineage.resolve_suffix(_partials(spark, sf_dir), _dataset_keys(spark, sf_dir))


@register("audit_lineage", """WITH refs AS (
  SELECT l_orderkey, 'p.d' || CAST(l_suppkey % 3 AS VARCHAR) || '.part' || CAST(l_partkey % 20 AS VARCHAR) AS src
  FROM lineitem WHERE l_linenumber <> 3),
jobs AS (
  SELECT o_orderkey, 'p.sales.orders_p' || o_orderpriority[1:1] AS destination, o_orderdate + INTERVAL 90 MINUTE AS end_time,
    'projects/p/jobs/' || CAST(o_orderkey AS VARCHAR) AS job_name
  FROM orders WHERE o_orderkey % 17 <> 0 AND o_orderstatus <> 'P' AND o_orderkey % 5 <> 1 AND o_custkey % 4 <> 0),
latest AS (SELECT destination, arg_max(o_orderkey, (end_time, job_name)) AS o_orderkey FROM jobs GROUP BY destination)
SELECT DISTINCT l.destination AS target_table, r.src AS source_table
FROM latest l JOIN refs r ON l.o_orderkey = r.l_orderkey""")
def audit_lineage(spark, sf_dir):
    """G-6: destination <- sources of the latest finished job writing it."""
    jobs = logs.audit_jobs(audit_log(spark, sf_dir))
    jobs = jobs.withColumn("__order", F.struct("end_time", "job_name"))
    return lineage.last_job_edges(jobs, "destination", "sources", "__order").distinct()


# ---------------------------------------------------------------- graphs

def _folders(spark, sf_dir):
    p = read_table(spark, sf_dir, "part").select("p_partkey")
    k = F.col("p_partkey")
    parent = F.when(k == 0, F.lit(None).cast("long")).when(k % 97 == 0, k + 1000000).otherwise(F.floor(k / 2).cast("long"))
    return p.select(k.alias("id"), parent.alias("parent_id"))


FOLDERS_SQL = """n AS (SELECT p_partkey AS id, CASE WHEN p_partkey = 0 THEN NULL WHEN p_partkey % 97 = 0 THEN p_partkey + 1000000
                                  ELSE p_partkey // 2 END AS parent_id FROM part),
walk(node, anc, dist, nxt) AS (
  SELECT id, id, 0, parent_id FROM n
  UNION ALL SELECT w.node, n.id, w.dist + 1, n.parent_id FROM walk w JOIN n ON n.id = w.nxt),
broken AS (SELECT DISTINCT w.node FROM walk w WHERE w.nxt IS NOT NULL AND w.nxt NOT IN (SELECT id FROM n))"""


@register("folder_paths", f"""WITH RECURSIVE {FOLDERS_SQL}
SELECT node, CASE WHEN node IN (SELECT node FROM broken) THEN '' ELSE string_agg(CAST(anc AS VARCHAR), '/' ORDER BY dist DESC) END AS path,
  CASE WHEN node IN (SELECT node FROM broken) THEN 0 ELSE CAST(count(*) AS BIGINT) END AS n_parts
FROM walk GROUP BY node""")
def folder_paths(spark, sf_dir):
    """G-1: root-first ancestor path per folder; empty when the chain is broken."""
    out = graph.ancestor_paths(_folders(spark, sf_dir))
    return out.select("node", F.array_join("path", "/").alias("path"), F.size("path").cast("long").alias("n_parts"))


@register("impact_closure", f"""WITH RECURSIVE {FOLDERS_SQL}
SELECT anc AS node, CAST(count(*) AS BIGINT) AS descendants FROM walk
WHERE dist > 0 AND node NOT IN (SELECT node FROM broken) GROUP BY anc""")
def impact_closure(spark, sf_dir):
    """G-13: number of descendants of every folder, without making the pairs."""
    return graph.descendant_counts(_folders(spark, sf_dir))


@register("reachable", """WITH RECURSIVE e AS (SELECT p_partkey // 2 AS src, p_partkey AS dst FROM part WHERE p_partkey > 0),
r(node, hop) AS (SELECT p_partkey, 0 FROM part WHERE p_size > 45
  UNION ALL SELECT e.dst, r.hop + 1 FROM r JOIN e ON e.src = r.node)
SELECT node, CAST(min(hop) AS INTEGER) AS hop FROM r GROUP BY node""")
def reachable(spark, sf_dir):
    """G-3: everything reachable from the kept seeds (with the first hop)."""
    p = read_table(spark, sf_dir, "part")
    seeds = p.filter(F.col("p_size") > 45).select("p_partkey")
    edges = p.filter(F.col("p_partkey") > 0).select(F.floor(F.col("p_partkey") / 2).cast("long").alias("src"),
                                                     F.col("p_partkey").alias("dst"))
    return graph.reachable(seeds, edges).select("node", F.col("hop").cast("int").alias("hop"))


@register("node_lineage", """WITH n AS (SELECT 'model.p' || CAST(p_partkey AS VARCHAR) AS node,
    [CASE WHEN p_partkey > 0 THEN 'model.p' || CAST(p_partkey // 2 AS VARCHAR) END, 'source.s' || CAST(p_partkey % 10 AS VARCHAR),
     'macro.m' || CAST(p_partkey % 3 AS VARCHAR), CASE WHEN p_size > 40 THEN 'snapshot.snap' || CAST(p_size AS VARCHAR) END] AS deps
  FROM part)
SELECT node, parent, split_part(parent, '.', 1) AS parent_kind
FROM (SELECT node, unnest(deps) AS parent FROM n)
WHERE parent IS NOT NULL AND split_part(parent, '.', 1) IN ('model', 'source', 'snapshot')""")
def node_lineage(spark, sf_dir):
    """G-4 / N-9: artifact nodes -> parent edges, split by id prefix (macros dropped)."""
    p = read_table(spark, sf_dir, "part")
    deps = F.array(
        F.when(F.col("p_partkey") > 0, F.concat(F.lit("model.p"), F.floor(F.col("p_partkey") / 2).cast("string"))),
        F.concat(F.lit("source.s"), (F.col("p_partkey") % 10).cast("string")),
        F.concat(F.lit("macro.m"), (F.col("p_partkey") % 3).cast("string")),
        F.when(F.col("p_size") > 40, F.concat(F.lit("snapshot.snap"), F.col("p_size").cast("string"))),
    )
    n = p.select(F.concat(F.lit("model.p"), F.col("p_partkey").cast("string")).alias("node"), deps.alias("deps"))
    kept = F.filter("deps", lambda d: d.startswith("model.") | d.startswith("source.") | d.startswith("snapshot."))
    return n.select("node", F.explode(kept).alias("parent")).select(
        "node", "parent", F.split("parent", r"\.")[0].alias("parent_kind"))


@register("virtual_sources", """WITH e AS (SELECT DISTINCT 'src_' || CAST(l_partkey AS VARCHAR) AS source_table,
    'supplier_' || CAST(l_suppkey AS VARCHAR) AS target_table FROM lineitem),
k AS (SELECT DISTINCT 'src_' || CAST(p_partkey AS VARCHAR) AS key FROM part WHERE p_size <= 30)
SELECT e.source_table, e.target_table, k.key IS NULL AS is_virtual FROM e LEFT JOIN k ON e.source_table = k.key""")
def virtual_sources(spark, sf_dir):
    """G-5: pipeline edges whose source is unknown are marked virtual."""
    li = read_table(spark, sf_dir, "lineitem")
    e = lineage.table_edges(li.select(F.concat(F.lit("src_"), F.col("l_partkey").cast("string")).alias("s"),
                                      F.concat(F.lit("supplier_"), F.col("l_suppkey").cast("string")).alias("d")), "s", "d")
    known = read_table(spark, sf_dir, "part").filter(F.col("p_size") <= 30).select(
        F.concat(F.lit("src_"), F.col("p_partkey").cast("string")).alias("key"))
    return lineage.with_virtual_source(e, known)


@register("placeholder_datasets", """SELECT DISTINCT 'src_' || CAST(l_partkey AS VARCHAR) AS key FROM lineitem
WHERE 'src_' || CAST(l_partkey AS VARCHAR) NOT IN (SELECT 'src_' || CAST(p_partkey AS VARCHAR) FROM part WHERE p_size <= 30)""")
def placeholder_datasets(spark, sf_dir):
    """J-24: upstreams not listed anywhere get placeholder rows (anti join)."""
    li = read_table(spark, sf_dir, "lineitem")
    ups = li.select(F.concat(F.lit("src_"), F.col("l_partkey").cast("string")).alias("source_table"))
    listed = read_table(spark, sf_dir, "part").filter(F.col("p_size") <= 30).select(
        F.concat(F.lit("src_"), F.col("p_partkey").cast("string")).alias("key"))
    return lineage.placeholders(ups, listed)


def _transform_edges(spark, sf_dir):
    """Column edges of a two-level transformation DAG built from ``part``:
    logical L1 tables rename / project physical columns (and create columns
    from two inputs), logical L2 tables rename L1 columns."""
    p = read_table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    s = lambda *x: F.concat(*[F.lit(v) if isinstance(v, str) else v.cast("string") for v in x])
    l1 = p.select(s("l1_", k % 20, ".x", k % 7).alias("dst"), s("phys", k % 10, ".c", k % 5).alias("src"))
    calc = p.filter(k % 4 == 0).select(s("l1_", k % 20, ".calc", k % 3).alias("dst"),
                                       F.explode(F.array(s("phys", k % 10, ".c", k % 5), s("phys", k % 9, ".c", k % 4))).alias("src"))
    l2 = p.select(s("l2_", k % 10, ".y", k % 6).alias("dst"), s("l1_", k % 20, ".x", k % 7).alias("src"))
    l2c = p.filter(k % 4 == 0).select(s("l2_", k % 10, ".z", k % 3).alias("dst"), s("l1_", k % 20, ".calc", k % 3).alias("src"))
    return l1.unionByName(calc).unionByName(l2).unionByName(l2c)


@register("transform_column_lineage", """WITH RECURSIVE e AS (
  SELECT DISTINCT dst, src FROM (
    SELECT 'l1_' || CAST(p_partkey % 20 AS VARCHAR) || '.x' || CAST(p_partkey % 7 AS VARCHAR) AS dst,
           'phys' || CAST(p_partkey % 10 AS VARCHAR) || '.c' || CAST(p_partkey % 5 AS VARCHAR) AS src FROM part
    UNION ALL SELECT 'l1_' || CAST(p_partkey % 20 AS VARCHAR) || '.calc' || CAST(p_partkey % 3 AS VARCHAR),
           'phys' || CAST(p_partkey % 10 AS VARCHAR) || '.c' || CAST(p_partkey % 5 AS VARCHAR) FROM part WHERE p_partkey % 4 = 0
    UNION ALL SELECT 'l1_' || CAST(p_partkey % 20 AS VARCHAR) || '.calc' || CAST(p_partkey % 3 AS VARCHAR),
           'phys' || CAST(p_partkey % 9 AS VARCHAR) || '.c' || CAST(p_partkey % 4 AS VARCHAR) FROM part WHERE p_partkey % 4 = 0
    UNION ALL SELECT 'l2_' || CAST(p_partkey % 10 AS VARCHAR) || '.y' || CAST(p_partkey % 6 AS VARCHAR),
           'l1_' || CAST(p_partkey % 20 AS VARCHAR) || '.x' || CAST(p_partkey % 7 AS VARCHAR) FROM part
    UNION ALL SELECT 'l2_' || CAST(p_partkey % 10 AS VARCHAR) || '.z' || CAST(p_partkey % 3 AS VARCHAR),
           'l1_' || CAST(p_partkey % 20 AS VARCHAR) || '.calc' || CAST(p_partkey % 3 AS VARCHAR) FROM part WHERE p_partkey % 4 = 0)),
r(dst, via) AS (SELECT dst, src FROM e UNION SELECT r.dst, e.src FROM r JOIN e ON e.dst = r.via)
SELECT DISTINCT dst, via AS root FROM r WHERE starts_with(via, 'phys')""")
def transform_column_lineage(spark, sf_dir):
    """G-2: column lineage through a transformation DAG, resolved level by
    level down to physical columns."""
    return graph.resolve_to_roots(_transform_edges(spark, sf_dir), lambda c: c.startswith("phys"))
