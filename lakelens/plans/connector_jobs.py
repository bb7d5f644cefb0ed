"""Connector mapping jobs (J-12, J-14, J-18, J-20 .. J-22, J-25, G-8, G-11, G-12,
R-8, R-12, P-11, P-13, P-14, P-17, Q-7, Q-8, F-13, F-14, F-16, S-15) over landed
rows derived from the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakelens.functions import scalars
from lakelens.operators import lake, mappings, sqlscope
from lakelens.plans.catalog_jobs import K, info_tables, info_views
from lakelens.plans.registry import register
from lakelens.sources.tables import read_table


def _li(spark, sf_dir):
    return read_table(spark, sf_dir, "lineitem")


@register("replication_lineage", """WITH t AS (SELECT s_suppkey AS table_id, 'dst.' || lower(s_name) AS dest_table, 'src.' || lower(s_name) AS source_table
    FROM supplier s JOIN nation n ON (CASE WHEN s.s_suppkey % 11 = 0 THEN 999 ELSE s.s_nationkey END) = n.n_nationkey),
c AS (SELECT DISTINCT l_suppkey AS table_id, 'c' || CAST(l_linenumber AS VARCHAR) AS dest_column, 'src_c' || CAST(l_linenumber AS VARCHAR) AS source_column FROM lineitem)
SELECT t.dest_table, t.source_table, c.dest_column, c.source_column FROM t LEFT JOIN c USING (table_id)""")
def replication_lineage(spark, sf_dir):
    """J-12 + G-11: connector schemas -> tables -> columns (orphans dropped),
    then destination <- source table and column edges."""
    schemas = read_table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("id_schema"), "n_name")
    s = read_table(spark, sf_dir, "supplier")
    tables = s.select(F.col("s_suppkey").alias("table_id"),
                      F.when(F.col("s_suppkey") % 11 == 0, F.lit(999)).otherwise(F.col("s_nationkey")).alias("schema_id"),
                      F.concat(F.lit("dst."), F.lower("s_name")).alias("dest_table"),
                      F.concat(F.lit("src."), F.lower("s_name")).alias("source_table"))
    cols = _li(spark, sf_dir).select(F.col("l_suppkey").alias("table_id"), "l_linenumber").distinct().select(
        "table_id", F.concat(F.lit("c"), F.col("l_linenumber").cast("string")).alias("column_name"),
        F.concat(F.lit("src_c"), F.col("l_linenumber").cast("string")).alias("source_column"))
    return mappings.replication_edges(mappings.nest_schemas(schemas, tables, cols))


@register("catalog_dump", """WITH c AS (SELECT DISTINCT l_suppkey AS table_id, l_linenumber FROM lineitem),
ct AS (SELECT table_id, l_linenumber, 'c' || CAST(l_linenumber AS VARCHAR) AS column_name,
  concat_ws('|', CASE WHEN l_linenumber % 2 = 0 THEN 'even' END, CASE WHEN l_linenumber = 1 THEN 'pii' END) AS tags FROM c)
SELECT s.s_suppkey AS table_id, 'o' || CAST(s.s_nationkey AS VARCHAR) AS owner,
  (SELECT string_agg(column_name || '[' || tags || ']', ';' ORDER BY column_name) FROM ct WHERE ct.table_id = s.s_suppkey) AS columns
FROM supplier s""")
def catalog_dump(spark, sf_dir):
    """J-14: table -> columns -> tags -> owner from a catalog dump."""
    s = read_table(spark, sf_dir, "supplier")
    tables = s.select(F.col("s_suppkey").alias("table_id"))
    c = _li(spark, sf_dir).select(F.col("l_suppkey").alias("table_id"), "l_linenumber").distinct()
    cols = c.select("table_id", (F.col("table_id") * 10 + F.col("l_linenumber")).alias("column_id"),
                    F.concat(F.lit("c"), F.col("l_linenumber").cast("string")).alias("column_name"))
    tags = c.filter(F.col("l_linenumber") % 2 == 0).select((F.col("table_id") * 10 + F.col("l_linenumber")).alias("column_id"),
                                                          F.lit("even").alias("tag")) \
        .unionByName(c.filter(F.col("l_linenumber") == 1).select((F.col("table_id") * 10 + F.col("l_linenumber")).alias("column_id"),
                                                                F.lit("pii").alias("tag")))
    owners = s.select(F.col("s_suppkey").alias("table_id"), F.concat(F.lit("o"), F.col("s_nationkey").cast("string")).alias("owner"))
    out = mappings.catalog_dump(tables, cols, tags, owners)
    text = F.array_join(F.transform("columns", lambda x: F.concat(x["column_name"], F.lit("["),
                                                                  F.array_join(x["tags"], "|"), F.lit("]"))), ";")
    return out.select("table_id", "owner", text.alias("columns"))


@register("mapping_lineage", """SELECT o_orderkey AS mapping_id,
  lower('DB' || CAST(o_custkey AS VARCHAR) || '.sch.t' || CAST(o_orderkey % 7 AS VARCHAR)) AS source_table,
  lower('DB' || CAST(o_custkey + 1 AS VARCHAR) || '.out.t' || CAST(o_orderkey % 3 AS VARCHAR)) AS target_table
FROM orders WHERE o_custkey IN (SELECT s_suppkey FROM supplier) AND o_custkey + 1 IN (SELECT s_suppkey FROM supplier)""")
def mapping_lineage(spark, sf_dir, keep=False):
    """J-18: ETL mappings joined to their connections -> table lineage."""
    o = read_table(spark, sf_dir, "orders")
    m = o.select(F.col("o_orderkey").alias("mapping_id"), F.col("o_custkey").alias("source_connection"),
                 (F.col("o_custkey") + 1).alias("target_connection"),
                 F.concat(F.lit("sch/t"), (F.col("o_orderkey") % 7).cast("string")).alias("source_object"),
                 F.concat(F.lit("out/t"), (F.col("o_orderkey") % 3).cast("string")).alias("target_object"))
    conns = read_table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("connection_id"), F.concat(F.lit("DB"), F.col("s_suppkey").cast("string")).alias("database"))
    return mappings.mapping_lineage(m, conns, keep)


@register("mapping_lineage_all", """SELECT o.o_orderkey AS mapping_id,
  lower('DB' || CAST(a.s_suppkey AS VARCHAR) || '.sch.t' || CAST(o.o_orderkey % 7 AS VARCHAR)) AS source_table,
  lower('DB' || CAST(b.s_suppkey AS VARCHAR) || '.out.t' || CAST(o.o_orderkey % 3 AS VARCHAR)) AS target_table
FROM orders o LEFT JOIN supplier a ON a.s_suppkey = o.o_custkey LEFT JOIN supplier b ON b.s_suppkey = o.o_custkey + 1""")
def mapping_lineage_all(spark, sf_dir):
    """J-18 for every mapping; tables of unknown connections are null."""
    return mapping_lineage(spark, sf_dir, keep=True)


@register("card_sources", """WITH c AS (SELECT p_partkey AS card_id, CASE WHEN p_partkey % 6 = 0 THEN NULL ELSE p_partkey // 7 END AS table_id,
    CASE WHEN p_partkey % 4 = 0 THEN 'select ' || CAST(p_partkey AS VARCHAR) END AS native_sql FROM part),
t AS (SELECT s_suppkey AS table_id, lower(s_name) AS table_name, s_nationkey % 5 AS database_id FROM supplier)
SELECT c.card_id,
  CASE WHEN c.native_sql IS NULL AND t.table_name IS NOT NULL THEN 'DATASET~' || upper(md5('{"name":' || to_json(lower('db' || CAST(t.database_id AS VARCHAR) || '.public.' || t.table_name))
     || ',"platform":' || to_json(CASE t.database_id WHEN 0 THEN 'POSTGRESQL' WHEN 1 THEN 'SNOWFLAKE' ELSE 'MYSQL' END) || '}')) END AS source_dataset,
  c.native_sql AS query
FROM c LEFT JOIN t ON c.table_id = t.table_id""")
def card_sources(spark, sf_dir):
    """J-20: BI cards -> table -> database -> dataset id (native SQL keeps the query)."""
    p = read_table(spark, sf_dir, "part")
    cards = p.select(F.col("p_partkey").alias("card_id"),
                     F.when(F.col("p_partkey") % 6 != 0, F.floor(F.col("p_partkey") / 7).cast("long")).alias("table_id"),
                     F.when(F.col("p_partkey") % 4 == 0, F.concat(F.lit("select "), F.col("p_partkey").cast("string"))).alias("native_sql"))
    s = read_table(spark, sf_dir, "supplier")
    tables = s.select(F.col("s_suppkey").alias("table_id"), F.lower("s_name").alias("table_name"),
                      F.lit("public").alias("schema_name"), (F.col("s_nationkey") % 5).alias("database_id"))
    dbs = read_table(spark, sf_dir, "region").select(
        F.col("r_regionkey").cast("long").alias("database_id"), F.concat(F.lit("db"), F.col("r_regionkey").cast("string")).alias("db_name"),
        F.when(F.col("r_regionkey") == 0, "postgres").when(F.col("r_regionkey") == 1, "snowflake").otherwise("mysql").alias("engine"))
    return mappings.card_sources(cards, tables, dbs, {"postgres": "POSTGRESQL", "snowflake": "SNOWFLAKE", "mysql": "MYSQL"})


@register("workbook_sources", """WITH e AS (SELECT DISTINCT 'w' || CAST(p_partkey % 20 AS VARCHAR) AS workbook_id, 's' || CAST(p_partkey % 3 AS VARCHAR) AS source_name,
    'emb.t' || CAST(p_partkey % 7 AS VARCHAR) AS upstream_table FROM part),
p AS (SELECT DISTINCT 'w' || CAST(s_suppkey % 20 AS VARCHAR) AS workbook_id, 's' || CAST(s_suppkey % 2 AS VARCHAR) AS source_name,
    'pub.t' || CAST(s_suppkey AS VARCHAR) AS upstream_table FROM supplier),
c AS (SELECT 'w' || CAST(r_regionkey AS VARCHAR) AS workbook_id, 's0' AS source_name, 'custom.q' || CAST(r_regionkey AS VARCHAR) AS sql_table FROM region),
b AS (SELECT * FROM e WHERE (workbook_id, source_name) NOT IN (SELECT workbook_id, source_name FROM p) UNION ALL SELECT * FROM p)
SELECT DISTINCT b.workbook_id, b.source_name, coalesce(c.sql_table, b.upstream_table) AS upstream_table
FROM b LEFT JOIN c USING (workbook_id, source_name)""")
def workbook_sources(spark, sf_dir):
    """J-21: workbook sources (custom SQL wins; embedded skipped when published under the same name)."""
    p = read_table(spark, sf_dir, "part")
    emb = p.select(F.concat(F.lit("w"), (F.col("p_partkey") % 20).cast("string")).alias("workbook_id"),
                   F.concat(F.lit("s"), (F.col("p_partkey") % 3).cast("string")).alias("source_name"),
                   F.concat(F.lit("emb.t"), (F.col("p_partkey") % 7).cast("string")).alias("upstream_table")).distinct()
    s = read_table(spark, sf_dir, "supplier")
    pub = s.select(F.concat(F.lit("w"), (F.col("s_suppkey") % 20).cast("string")).alias("workbook_id"),
                   F.concat(F.lit("s"), (F.col("s_suppkey") % 2).cast("string")).alias("source_name"),
                   F.concat(F.lit("pub.t"), F.col("s_suppkey").cast("string")).alias("upstream_table")).distinct()
    r = read_table(spark, sf_dir, "region")
    cs = r.select(F.concat(F.lit("w"), F.col("r_regionkey").cast("string")).alias("workbook_id"), F.lit("s0").alias("source_name"),
                  F.concat(F.lit("custom.q"), F.col("r_regionkey").cast("string")).alias("sql_table"))
    return mappings.workbook_sources(emb, pub, cs).distinct()


@register("field_references", """WITH r AS (SELECT o_orderkey AS viz_id, unnest(['c' || CAST(o_custkey AS VARCHAR), 'c' || CAST(o_orderkey AS VARCHAR), 'missing']) AS column_ref FROM orders),
c AS (SELECT 'c' || CAST(p_partkey AS VARCHAR) AS column_ref, 'E' || CAST(p_partkey % 4 AS VARCHAR) AS entity_id, 'f' || CAST(p_partkey AS VARCHAR) AS field FROM part)
SELECT r.viz_id, c.entity_id, c.field FROM r JOIN c USING (column_ref)""")
def field_references(spark, sf_dir):
    """J-22: visualization column references resolved to (entity, field)."""
    o = read_table(spark, sf_dir, "orders")
    viz = o.select(F.col("o_orderkey").alias("viz_id"), F.array(
        F.concat(F.lit("c"), F.col("o_custkey").cast("string")),
        F.concat(F.lit("c"), F.col("o_orderkey").cast("string")), F.lit("missing")).alias("column_refs"))
    cols = read_table(spark, sf_dir, "part").select(
        F.concat(F.lit("c"), F.col("p_partkey").cast("string")).alias("column_ref"),
        F.concat(F.lit("E"), (F.col("p_partkey") % 4).cast("string")).alias("entity_id"),
        F.concat(F.lit("f"), F.col("p_partkey").cast("string")).alias("field"))
    return mappings.field_references(viz, cols)


@register("storage_views", """SELECT lower('hive.sch' || CAST(s_suppkey % 4 AS VARCHAR) || '.mv_' || CAST(s_suppkey AS VARCHAR)) AS view,
  lower('hive.storage.st_' || CAST(s_suppkey AS VARCHAR)) AS storage,
  'DATASET~' || upper(md5('{"name":' || to_json(lower('hive.sch' || CAST(s_suppkey % 4 AS VARCHAR) || '.mv_' || CAST(s_suppkey AS VARCHAR))) || ',"platform":"TRINO"}')) AS view_id,
  'DATASET~' || upper(md5('{"name":' || to_json(lower('hive.storage.st_' || CAST(s_suppkey AS VARCHAR))) || ',"platform":"TRINO"}')) AS storage_id
FROM supplier""")
def storage_views(spark, sf_dir):
    """J-25: materialised views linked to their storage tables."""
    s = read_table(spark, sf_dir, "supplier")
    mvs = s.select(F.concat(F.lit("sch"), (F.col("s_suppkey") % 4).cast("string")).alias("view_schema"),
                   F.concat(F.lit("mv_"), F.col("s_suppkey").cast("string")).alias("view_name"),
                   F.lit("storage").alias("storage_schema"), F.concat(F.lit("st_"), F.col("s_suppkey").cast("string")).alias("storage_table"))
    return mappings.storage_views(mvs, "hive")


@register("explore_upstreams", """SELECT DISTINCT 'e' || CAST(p_partkey % 40 AS VARCHAR) AS explore, 'v' || CAST(p_partkey % 40 AS VARCHAR) AS view FROM part
UNION SELECT 'e' || CAST(p_partkey % 40 AS VARCHAR), 'v' || CAST(p_partkey % 13 AS VARCHAR) FROM part""")
def explore_upstreams(spark, sf_dir):
    """G-8: explore upstream = base view + joined views."""
    p = read_table(spark, sf_dir, "part")
    ex = p.select(F.concat(F.lit("e"), (F.col("p_partkey") % 40).cast("string")).alias("explore"),
                  F.concat(F.lit("v"), (F.col("p_partkey") % 40).cast("string")).alias("base_view")).distinct()
    joins = p.select(F.concat(F.lit("e"), (F.col("p_partkey") % 40).cast("string")).alias("explore"),
                     F.concat(F.lit("v"), (F.col("p_partkey") % 13).cast("string")).alias("joined_view"))
    return mappings.explore_upstreams(ex, joins)


@register("dashboard_upstreams", """WITH c AS (SELECT 'd' || CAST(o_custkey % 30 AS VARCHAR) AS dashboard,
    unnest(['e' || CAST(o_orderkey % 45 AS VARCHAR), 'e' || CAST(o_custkey % 40 AS VARCHAR)]) AS explore FROM orders)
SELECT DISTINCT dashboard, explore FROM c WHERE explore IN (SELECT 'e' || CAST(p_partkey % 40 AS VARCHAR) FROM part)""")
def dashboard_upstreams(spark, sf_dir):
    """G-12: chart filterables -> explores -> dashboard upstreams."""
    o = read_table(spark, sf_dir, "orders")
    charts = o.select(F.concat(F.lit("d"), (F.col("o_custkey") % 30).cast("string")).alias("dashboard"),
                      F.array(F.concat(F.lit("e"), (F.col("o_orderkey") % 45).cast("string")),
                              F.concat(F.lit("e"), (F.col("o_custkey") % 40).cast("string"))).alias("filterables"))
    ex = read_table(spark, sf_dir, "part").select(F.concat(F.lit("e"), (F.col("p_partkey") % 40).cast("string")).alias("explore"))
    return mappings.dashboard_upstreams(charts, ex)


@register("latest_docs", """SELECT dataset, "column", arg_max(description, (seq, description)) AS description FROM (
  SELECT 't' || CAST(l_suppkey % 10 AS VARCHAR) AS dataset, lower(CASE WHEN l_linenumber % 2 = 0 THEN 'C' ELSE 'c' END || CAST(l_linenumber AS VARCHAR)) AS "column",
    CASE WHEN CAST(l_quantity AS INTEGER) % 7 = 0 THEN '' ELSE 'q' || CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) END AS description,
    l_orderkey * 10 + l_linenumber AS seq FROM lineitem) WHERE description <> '' GROUP BY ALL""")
def latest_docs(spark, sf_dir):
    """R-8: source documentation: latest non-empty description per (dataset, lower(column))."""
    li = _li(spark, sf_dir)
    q = F.col("l_quantity").cast("int")
    docs = li.select(F.concat(F.lit("t"), (F.col("l_suppkey") % 10).cast("string")).alias("dataset"),
                     F.concat(F.when(F.col("l_linenumber") % 2 == 0, "C").otherwise("c"), F.col("l_linenumber").cast("string")).alias("column"),
                     F.when(q % 7 == 0, F.lit("")).otherwise(F.concat(F.lit("q"), q.cast("string"))).alias("description"),
                     (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("seq"))
    return mappings.latest_docs(docs)


@register("column_formulas", """WITH c AS (SELECT 'col' || CAST(p_partkey AS VARCHAR) AS column_name,
    CASE WHEN p_partkey % 3 = 0 THEN 'f' || CAST(p_partkey // 2 AS VARCHAR) END AS formula_id FROM part),
f AS (SELECT DISTINCT key, expr FROM (SELECT 'f' || CAST(p_partkey AS VARCHAR) AS key, 'sum(x' || CAST(p_partkey AS VARCHAR) || ')' AS expr FROM part
      UNION ALL SELECT 'col' || CAST(p_partkey * 7 AS VARCHAR), 'sum(x' || CAST(p_partkey AS VARCHAR) || ')' FROM part))
SELECT c.column_name, c.formula_id, f.expr FROM c LEFT JOIN f ON coalesce(c.formula_id, c.column_name) = f.key""")
def column_formulas(spark, sf_dir):
    """R-12: columns mapped to formula expressions (by formula id, else by name)."""
    p = read_table(spark, sf_dir, "part")
    cols = p.select(F.concat(F.lit("col"), F.col("p_partkey").cast("string")).alias("column_name"),
                    F.when(F.col("p_partkey") % 3 == 0, F.concat(F.lit("f"), F.floor(F.col("p_partkey") / 2).cast("string"))).alias("formula_id"))
    fs = p.select(
        F.concat(F.lit("f"), F.col("p_partkey").cast("string")).alias("formula_id"),
        F.concat(F.lit("col"), (F.col("p_partkey") * 7).cast("string")).alias("formula_name"),
        F.concat(F.lit("sum(x"), F.col("p_partkey").cast("string"), F.lit(")")).alias("expr"))
    return mappings.column_formulas(cols, fs)


@register("valid_endpoints", """SELECT l_orderkey AS query_id, CAST(count(*) FILTER (WHERE l_linenumber NOT IN (2, 3)) AS INTEGER) AS n_valid,
  CAST(count(*) AS INTEGER) AS n_all FROM lineitem GROUP BY l_orderkey""")
def valid_endpoints(spark, sf_dir):
    """P-11: lineage endpoints need non-empty database, schema and table."""
    li = _li(spark, sf_dir)
    ds = F.struct(F.when(F.col("l_linenumber") == 2, F.lit("")).otherwise(F.lit("db")).alias("database"),
                  F.when(F.col("l_linenumber") == 3, F.lit(None).cast("string")).otherwise(F.lit("sch")).alias("schema"),
                  F.concat(F.lit("t"), F.col("l_partkey").cast("string")).alias("table"))
    per_q = li.groupBy(F.col("l_orderkey").alias("query_id")).agg(F.collect_list(ds).alias("datasets"))
    return per_q.select("query_id", F.size(mappings.valid_endpoints("datasets")).alias("n_valid"),
                        F.size("datasets").alias("n_all"))


@register("id_filters", """SELECT 'd' || CAST(p_partkey AS VARCHAR) AS dashboard_id FROM part
WHERE 'd' || CAST(p_partkey AS VARCHAR) NOT IN ('d3', 'd5', 'd10')
  AND (starts_with('/shared/team' || CAST(p_partkey % 4 AS VARCHAR) || '/x', '/shared/team1') OR starts_with('/shared/team' || CAST(p_partkey % 4 AS VARCHAR) || '/x', '/shared/team2'))
  AND lower(p_type) IN ('economy', 'standard', 'promo')""")
def id_filters(spark, sf_dir):
    """P-14 + P-13: id-list excludes, path-prefix includes and kept types."""
    p = read_table(spark, sf_dir, "part")
    d = p.select(F.concat(F.lit("d"), F.col("p_partkey").cast("string")).alias("dashboard_id"),
                 F.concat(F.lit("/shared/team"), (F.col("p_partkey") % 4).cast("string"), F.lit("/x")).alias("path"), "p_type")
    return d.filter(mappings.include_ids("dashboard_id", excludes=["d3", "d5", "d10"])
                    & mappings.include_ids("path", prefixes=["/shared/team1", "/shared/team2"])
                    & mappings.only_types("p_type", ["economy", "standard", "promo"])).select("dashboard_id")


@register("dotted_names", """SELECT p_partkey FROM part WHERE p_partkey % 9 <> 0 AND p_partkey % 5 <> 0""")
def dotted_names(spark, sf_dir):
    """P-17: catalog names whose parts contain dots are dropped."""
    p = read_table(spark, sf_dir, "part")
    x = p.select("p_partkey", F.when(F.col("p_partkey") % 9 == 0, F.lit("a.b")).otherwise(F.lit("s")).alias("schema"),
                 F.when(F.col("p_partkey") % 5 == 0, F.replace(F.col("p_name"), F.lit(" "), F.lit("."))).otherwise(F.col("p_name")).alias("tbl"))
    return x.filter(mappings.no_dotted_parts("schema", "tbl")).select("p_partkey")


@register("view_lineage", """SELECT lower(r.r_name) || '.' || lower(n.n_name) || '.' || lower(s.s_name) AS view, 'lineitem' AS source
FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey WHERE s.s_suppkey % 4 = 0""")
def view_lineage(spark, sf_dir):
    """Q-7: view upstreams from the view definitions' SQL."""
    v = info_views(info_tables(spark, sf_dir)).select(F.concat_ws(".", *K).alias("view"), "view_definition")
    lin = sqlscope.table_lineage(v, "view", "view_definition").filter(F.col("role") == "source")
    return lin.select(F.col("qid").alias("view"), F.col("table").alias("source"))


@register("custom_sql_sources", """SELECT o_orderkey AS query_id, 'db.sch.t' || CAST(o_orderkey % 9 AS VARCHAR) AS "table" FROM orders""")
def custom_sql_sources(spark, sf_dir):
    """Q-8: custom SQL of BI sources: only fully qualified tables count."""
    o = read_table(spark, sf_dir, "orders")
    q = o.select(F.col("o_orderkey").alias("query_id"), F.concat(
        F.lit("SELECT a.x FROM db.sch.t"), (F.col("o_orderkey") % 9).cast("string"), F.lit(" a JOIN t"),
        (F.col("o_orderkey") % 4).cast("string"), F.lit(" b ON a.k = b.k")).alias("sql"))
    lin = sqlscope.table_lineage(q, "query_id", "sql").filter((F.col("role") == "source") & mappings.fully_qualified("table"))
    return lin.select(F.col("qid").alias("query_id"), "table")


@register("type_precision", """WITH t AS (SELECT p_partkey, CASE p_partkey % 6 WHEN 0 THEN 'numeric(' || CAST(p_partkey % 20 + 1 AS VARCHAR) || ',2)'
    WHEN 1 THEN 'character varying(' || CAST(p_partkey % 100 + 1 AS VARCHAR) || ')' WHEN 2 THEN 'integer' WHEN 3 THEN 'bigint'
    WHEN 4 THEN 'varchar' ELSE 'double precision' END AS native_type FROM part)
SELECT p_partkey, native_type,
  CASE p_partkey % 6 WHEN 0 THEN CAST(p_partkey % 20 + 1 AS DOUBLE) WHEN 2 THEN 32.0 WHEN 3 THEN 64.0 WHEN 5 THEN 53.0 END AS "precision",
  CASE p_partkey % 6 WHEN 1 THEN CAST(p_partkey % 100 + 1 AS DOUBLE) END AS max_length FROM t""")
def type_precision(spark, sf_dir):
    """F-16: precision / max length from type texts."""
    p = read_table(spark, sf_dir, "part")
    k = F.col("p_partkey") % 6
    t = (F.when(k == 0, F.concat(F.lit("numeric("), (F.col("p_partkey") % 20 + 1).cast("string"), F.lit(",2)")))
         .when(k == 1, F.concat(F.lit("character varying("), (F.col("p_partkey") % 100 + 1).cast("string"), F.lit(")")))
         .when(k == 2, "integer").when(k == 3, "bigint").when(k == 4, "varchar").otherwise("double precision"))
    pr = scalars.type_precision(t)
    return p.select("p_partkey", t.alias("native_type"), pr["precision"].alias("precision"), pr["max_length"].alias("max_length"))


@register("list_helpers", """SELECT l_orderkey, CAST(count(*) FILTER (WHERE l_linenumber % 3 <> 0) AS INTEGER) AS n_kept,
  CAST(ceil(count(*) / 3.0) AS INTEGER) AS n_chunks FROM lineitem GROUP BY l_orderkey""")
def list_helpers(spark, sf_dir):
    """F-13 / F-14: empty / null items dropped, lists cut into chunks of 3."""
    li = _li(spark, sf_dir)
    v = F.when(F.col("l_linenumber") % 3 == 1, F.col("l_returnflag")).when(F.col("l_linenumber") % 3 == 2, F.lit(""))
    per = li.groupBy("l_orderkey").agg(F.collect_list(F.coalesce(v, F.lit("x"))).alias("vals"),
                                       F.collect_list(F.when(F.col("l_linenumber") % 3 != 0, v)).alias("with_nulls"),
                                       F.collect_list("l_linenumber").alias("lines"))
    kept = F.size(scalars.drop_nulls(F.transform("with_nulls", lambda x: F.when(x == "", F.lit("e")).otherwise(x))))
    return per.select("l_orderkey", kept.alias("n_kept"), F.size(scalars.fixed_chunks("lines", 3)).alias("n_chunks"))


@register("volume_files")
def volume_files(spark, sf_dir):
    """S-15: a volume / folder listing as catalog rows (files per folder, bytes)."""
    f = lake.listing(spark, sf_dir)
    return f.groupBy(F.regexp_replace("path", r"/[^/]*$", "").alias("folder")).agg(
        F.count(F.lit(1)).alias("n_files"), F.sum("length").alias("total_bytes"), F.max("modificationTime").alias("last_modified"))


@register("dashboard_charts", """WITH d AS (SELECT 'dash' || CAST(s_suppkey % 20 AS VARCHAR) AS dashboard_id, 'Board ' || CAST(s_suppkey % 20 AS VARCHAR) AS title,
    s_suppkey AS card_id, s_suppkey AS position FROM supplier),
c AS (SELECT s_suppkey AS card_id, CASE s_suppkey % 3 WHEN 0 THEN 'bar' WHEN 1 THEN 'line' ELSE 'table' END AS chart_type FROM supplier WHERE s_suppkey % 7 <> 0)
SELECT dashboard_id, title, string_agg(CAST(d.card_id AS VARCHAR) || ':' || chart_type, ';' ORDER BY position) AS charts
FROM d JOIN c USING (card_id) GROUP BY dashboard_id, title""")
def dashboard_charts(spark, sf_dir):
    """R-6: dashboards with their charts."""
    s = read_table(spark, sf_dir, "supplier")
    dash = s.groupBy((F.col("s_suppkey") % 20).alias("k")).agg(F.array_sort(F.collect_list("s_suppkey")).alias("card_ids")) \
        .select(F.concat(F.lit("dash"), F.col("k").cast("string")).alias("dashboard_id"),
                F.concat(F.lit("Board "), F.col("k").cast("string")).alias("title"), "card_ids")
    cards = s.filter(F.col("s_suppkey") % 7 != 0).select(
        F.col("s_suppkey").alias("card_id"),
        F.when(F.col("s_suppkey") % 3 == 0, "bar").when(F.col("s_suppkey") % 3 == 1, "line").otherwise("table").alias("chart_type"))
    out = mappings.dashboard_charts(dash, cards)
    return out.select("dashboard_id", "title", F.array_join(F.transform(
        "charts", lambda c: F.concat(c["card_id"].cast("string"), F.lit(":"), c["chart_type"])), ";").alias("charts"))


@register("semantic_tables", """SELECT 'm' || CAST(n_regionkey AS VARCHAR) AS model_id, lower(n_name) AS table_name,
  'id,name' AS columns, 'total=SUM(' || lower(n_name) || '.amount)' AS measures FROM nation""")
def semantic_tables(spark, sf_dir):
    """R-11: semantic-model tables with their columns and measures."""
    n = read_table(spark, sf_dir, "nation")
    t = F.struct(F.lower("n_name").alias("name"),
                 F.array(F.struct(F.lit("id").alias("name")), F.struct(F.lit("name").alias("name"))).alias("columns"),
                 F.array(F.struct(F.lit("total").alias("name"),
                                  F.concat(F.lit("SUM("), F.lower("n_name"), F.lit(".amount)")).alias("expression"))).alias("measures"))
    models = n.groupBy(F.concat(F.lit("m"), F.col("n_regionkey").cast("string")).alias("model_id")).agg(F.collect_list(t).alias("tables"))
    out = mappings.semantic_tables(models)
    return out.select("model_id", "table_name", F.array_join("columns", ",").alias("columns"),
                      F.array_join("measures", ",").alias("measures"))


@register("refresh_schedule", """SELECT 'ds' || CAST(c_custkey AS VARCHAR) AS model_id,
  CASE WHEN c_custkey % 3 = 0 THEN 'Mon|Thu' END AS days,
  CASE WHEN c_custkey % 3 = 0 THEN '07:00' WHEN c_custkey % 3 = 1 THEN 'every ' || CAST(15 * (c_custkey % 4 + 1) AS VARCHAR) || 'm' END AS times
FROM customer""")
def refresh_schedule(spark, sf_dir):
    """R-13: model refresh schedule, else the direct-query schedule."""
    c = read_table(spark, sf_dir, "customer")
    models = c.select(F.concat(F.lit("ds"), F.col("c_custkey").cast("string")).alias("model_id"), "c_custkey")
    ms = models.filter(F.col("c_custkey") % 3 == 0).select("model_id", F.array(F.lit("Mon"), F.lit("Thu")).alias("days"),
                                                           F.array(F.lit("07:00")).alias("times"))
    dq = models.filter(F.col("c_custkey") % 3 == 1).select("model_id", (F.lit(15) * (F.col("c_custkey") % 4 + 1)).alias("frequency_minutes"))
    out = mappings.refresh_schedule(models.select("model_id"), ms, dq)
    return out.select("model_id", F.array_join("schedule.days", "|").alias("days"), F.array_join("schedule.times", "|").alias("times"))


@register("source_params", """SELECT s_suppkey AS source_id,
  CASE WHEN s_suppkey % 3 = 0 THEN 'SNOWFLAKE' WHEN s_suppkey % 3 = 1 THEN 'POSTGRESQL' END AS platform,
  CASE WHEN s_suppkey % 3 = 0 THEN 'wh' || CAST(s_nationkey AS VARCHAR) WHEN s_suppkey % 3 = 1 THEN 'pg' || CAST(s_nationkey AS VARCHAR) END AS database,
  CASE WHEN s_suppkey % 3 = 0 THEN 'acct' || CAST(s_suppkey AS VARCHAR) WHEN s_suppkey % 3 = 1 THEN 'host' || CAST(s_suppkey AS VARCHAR) END AS account
FROM supplier""")
def source_params(spark, sf_dir):
    """R-14: data-source parameters -> first family that is set."""
    s = read_table(spark, sf_dir, "supplier")
    k = F.col("s_suppkey") % 3
    p = s.select(F.col("s_suppkey").alias("source_id"),
                 F.when(k == 0, F.struct(F.concat(F.lit("wh"), F.col("s_nationkey").cast("string")).alias("warehouse"),
                                         F.concat(F.lit("acct"), F.col("s_suppkey").cast("string")).alias("host"))).alias("snowflake"),
                 F.when(k != 2, F.struct(F.concat(F.lit("pg"), F.col("s_nationkey").cast("string")).alias("database"),
                                         F.concat(F.lit("host"), F.col("s_suppkey").cast("string")).alias("host"))).alias("postgres"))
    out = mappings.first_family(p, [("snowflake", "SNOWFLAKE", "warehouse"), ("postgres", "POSTGRESQL", "database")])
    return out.select("source_id", "source.platform", "source.database", "source.account")


@register("storage_paths", """SELECT p_partkey,
  CASE p_partkey % 3 WHEN 0 THEN concat_ws('/', 'https://acct' || CAST(p_partkey % 5 AS VARCHAR) || '.blob.core.windows.net', 'c' || CAST(p_size AS VARCHAR),
                                          CASE WHEN p_partkey % 2 = 0 THEN 'raw' END, lower(p_brand) || '.csv')
       WHEN 1 THEN concat_ws('/', 'abfss://c' || CAST(p_size AS VARCHAR) || '@acct' || CAST(p_partkey % 5 AS VARCHAR) || '.dfs.core.windows.net',
                             CASE WHEN p_partkey % 2 = 0 THEN 'raw' END, lower(p_brand) || '.csv')
       ELSE concat_ws('/', CASE WHEN p_partkey % 2 = 0 THEN 'raw' END, lower(p_brand) || '.csv') END AS path,
  concat_ws(',', 'type=' || p_type, CASE WHEN p_partkey % 4 = 0 THEN 'format=csv' END) AS extras
FROM part""")
def storage_paths(spark, sf_dir):
    """R-15 + R-16: storage locations -> paths by kind; table extras without null values."""
    p = read_table(spark, sf_dir, "part")
    k = p.p_partkey % 3
    kind = F.when(k == 0, "AzureBlobStorageLocation").when(k == 1, "AzureBlobFSLocation").otherwise("Local")
    path = mappings.storage_path(kind, F.concat(F.lit("acct"), (F.col("p_partkey") % 5).cast("string")),
                                 F.concat(F.lit("c"), F.col("p_size").cast("string")),
                                 F.when(F.col("p_partkey") % 2 == 0, F.lit("raw")), F.concat(F.lower("p_brand"), F.lit(".csv")))
    extras = mappings.extra_items(type=F.col("p_type"), format=F.when(F.col("p_partkey") % 4 == 0, F.lit("csv")))
    return p.select("p_partkey", path.alias("path"),
                    F.array_join(F.transform(extras, lambda e: F.concat(e["key"], F.lit("="), e["value"])), ",").alias("extras"))


@register("suite_monitors", """SELECT 'suite_' || CAST(o_orderkey AS VARCHAR) AS suite, 'ds' || CAST(o_custkey % 10 AS VARCHAR) AS dataset,
  CASE WHEN bool_and(l_quantity < 45) THEN 'PASSED' ELSE 'ERROR' END AS status,
  string_agg(DISTINCT 'c' || CAST(l_linenumber % 3 AS VARCHAR), ',' ORDER BY 'c' || CAST(l_linenumber % 3 AS VARCHAR)) AS columns,
  coalesce(string_agg(CASE WHEN l_quantity >= 45 THEN 'max_q_' || CAST(l_linenumber AS VARCHAR) END, ',' ORDER BY CASE WHEN l_quantity >= 45 THEN 'max_q_' || CAST(l_linenumber AS VARCHAR) END), '') AS exceptions
FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1, 2""")
def suite_monitors(spark, sf_dir):
    """M-5: validation-suite results -> one monitor per suite."""
    o = read_table(spark, sf_dir, "orders")
    li = _li(spark, sf_dir)
    r = li.select("l_orderkey", F.struct(F.concat(F.lit("c"), (F.col("l_linenumber") % 3).cast("string")).alias("column"),
                                        (F.col("l_quantity") < 45).alias("success"),
                                        F.concat(F.lit("max_q_"), F.col("l_linenumber").cast("string")).alias("expectation")).alias("r"))
    per = r.groupBy("l_orderkey").agg(F.collect_list("r").alias("results"))
    res = o.join(per, o.o_orderkey == per.l_orderkey).select(
        F.concat(F.lit("suite_"), F.col("o_orderkey").cast("string")).alias("suite"),
        F.concat(F.lit("ds"), (F.col("o_custkey") % 10).cast("string")).alias("dataset"), "results")
    out = mappings.suite_monitors(res)
    return out.select("suite", "dataset", "status", F.array_join("columns", ",").alias("columns"),
                      F.array_join("exceptions", ",").alias("exceptions"))


@register("stream_catalog", """WITH c AS (SELECT s.s_suppkey AS k, s.s_name, r.r_name FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey),
b AS (SELECT k, lower('DB.' || r_name || '.' || s_name) AS source_table FROM c UNION ALL SELECT k, 'db.x.t' || CAST(k AS VARCHAR) FROM c WHERE k % 6 = 0)
SELECT 'stream_' || CAST(k AS VARCHAR) AS stream_name,
  CASE k % 4 WHEN 0 THEN 'APPEND_ONLY' WHEN 1 THEN 'INSERT_ONLY' WHEN 2 THEN 'STANDARD' END AS stream_type,
  CASE k % 5 WHEN 0 THEN 'TABLE' WHEN 1 THEN 'VIEW' WHEN 2 THEN 'TABLE' WHEN 3 THEN 'TABLE' END AS source_type, k % 5 = 0 AS is_stale, source_table FROM b""")
def stream_catalog(spark, sf_dir):
    """T-6: stream objects as catalog rows, a row per base table."""
    from lakelens.plans.naming import supplier_catalog
    c = supplier_catalog(spark, sf_dir)
    k = F.col("s_suppkey")
    kinds = F.when(k % 5 == 0, "Table").when(k % 5 == 1, "View").when(k % 5 == 2, "External Table").when(k % 5 == 3, "directory table").otherwise("Stage")
    streams = c.select(F.concat(F.lit("stream_"), k.cast("string")).alias("stream_name"),
                       F.when(k % 4 == 0, "APPEND_ONLY").when(k % 4 == 1, "insert_only").when(k % 4 == 2, "DEFAULT").alias("mode"), kinds.alias("source_kind"),
                       F.when(k % 5 == 0, "true").otherwise("false").alias("stale"),
                       F.concat(F.concat_ws(".", F.lit("DB"), "db", "tbl"), F.when(k % 6 == 0, F.concat(F.lit(" , DB.X.T"), k.cast("string"))).otherwise("")).alias("base_tables"))
    return mappings.stream_catalog(streams)
