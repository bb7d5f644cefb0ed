"""Catalog jobs (J-1 .. J-8, R-1, R-2, R-9, A-13, A-19, U-1 .. U-3).

Information-schema-shaped inputs derived from the tables:
  tables      one per supplier (catalog = region, schema = nation)
  views       suppliers with key % 4 = 0
  table_tags  tier=gold when the balance is above 5000, pii=yes when key % 3 = 0
  columns     one per distinct (supplier, line number) in lineitem
  column_tags key=primary on column 1, pii=email on column 7
"""

from __future__ import annotations

from pyspark.sql import functions as F

from lakelens.functions import names
from lakelens.operators import catalog
from lakelens.plans.naming import supplier_catalog
from lakelens.plans.registry import register
from lakelens.sources.tables import read_table

K = list(catalog.TABLE_KEYS)


def info_tables(spark, sf_dir):
    c = supplier_catalog(spark, sf_dir)
    s = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_acctbal", "s_nationkey")
    k = F.col("s_suppkey") % 4
    return c.join(s, "s_suppkey").select(
        "s_suppkey", "s_acctbal",
        F.lower("db").alias("table_catalog"), F.lower("schema").alias("table_schema"), F.lower("tbl").alias("table_name"),
        F.when(k == 0, "VIEW").when(k == 1, "EXTERNAL").otherwise("MANAGED").alias("table_type"),
        F.concat(F.lit("owner"), F.col("s_nationkey").cast("string")).alias("owner"),
        F.when(F.col("s_suppkey") % 2 == 0, F.concat(F.lit("supplier "), F.col("s_suppkey").cast("string"))).alias("comment"),
    )


def info_views(tables):
    return tables.filter(F.col("table_type") == "VIEW").select(
        *K, F.concat(F.lit("SELECT * FROM lineitem WHERE l_suppkey = "), F.col("s_suppkey").cast("string")).alias("view_definition"))


def info_table_tags(tables):
    gold = tables.filter(F.col("s_acctbal") > 5000).select(*K, F.lit("tier").alias("tag_name"), F.lit("gold").alias("tag_value"))
    pii = tables.filter(F.col("s_suppkey") % 3 == 0).select(*K, F.lit("pii").alias("tag_name"), F.lit("yes").alias("tag_value"))
    return gold.unionByName(pii)


def info_columns(spark, sf_dir, tables):
    li = read_table(spark, sf_dir, "lineitem").select("l_suppkey", "l_linenumber").distinct()
    n = F.col("l_linenumber")
    return li.join(tables.select("s_suppkey", *K), li.l_suppkey == tables.s_suppkey).select(
        *K,
        F.concat(F.lit("c"), n.cast("string")).alias("column_name"),
        n.alias("ordinal_position"),
        F.when(n % 3 == 0, "bigint").when(n % 3 == 1, "string").otherwise("decimal").alias("data_type"),
        F.when(n % 3 == 2, n + 10).alias("data_precision"),
        F.when(n == 1, "NO").otherwise("YES").alias("is_nullable"),
        F.lit(None).cast("string").alias("comment"),
    )


def info_column_tags(columns):
    key = columns.filter(F.col("ordinal_position") == 1).select(*K, "column_name", F.lit("key").alias("tag_name"), F.lit("primary").alias("tag_value"))
    pii = columns.filter(F.col("ordinal_position") == 7).select(*K, "column_name", F.lit("pii").alias("tag_name"), F.lit("email").alias("tag_value"))
    return key.unionByName(pii)


INFO_SQL = """cat AS (
  SELECT s.s_suppkey, s.s_acctbal, lower(r.r_name) AS table_catalog, lower(n.n_name) AS table_schema, lower(s.s_name) AS table_name,
    CASE s.s_suppkey % 4 WHEN 0 THEN 'VIEW' WHEN 1 THEN 'EXTERNAL' ELSE 'MANAGED' END AS table_type,
    'owner' || CAST(s.s_nationkey AS VARCHAR) AS owner,
    CASE WHEN s.s_suppkey % 2 = 0 THEN 'supplier ' || CAST(s.s_suppkey AS VARCHAR) END AS comment
  FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey),
v AS (SELECT table_catalog, table_schema, table_name, 'SELECT * FROM lineitem WHERE l_suppkey = ' || CAST(s_suppkey AS VARCHAR) AS view_definition
      FROM cat WHERE table_type = 'VIEW'),
tt AS (SELECT table_catalog, table_schema, table_name, 'tier' AS tag_name, 'gold' AS tag_value FROM cat WHERE s_acctbal > 5000
       UNION ALL SELECT table_catalog, table_schema, table_name, 'pii', 'yes' FROM cat WHERE s_suppkey % 3 = 0),
c AS (SELECT cat.table_catalog, cat.table_schema, cat.table_name, 'c' || CAST(l.l_linenumber AS VARCHAR) AS column_name,
        l.l_linenumber AS ordinal_position,
        CASE l.l_linenumber % 3 WHEN 0 THEN 'bigint' WHEN 1 THEN 'string' ELSE 'decimal' END AS data_type,
        CASE WHEN l.l_linenumber % 3 = 2 THEN l.l_linenumber + 10 END AS data_precision,
        CASE WHEN l.l_linenumber = 1 THEN 'NO' ELSE 'YES' END AS is_nullable
      FROM (SELECT DISTINCT l_suppkey, l_linenumber FROM lineitem) l JOIN cat ON l.l_suppkey = cat.s_suppkey),
ct AS (SELECT table_catalog, table_schema, table_name, column_name, 'key' AS tag_name, 'primary' AS tag_value FROM c WHERE ordinal_position = 1
       UNION ALL SELECT table_catalog, table_schema, table_name, column_name, 'pii', 'email' FROM c WHERE ordinal_position = 7)"""


def _tags_text(c):
    return F.array_join(F.transform(c, lambda t: F.concat(t["tag_name"], F.lit("="), t["tag_value"])), "|")


@register("catalog_nested", f"""WITH {INFO_SQL},
ctt AS (SELECT table_catalog, table_schema, table_name, column_name,
          string_agg(tag_name || '=' || tag_value, '|' ORDER BY tag_name, tag_value) AS tags FROM ct GROUP BY ALL),
cf AS (SELECT c.table_catalog, c.table_schema, c.table_name,
          string_agg(c.column_name || ':' || c.data_type || ':' || coalesce(CAST(c.data_precision AS VARCHAR), '') || ':' || c.is_nullable
                     || ':' || coalesce(ctt.tags, ''), ';' ORDER BY c.ordinal_position, c.column_name) AS columns
       FROM c LEFT JOIN ctt USING (table_catalog, table_schema, table_name, column_name) GROUP BY ALL),
ttt AS (SELECT table_catalog, table_schema, table_name, string_agg(tag_name || '=' || tag_value, '|' ORDER BY tag_name, tag_value) AS tags
        FROM tt GROUP BY ALL)
SELECT cat.table_catalog, cat.table_schema, cat.table_name, cat.table_type, cat.owner, cat.comment, v.view_definition,
       ttt.tags, cf.columns
FROM cat LEFT JOIN v USING (table_catalog, table_schema, table_name) LEFT JOIN ttt USING (table_catalog, table_schema, table_name)
LEFT JOIN cf USING (table_catalog, table_schema, table_name)""")
def catalog_nested(spark, sf_dir):
    """J-1: the nested table listing (tables + views + tags + columns + column tags)."""
    t = info_tables(spark, sf_dir)
    cols = info_columns(spark, sf_dir, t)
    out = catalog.nested_tables(
        t.select(*K, "table_type", "owner", "comment"), info_views(t), info_table_tags(t), cols, info_column_tags(cols))
    col_text = F.array_join(F.transform("columns", lambda c: F.concat_ws(
        ":", c["column_name"], c["data_type"], F.coalesce(c["data_precision"].cast("string"), F.lit("")),
        c["is_nullable"], F.coalesce(_tags_text(c["tags"]), F.lit("")))), ";")
    return out.select(*K, "table_type", "owner", "comment", "view_definition",
                      _tags_text(F.col("tags")).alias("tags"), col_text.alias("columns"))


@register("catalog_tags", """WITH s AS (SELECT DISTINCT lower(r.r_name) AS catalog_name, lower(n.n_name) AS schema_name, n.n_nationkey, n.n_regionkey
  FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey),
st AS (SELECT catalog_name, schema_name, 'domain' AS tag_name, 'even' AS tag_value FROM s WHERE n_nationkey % 2 = 0
       UNION ALL SELECT catalog_name, schema_name, 'owner', 'team' || CAST(n_regionkey AS VARCHAR) FROM s WHERE n_nationkey % 5 = 0)
SELECT s.catalog_name, s.schema_name,
  (SELECT string_agg(tag_name || '=' || tag_value, '|' ORDER BY tag_name, tag_value) FROM st
   WHERE st.catalog_name = s.catalog_name AND st.schema_name = s.schema_name) AS tags
FROM s""")
def catalog_tags(spark, sf_dir):
    """J-2: schemas left-joined with their tags."""
    n = read_table(spark, sf_dir, "nation")
    r = read_table(spark, sf_dir, "region")
    s = n.join(r, n.n_regionkey == r.r_regionkey).select(
        F.lower("r_name").alias("catalog_name"), F.lower("n_name").alias("schema_name"), "n_nationkey", "n_regionkey")
    tg = s.filter(F.col("n_nationkey") % 2 == 0).select("catalog_name", "schema_name", F.lit("domain").alias("tag_name"), F.lit("even").alias("tag_value")) \
        .unionByName(s.filter(F.col("n_nationkey") % 5 == 0).select(
            "catalog_name", "schema_name", F.lit("owner").alias("tag_name"),
            F.concat(F.lit("team"), F.col("n_regionkey").cast("string")).alias("tag_value")))
    out = catalog.hierarchy_with_tags(s.select("catalog_name", "schema_name"), tg, ["catalog_name", "schema_name"])
    return out.select("catalog_name", "schema_name", _tags_text(F.col("tags")).alias("tags"))


@register("constraints_zip", f"""WITH {INFO_SQL},
fk AS (SELECT table_catalog, table_schema, table_name, 'fk_' || CAST(s_suppkey AS VARCHAR) AS constraint_name,
          CASE WHEN s_suppkey % 5 = 0 THEN 1 ELSE 2 END AS n_ref FROM cat WHERE s_suppkey % 2 = 0)
SELECT table_catalog, table_schema, table_name, constraint_name, 0 AS pos, 'c1' AS column_name, 'n_nationkey' AS referred_column FROM fk WHERE n_ref = 2
UNION ALL
SELECT table_catalog, table_schema, table_name, constraint_name, 1, 'c2', 'n_regionkey' FROM fk WHERE n_ref = 2""")
def constraints_zip(spark, sf_dir):
    """J-6: foreign keys zipped to (column, referred column) pairs; lists of
    different lengths are dropped."""
    t = info_tables(spark, sf_dir).filter(F.col("s_suppkey") % 2 == 0)
    fks = t.select(
        *K, F.concat(F.lit("fk_"), F.col("s_suppkey").cast("string")).alias("constraint_name"),
        F.array(F.lit("c1"), F.lit("c2")).alias("constrained_columns"),
        F.when(F.col("s_suppkey") % 5 == 0, F.array(F.lit("n_nationkey")))
        .otherwise(F.array(F.lit("n_nationkey"), F.lit("n_regionkey"))).alias("referred_columns"),
    )
    return catalog.zip_foreign_keys(fks).select(*K, "constraint_name", "pos", "column_name", "referred_column")


@register("columns_into_tables", f"""WITH {INFO_SQL}
SELECT c.table_catalog, c.table_schema, c.table_name,
  string_agg(c.column_name || ':' || c.data_type, ';' ORDER BY c.ordinal_position, c.column_name) AS columns
FROM c JOIN cat USING (table_catalog, table_schema, table_name) WHERE cat.s_suppkey % 4 <> 3 GROUP BY ALL""")
def columns_into_tables(spark, sf_dir):
    """J-3 + O-1: columns nested into known tables (inner), in ordinal order."""
    t = info_tables(spark, sf_dir)
    cols = info_columns(spark, sf_dir, t)
    known = t.filter(F.col("s_suppkey") % 4 != 3)
    out = catalog.columns_into_tables(known, cols)
    return out.select(*K, F.array_join(F.transform("columns", lambda c: F.concat(c["column_name"], F.lit(":"), c["data_type"])), ";").alias("columns"))


@register("key_flags", f"""WITH {INFO_SQL},
k AS (SELECT table_catalog, table_schema, table_name, 'c1' AS column_name, 'PRIMARY KEY' AS constraint_type FROM cat
      UNION ALL SELECT table_catalog, table_schema, table_name, 'C1', 'UNIQUE' FROM cat WHERE s_suppkey % 2 = 0
      UNION ALL SELECT table_catalog, table_schema, table_name, 'c2', 'UNIQUE' FROM cat WHERE s_suppkey % 3 = 0
      UNION ALL SELECT table_catalog, table_schema, table_name, 'c2', 'UNIQUE' FROM cat WHERE s_suppkey % 3 = 0),
kf AS (SELECT table_catalog, table_schema, table_name, lower(column_name) AS col,
          bool_or(constraint_type = 'PRIMARY KEY') AS is_primary_key, bool_or(constraint_type IN ('UNIQUE', 'PRIMARY KEY')) AS is_unique
       FROM k GROUP BY ALL)
SELECT c.table_catalog, c.table_schema, c.table_name, c.column_name,
  coalesce(kf.is_primary_key, FALSE) AS is_primary_key, coalesce(kf.is_unique, FALSE) AS is_unique
FROM c LEFT JOIN kf ON c.table_catalog = kf.table_catalog AND c.table_schema = kf.table_schema AND c.table_name = kf.table_name
  AND lower(c.column_name) = kf.col""")
def key_flags(spark, sf_dir):
    """J-5 / J-7: primary / unique keys folded onto columns (duplicates OR-ed)."""
    t = info_tables(spark, sf_dir)
    cols = info_columns(spark, sf_dir, t).select(*K, "column_name")
    pk = t.select(*K, F.lit("c1").alias("column_name"), F.lit("PRIMARY KEY").alias("constraint_type"))
    uk1 = t.filter(F.col("s_suppkey") % 2 == 0).select(*K, F.lit("C1").alias("column_name"), F.lit("UNIQUE").alias("constraint_type"))
    uk2 = t.filter(F.col("s_suppkey") % 3 == 0).select(*K, F.lit("c2").alias("column_name"), F.lit("UNIQUE").alias("constraint_type"))
    return catalog.key_flags(cols, pk.unionByName(uk1).unionByName(uk2).unionByName(uk2))


@register("overlay_stats", f"""WITH {INFO_SQL},
st AS (SELECT l_suppkey, count(*) AS row_count FROM lineitem GROUP BY l_suppkey)
SELECT cat.table_catalog, cat.table_schema, cat.table_name,
  coalesce(CASE WHEN cat.s_suppkey % 3 = 0 THEN 'refreshed ' || CAST(cat.s_suppkey AS VARCHAR) END, cat.comment) AS comment,
  CAST(st.row_count AS BIGINT) AS row_count
FROM cat LEFT JOIN st ON cat.s_suppkey = st.l_suppkey""")
def overlay_stats(spark, sf_dir):
    """J-8: later facts (row counts, refreshed comments) overlaid by key."""
    t = info_tables(spark, sf_dir)
    stats = read_table(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("row_count"))
    extra = t.join(stats, t.s_suppkey == stats.l_suppkey, "left").select(
        *K, "row_count",
        F.when(F.col("s_suppkey") % 3 == 0, F.concat(F.lit("refreshed "), F.col("s_suppkey").cast("string"))).alias("comment"))
    out = catalog.overlay(t.select(*K, "comment"), extra, K, ["comment", "row_count"])
    return out.select(*K, "comment", "row_count")


MATERIALIZATION = {"MANAGED": "TABLE", "EXTERNAL": "EXTERNAL", "VIEW": "VIEW", "MATERIALIZED_VIEW": "MATERIALIZED_VIEW",
                   "STREAMING_TABLE": "STREAM"}


@register("dataset_entities", f"""WITH {INFO_SQL}
SELECT table_catalog, table_schema, table_name,
  table_catalog || '.' || table_schema || '.' || table_name AS name,
  'DATASET~' || upper(md5('{{"name":' || to_json(table_catalog || '.' || table_schema || '.' || table_name) || ',"platform":"UNITY_CATALOG"}}')) AS entity_id,
  CASE table_type WHEN 'MANAGED' THEN 'TABLE' WHEN 'EXTERNAL' THEN 'EXTERNAL' WHEN 'VIEW' THEN 'VIEW' ELSE 'UNKNOWN' END AS materialization,
  'https://example.cloud/explore/data/' || table_catalog || '/' || table_schema || '/' || table_name AS url
FROM cat""")
def dataset_entities(spark, sf_dir):
    """R-1 / R-2 / F-19: catalog rows -> dataset entities (id, structure,
    materialisation via an enum map, source url)."""
    t = info_tables(spark, sf_dir)
    name = names.dotted_name(*K)
    return t.select(
        *K, name.alias("name"),
        names.dataset_id(name, F.lit("UNITY_CATALOG")).alias("entity_id"),
        catalog.map_values("table_type", MATERIALIZATION, "UNKNOWN").alias("materialization"),
        F.concat_ws("/", F.lit("https://example.cloud/explore/data"), *K).alias("url"),
    )


@register("tables_union_views", f"""WITH {INFO_SQL}
SELECT table_catalog, table_schema, table_name FROM cat WHERE table_type <> 'VIEW'
UNION SELECT table_catalog, table_schema, table_name FROM v
UNION SELECT table_catalog, table_schema, table_name FROM cat WHERE s_suppkey % 8 = 0""")
def tables_union_views(spark, sf_dir):
    """U-1: tables UNION views (UNION external), duplicates removed."""
    t = info_tables(spark, sf_dir)
    return catalog.union_distinct(
        t.filter(F.col("table_type") != "VIEW").select(*K), info_views(t).select(*K),
        t.filter(F.col("s_suppkey") % 8 == 0).select(*K))


@register("ddl_union_all", f"""WITH {INFO_SQL}
SELECT table_catalog, table_schema, table_name, 'CREATE TABLE ' || table_name AS ddl FROM cat WHERE table_type <> 'VIEW'
UNION ALL SELECT table_catalog, table_schema, table_name, 'CREATE VIEW ' || table_name || ' AS ' || view_definition FROM v
UNION ALL SELECT table_catalog, table_schema, table_name, 'CREATE MATERIALIZED VIEW ' || table_name FROM cat WHERE s_suppkey % 4 = 1""")
def ddl_union_all(spark, sf_dir):
    """U-2: DDL texts of tables, views and materialised views (UNION ALL)."""
    t = info_tables(spark, sf_dir)
    v = info_views(t)
    return catalog.union_all(
        t.filter(F.col("table_type") != "VIEW").select(*K, F.concat(F.lit("CREATE TABLE "), F.col("table_name")).alias("ddl")),
        v.select(*K, F.concat(F.lit("CREATE VIEW "), F.col("table_name"), F.lit(" AS "), F.col("view_definition")).alias("ddl")),
        t.filter(F.col("s_suppkey") % 4 == 1).select(*K, F.concat(F.lit("CREATE MATERIALIZED VIEW "), F.col("table_name")).alias("ddl")),
    )


@register("tables_minus_views", f"""WITH {INFO_SQL}
SELECT table_catalog, table_schema, table_name FROM cat
WHERE (table_catalog, table_schema, table_name) NOT IN (SELECT table_catalog, table_schema, table_name FROM v)
  AND s_suppkey % 4 <> 1""")
def tables_minus_views(spark, sf_dir):
    """U-3: tables minus views minus materialised views (anti joins)."""
    t = info_tables(spark, sf_dir)
    mv = t.filter(F.col("s_suppkey") % 4 == 1).select(*K)
    return catalog.minus(t.select(*K), info_views(t), mv, keys=K)


@register("hierarchy_rows", f"""WITH {INFO_SQL}
SELECT table_catalog, table_schema,
  'HIERARCHY~' || upper(md5('{{"path":' || to_json(list_value(table_catalog, table_schema)) || '}}')) AS hierarchy_id,
  CAST(count(*) AS BIGINT) AS table_count, min(owner) AS owner,
  arg_max_null(comment, table_name) AS latest_comment
FROM cat GROUP BY table_catalog, table_schema""")
def hierarchy_rows(spark, sf_dir):
    """R-9: schema hierarchy rows: id from the path, owner, count, and the
    comment of the greatest table name (max_by)."""
    t = info_tables(spark, sf_dir)
    return t.groupBy("table_catalog", "table_schema").agg(
        F.count(F.lit(1)).alias("table_count"), F.min("owner").alias("owner"),
        F.max_by("comment", "table_name").alias("latest_comment"),
    ).withColumn("hierarchy_id", names.hierarchy_id(F.array("table_catalog", "table_schema")))


@register("constraint_columns", f"""WITH {INFO_SQL}
SELECT table_catalog, table_schema, table_name, string_agg(column_name, ',' ORDER BY ordinal_position DESC) AS columns
FROM c GROUP BY ALL""")
def constraint_columns(spark, sf_dir):
    """A-13: columns of a constraint concatenated in key position order
    (position = reverse ordinal here, to show the order is the key's own)."""
    t = info_tables(spark, sf_dir)
    cols = info_columns(spark, sf_dir, t).withColumn("position", -F.col("ordinal_position"))
    return catalog.concat_constraint_columns(cols, K)


@register("fields_per_table", f"""WITH {INFO_SQL}
SELECT table_catalog, table_schema, table_name, CAST(count(*) AS BIGINT) AS n_fields,
  string_agg(column_name, ',' ORDER BY ordinal_position) AS fields
FROM c GROUP BY ALL""")
def fields_per_table(spark, sf_dir):
    """A-19: fields grouped under their table, one row per table."""
    t = info_tables(spark, sf_dir)
    out = catalog.fields_per_table(info_columns(spark, sf_dir, t), K)
    return out.select(*K, F.size("fields").cast("long").alias("n_fields"),
                      F.array_join(F.transform("fields", lambda f: f["column_name"]), ",").alias("fields"))
