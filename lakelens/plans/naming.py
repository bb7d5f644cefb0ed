"""Name and id jobs (F-1 .. F-6, F-15, F-17, F-18, F-20, F-22 ..) on the tables.

Catalog layout used throughout: catalog/database = region, schema = nation,
table = supplier (and part names for wider lists).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from lakelens.functions import names, scalars
from lakelens.plans.registry import register
from lakelens.sources.tables import read_table


def supplier_catalog(spark, sf_dir):
    s = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    n = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = read_table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    return (
        s.join(n, s.s_nationkey == n.n_nationkey)
        .join(r, n.n_regionkey == r.r_regionkey)
        .select("s_suppkey", F.col("r_name").alias("db"), F.col("n_name").alias("schema"),
                F.col("s_name").alias("tbl"), "n_nationkey", "r_regionkey")
    )


CATALOG_SQL = """cat AS (
  SELECT s.s_suppkey, r.r_name AS db, n.n_name AS schema, s.s_name AS tbl, n.n_nationkey, r.r_regionkey
  FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey)"""


@register("entity_ids", f"""WITH {CATALOG_SQL}, x AS (
  SELECT s_suppkey, db, schema, tbl, lower(concat_ws('.', db, schema, tbl)) AS name,
         CASE WHEN s_suppkey % 2 = 1 THEN 'acct' || CAST(n_nationkey AS VARCHAR) END AS account FROM cat)
SELECT s_suppkey, name, account,
  'DATASET~' || upper(md5(CASE WHEN account IS NULL
     THEN '{{"name":' || to_json(name) || ',"platform":"SNOWFLAKE"}}'
     ELSE '{{"account":' || to_json(account) || ',"name":' || to_json(name) || ',"platform":"SNOWFLAKE"}}' END)) AS entity_id,
  'HIERARCHY~' || upper(md5('{{"path":' || to_json(list_value(lower(db), lower(schema))) || '}}')) AS hierarchy_id,
  'PERSON~' || upper(md5('{{"email":' || to_json(lower(tbl) || '@example.com') || '}}')) AS person_id
FROM x""")
def entity_ids(spark, sf_dir):
    """F-3: dataset, hierarchy and person ids (TYPE~MD5 of canonical JSON)."""
    c = supplier_catalog(spark, sf_dir)
    name = names.dotted_name("db", "schema", "tbl")
    account = F.when(F.col("s_suppkey") % 2 == 1, F.concat(F.lit("acct"), F.col("n_nationkey").cast("string")))
    return c.select(
        "s_suppkey",
        name.alias("name"),
        account.alias("account"),
        names.dataset_id(name, F.lit("SNOWFLAKE"), account).alias("entity_id"),
        names.hierarchy_id(F.array(F.lower("db"), F.lower("schema"))).alias("hierarchy_id"),
        names.person_id(F.concat(F.lower("tbl"), F.lit("@example.com"))).alias("person_id"),
    )


@register("normalized_names", f"""WITH {CATALOG_SQL}
SELECT s_suppkey,
  lower(replace(replace(concat_ws('.', CASE WHEN s_suppkey % 5 = 0 THEN NULL ELSE '"' || db || '"' END,
                                     CASE WHEN s_suppkey % 3 = 0 THEN NULL ELSE '`' || schema || '`' END, tbl), '`', ''), '"', '')) AS normalized_name,
  '"' || replace(db, '"', '""') || '"."' || replace(replace(tbl, '#', '"'), '"', '""') || '"' AS quoted
FROM cat""")
def normalized_names(spark, sf_dir):
    """F-1/F-2 (null-skipping dotted names, quotes dropped) and F-15 quoting."""
    c = supplier_catalog(spark, sf_dir)
    db = F.when(F.col("s_suppkey") % 5 != 0, F.concat(F.lit('"'), F.col("db"), F.lit('"')))
    schema = F.when(F.col("s_suppkey") % 3 != 0, F.concat(F.lit("`"), F.col("schema"), F.lit("`")))
    return c.select(
        "s_suppkey",
        names.dotted_name(db, schema, F.col("tbl")).alias("normalized_name"),
        names.quote_identifier(F.col("db"), F.replace(F.col("tbl"), F.lit("#"), F.lit('"'))).alias("quoted"),
    )


@register("field_paths", """SELECT p_partkey,
  lower(p_type) || '.' || replace(replace(replace(lower(p_name || '.' || CAST(p_size AS VARCHAR) || '<' || p_brand || '>'), '.', '%2E'), '<', '%3C'), '>', '%3E') AS field_path,
  replace(replace(replace(lower(p_name || '.' || CAST(p_size AS VARCHAR) || '<' || p_brand || '>'), '.', '%2E'), '<', '%3C'), '>', '%3E') AS top_path
FROM part""")
def field_paths(spark, sf_dir):
    """F-4: nested field paths with '.', '<', '>' percent-encoded, lower-case."""
    p = read_table(spark, sf_dir, "part")
    raw = F.concat(F.col("p_name"), F.lit("."), F.col("p_size").cast("string"), F.lit("<"), F.col("p_brand"), F.lit(">"))
    return p.select(
        "p_partkey",
        names.field_path(raw, parent=F.lower("p_type")).alias("field_path"),
        names.field_path(raw).alias("top_path"),
    )


@register("account_normalize", """SELECT c_custkey,
  CASE WHEN c_custkey % 4 = 0 THEN lower(c_name) || '.us-west-2.privatelink.snowflakecomputing.com'
       WHEN c_custkey % 4 = 1 THEN upper(c_name) || '.eu-west-1.snowflakecomputing.com'
       WHEN c_custkey % 4 = 2 THEN c_name || '.us-west-2'
       ELSE c_name END AS host,
  regexp_replace(regexp_replace(regexp_replace(lower(CASE WHEN c_custkey % 4 = 0 THEN lower(c_name) || '.us-west-2.privatelink.snowflakecomputing.com'
       WHEN c_custkey % 4 = 1 THEN upper(c_name) || '.eu-west-1.snowflakecomputing.com'
       WHEN c_custkey % 4 = 2 THEN c_name || '.us-west-2'
       ELSE c_name END), '\\.snowflakecomputing\\.com$', ''), '\\.privatelink$', ''), '\\.us-west-2$', '') AS account
FROM customer""")
def account_normalize(spark, sf_dir):
    """F-5: warehouse account host normalisation (default region removed)."""
    c = read_table(spark, sf_dir, "customer")
    k = F.col("c_custkey") % 4
    host = (F.when(k == 0, F.concat(F.lower("c_name"), F.lit(".us-west-2.privatelink.snowflakecomputing.com")))
            .when(k == 1, F.concat(F.upper("c_name"), F.lit(".eu-west-1.snowflakecomputing.com")))
            .when(k == 2, F.concat(F.col("c_name"), F.lit(".us-west-2")))
            .otherwise(F.col("c_name")))
    return c.select("c_custkey", host.alias("host"), names.normalize_warehouse_account(host, True).alias("account"))


@register("resource_names", r"""WITH r AS (
  SELECT o_orderkey,
    CASE WHEN o_orderkey % 5 = 0 THEN 'projects/p' || CAST(o_custkey AS VARCHAR) || '/datasets/d' || o_orderpriority[1:1] || '/tables/t' || o_orderstatus || '_' || strftime(o_orderdate, '%Y%m%d')
         WHEN o_orderkey % 5 = 1 THEN 'projects/p' || CAST(o_custkey AS VARCHAR) || '/datasets/d/tables/t$' || strftime(o_orderdate, '%Y%m')
         WHEN o_orderkey % 5 = 2 THEN 'projects/p/datasets/d/tables/snap@' || CAST(1700000000000 + o_orderkey AS VARCHAR)
         WHEN o_orderkey % 5 = 3 THEN 'projects/p/datasets/d/tables/bad$name'
         ELSE 'projects/p/other/d/tables/t' END AS res FROM orders),
s AS (SELECT o_orderkey, res, string_split(res, '/') AS parts FROM r),
t AS (SELECT o_orderkey, res, parts,
  CASE WHEN regexp_matches(parts[6], '^(.+)[$_](\d{4}|\d{6}|\d{8}|\d{10}|__PARTITIONS_SUMMARY__)$')
       THEN regexp_extract(parts[6], '^(.+)[$_](\d{4}|\d{6}|\d{8}|\d{10}|__PARTITIONS_SUMMARY__)$', 1) ELSE parts[6] END AS t1 FROM s),
u AS (SELECT o_orderkey, res, parts,
  CASE WHEN regexp_matches(t1, '^(.+)@(\d{13})$') THEN regexp_extract(t1, '^(.+)@(\d{13})$', 1) ELSE t1 END AS t2 FROM t)
SELECT o_orderkey, res,
  CASE WHEN len(parts) = 6 AND parts[1] = 'projects' AND parts[3] = 'datasets' AND parts[5] = 'tables'
        AND NOT contains(t2, '$') AND NOT contains(t2, '@') THEN parts[2] || '.' || parts[4] || '.' || t2 END AS table_name
FROM u""")
def resource_names(spark, sf_dir):
    """F-17: audit-log resource names -> table names with partition, shard and
    snapshot suffixes removed; malformed or still-invalid names -> null."""
    o = read_table(spark, sf_dir, "orders")
    k = F.col("o_orderkey") % 5
    cust = F.col("o_custkey").cast("string")
    res = (
        F.when(k == 0, F.concat(F.lit("projects/p"), cust, F.lit("/datasets/d"), F.substring("o_orderpriority", 1, 1),
                                F.lit("/tables/t"), F.col("o_orderstatus"), F.lit("_"), F.date_format("o_orderdate", "yyyyMMdd")))
        .when(k == 1, F.concat(F.lit("projects/p"), cust, F.lit("/datasets/d/tables/t$"), F.date_format("o_orderdate", "yyyyMM")))
        .when(k == 2, F.concat(F.lit("projects/p/datasets/d/tables/snap@"), (F.lit(1700000000000) + F.col("o_orderkey")).cast("string")))
        .when(k == 3, F.lit("projects/p/datasets/d/tables/bad$name"))
        .otherwise(F.lit("projects/p/other/d/tables/t"))
    )
    parts = names.resource_table_parts(F.col("res"))
    return o.select("o_orderkey", res.alias("res")).select(
        "o_orderkey", "res",
        F.when(parts.isNotNull(), F.concat_ws(".", parts["project"], parts["dataset"], parts["table"])).alias("table_name"))


@register("scalar_helpers", r"""SELECT event_id,
  CASE WHEN user_id % 3 = 0 THEN NULL ELSE 'user' || CAST(user_id AS VARCHAR) || CASE WHEN user_id % 2 = 0 THEN '@corp.example.com' ELSE '' END END AS login,
  CASE WHEN user_id % 3 <> 0 AND user_id % 2 = 0 THEN NULL WHEN user_id % 3 = 0 THEN NULL ELSE 'user' || CAST(user_id AS VARCHAR) END AS user_name,
  CASE WHEN user_id % 3 <> 0 AND user_id % 2 = 0 THEN 'user' || CAST(user_id AS VARCHAR) || '@corp.example.com' END AS email,
  round(round(CAST(value AS DOUBLE) * 1000.0 / 1000.0, 10), 6) AS seconds,
  CAST(round(value) AS BIGINT) AS rounded_value,
  CASE WHEN value > 10 THEN value ELSE 0 END AS big_value,
  coalesce(nullif(CASE WHEN value > 10 THEN value ELSE 0 END, 0), value) AS big_or_value,
  CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
  strftime(ts, '%-m/%-d/%Y %-I:%M:%S %p') AS us_text,
  strftime(ts, '%Y-%m-%dT%H:%M:%S') || 'Z' AS iso_text,
  date_trunc('second', ts) AS parsed_us,
  date_trunc('second', ts) AS parsed_iso,
  round(round(CAST(epoch_us(ts) AS DOUBLE) / 1e6 - CAST(epoch_us(date_trunc('day', ts)) AS DOUBLE) / 1e6, 10), 6) AS seconds_into_day
FROM events""")
def scalar_helpers(spark, sf_dir):
    """F-7 .. F-12, F-21, F-22 over the event log: e-mail split, safe casts,
    US and ISO date text parsing, seconds between timestamps, ``a or b``."""
    e = read_table(spark, sf_dir, "events")
    login = F.when(F.col("user_id") % 3 != 0, F.concat(
        F.lit("user"), F.col("user_id").cast("string"),
        F.when(F.col("user_id") % 2 == 0, F.lit("@corp.example.com")).otherwise(F.lit(""))))
    split = scalars.user_id_or_email(login)
    us_text = F.date_format("ts", "M/d/yyyy h:mm:ss a")
    iso_text = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z"))
    big = F.when(F.col("value") > 10, F.col("value")).otherwise(F.lit(0.0))
    return e.select(
        "event_id",
        login.alias("login"),
        split["user_id"].alias("user_name"),
        split["email"].alias("email"),
        F.round(F.round(scalars.safe_double(F.col("value") * 1000.0) / 1000.0, 10), 6).alias("seconds"),
        scalars.safe_long(F.round("value")).alias("rounded_value"),
        big.alias("big_value"),
        scalars.first_non_zero(big, F.col("value")).alias("big_or_value"),
        F.get_json_object("props", "$.k").cast("long").alias("k"),
        us_text.alias("us_text"),
        iso_text.alias("iso_text"),
        scalars.parse_us_datetime(us_text).cast("timestamp_ntz").alias("parsed_us"),
        scalars.parse_iso8601(iso_text).cast("timestamp_ntz").alias("parsed_iso"),
        F.round(F.round(scalars.seconds_between(F.date_trunc("day", F.col("ts").cast("timestamp")), F.col("ts")), 10), 6)
        .alias("seconds_into_day"),
    )
