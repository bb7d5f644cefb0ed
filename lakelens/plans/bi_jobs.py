"""Governance / BI / ETL / artifact jobs over landed rows derived from the tables
(M-2 .. M-8, M-10, J-10, J-11, J-13, J-15 .. J-17, R-5, G-7, S-16, S-17, N-8,
P-15, A-17, A-20)."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakelens.functions import names
from lakelens.operators import governance as gov
from lakelens.plans.naming import supplier_catalog
from lakelens.plans.registry import register
from lakelens.sources.tables import read_table


@register("activity_rows", """SELECT event_id, CASE event_type WHEN 'view' THEN 'ViewDashboard' ELSE 'ViewReport' END AS activity,
  'dash_' || CAST(user_id % 20 AS VARCHAR) AS artifact_id, 'user' || CAST(user_id AS VARCHAR) || '@example.com' AS email, ts
FROM events WHERE event_type IN ('view', 'click') AND event_id % 4 <> 0 AND user_id % 10 <> 0""")
def activity_rows(spark, sf_dir):
    """R-5 / R-17: view activities with an artifact and an e-mail become user activity rows."""
    e = read_table(spark, sf_dir, "events")
    acts = e.select(
        "event_id", "ts",
        F.when(F.col("event_type") == "view", "ViewDashboard").when(F.col("event_type") == "click", "ViewReport")
        .otherwise(F.col("event_type")).alias("activity"),
        F.when(F.col("event_id") % 4 != 0, F.concat(F.lit("dash_"), (F.col("user_id") % 20).cast("string"))).alias("artifact_id"),
        F.when(F.col("user_id") % 10 != 0, F.concat(F.lit("user"), F.col("user_id").cast("string"), F.lit("@example.com"))).alias("email"))
    return gov.activity_rows(acts, ["ViewDashboard", "ViewReport"]).select("event_id", "activity", "artifact_id", "email", "ts")


@register("attribution", """SELECT conv_id * 100 + turn AS query_id,
  CASE WHEN role = 'system' THEN 'system-' || CAST(conv_id AS VARCHAR) ELSE role || CAST(conv_id AS VARCHAR) || '@example.com' END AS email,
  role <> 'system' AS valid_email FROM conversations""")
def attribution(spark, sf_dir):
    """M-8: query id -> e-mail attribution; invalid e-mails are flagged."""
    c = read_table(spark, sf_dir, "conversations")
    rows = c.select((F.col("conv_id") * 100 + F.col("turn")).alias("query_id"),
                    F.when(F.col("role") == "system", F.concat(F.lit("system-"), F.col("conv_id").cast("string")))
                    .otherwise(F.concat(F.col("role"), F.col("conv_id").cast("string"), F.lit("@example.com"))).alias("email"))
    return gov.attributions(rows)


@register("governance_assign", """WITH a AS (
  SELECT lower(s_name) AS dataset, 'owner' AS kind, 'owner' || CAST(s_nationkey AS VARCHAR) || '@corp.com' AS value, NULL AS column_name, 0 AS seq FROM supplier
  UNION ALL SELECT lower(s_name), 'owner', 'steward@corp.com', NULL, 0 FROM supplier WHERE s_suppkey % 4 = 0
  UNION ALL SELECT lower(s_name), 'tag', 'tier_' || CAST(s_suppkey % 3 AS VARCHAR), NULL, 0 FROM supplier
  UNION ALL SELECT lower(s_name), 'column_tag', 'pii', 'C1', 0 FROM supplier WHERE s_suppkey % 2 = 0
  UNION ALL SELECT lower(s_name), 'description', 'first ' || CAST(s_suppkey AS VARCHAR), NULL, 1 FROM supplier
  UNION ALL SELECT lower(s_name), 'description', 'second ' || CAST(s_suppkey AS VARCHAR), NULL, 2 FROM supplier WHERE s_suppkey % 3 = 0)
SELECT dataset,
  (SELECT string_agg(x, ',' ORDER BY x) FROM (SELECT DISTINCT 'PERSON~' || upper(md5('{"email":' || to_json(lower(a2.value)) || '}')) AS x
     FROM a a2 WHERE a2.dataset = d.dataset AND a2.kind = 'owner')) AS owners,
  (SELECT string_agg(DISTINCT value, ',' ORDER BY value) FROM a a3 WHERE a3.dataset = d.dataset AND a3.kind = 'tag') AS tags,
  (SELECT string_agg(DISTINCT lower(column_name) || ':' || value, ',') FROM a a4 WHERE a4.dataset = d.dataset AND a4.kind = 'column_tag') AS column_tags,
  (SELECT arg_max(value, seq) FROM a a5 WHERE a5.dataset = d.dataset AND a5.kind = 'description') AS description
FROM (SELECT DISTINCT dataset FROM a) d""")
def governance_assign(spark, sf_dir):
    """M-2: ownership, tags, column tags and (latest) description per dataset."""
    s = read_table(spark, sf_dir, "supplier")
    ds = F.lower("s_name")

    def rows(df, kind, value, column=None, seq=0):
        return df.select(ds.alias("dataset"), F.lit(kind).alias("kind"), value.alias("value"),
                         (F.lit(column) if column else F.lit(None).cast("string")).alias("column_name"), F.lit(seq).alias("seq"))
    a = rows(s, "owner", F.concat(F.lit("owner"), F.col("s_nationkey").cast("string"), F.lit("@corp.com"))) \
        .unionByName(rows(s.filter(F.col("s_suppkey") % 4 == 0), "owner", F.lit("steward@corp.com"))) \
        .unionByName(rows(s, "tag", F.concat(F.lit("tier_"), (F.col("s_suppkey") % 3).cast("string")))) \
        .unionByName(rows(s.filter(F.col("s_suppkey") % 2 == 0), "column_tag", F.lit("pii"), "C1")) \
        .unionByName(rows(s, "description", F.concat(F.lit("first "), F.col("s_suppkey").cast("string")), seq=1)) \
        .unionByName(rows(s.filter(F.col("s_suppkey") % 3 == 0), "description",
                          F.concat(F.lit("second "), F.col("s_suppkey").cast("string")), seq=2))
    g = gov.governance_rows(a)
    return g.select("dataset", F.array_join("owners", ",").alias("owners"), F.array_join("tags", ",").alias("tags"),
                    F.array_join("column_tags", ",").alias("column_tags"), "description")


def _monitors(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders")
    m1 = F.concat(F.lit("MCON++a++b++table++DB"), (F.col("o_custkey") % 4).cast("string"), F.lit(":sch.tbl_"),
                  (F.col("o_orderkey") % 9).cast("string"))
    m2 = F.concat(F.lit("MCON++a++b++table++DB"), ((F.col("o_custkey") + 1) % 4).cast("string"), F.lit(":sch.view_"),
                  (F.col("o_orderkey") % 5).cast("string"))
    return o.select(F.col("o_orderkey").alias("monitor_id"),
                    F.when(F.col("o_orderkey") % 2 == 0, F.array(m1, m2)).otherwise(F.array(m1)).alias("mcons"),
                    F.when(F.col("o_orderstatus") == "F", "pass").when(F.col("o_orderstatus") == "O", "FAIL")
                    .otherwise("weird").alias("status"),
                    F.concat(F.lit("sev-"), F.substring("o_orderpriority", 1, 1)).alias("severity"))


@register("external_monitors", """WITH m AS (
  SELECT o_orderkey AS monitor_id, 'db' || CAST(o_custkey % 4 AS VARCHAR) || '.sch.tbl_' || CAST(o_orderkey % 9 AS VARCHAR) AS dataset_name,
         o_orderstatus, o_orderpriority FROM orders
  UNION ALL SELECT o_orderkey, 'db' || CAST((o_custkey + 1) % 4 AS VARCHAR) || '.sch.view_' || CAST(o_orderkey % 5 AS VARCHAR),
         o_orderstatus, o_orderpriority FROM orders WHERE o_orderkey % 2 = 0),
w(db, platform) AS (VALUES ('db0', 'SNOWFLAKE'), ('db1', 'BIGQUERY'), ('db2', 'REDSHIFT'))
SELECT m.monitor_id, m.dataset_name, w.platform,
  'DATASET~' || upper(md5('{"name":' || to_json(m.dataset_name) || ',"platform":' || to_json(w.platform) || '}')) AS entity_id,
  CASE o_orderstatus WHEN 'F' THEN 'PASSED' WHEN 'O' THEN 'ERROR' ELSE 'UNKNOWN' END AS status,
  CASE o_orderpriority[1:1] WHEN '1' THEN 'HIGH' WHEN '2' THEN 'MEDIUM' WHEN '3' THEN 'LOW' WHEN '4' THEN 'LOW' ELSE 'UNKNOWN' END AS severity
FROM m JOIN w ON split_part(m.dataset_name, '.', 1) = w.db""")
def external_monitors(spark, sf_dir):
    """J-15 / M-4 / F-18: external monitors mapped to datasets of known warehouses."""
    wh = spark.createDataFrame([("db0", "SNOWFLAKE"), ("db1", "BIGQUERY"), ("db2", "REDSHIFT")], "database string, platform string")
    return gov.external_monitors(_monitors(spark, sf_dir), wh)


@register("monitors_per_dataset", """WITH m AS (SELECT DISTINCT 'ds' || CAST(o_custkey % 40 AS VARCHAR) AS dataset, o_orderpriority AS title, o_orderstatus AS status FROM orders),
r AS (SELECT *, CAST((row_number() OVER (PARTITION BY dataset ORDER BY title, status) - 1) // 4 AS INTEGER) AS chunk_no FROM m)
SELECT dataset, chunk_no, CAST(count(*) AS INTEGER) AS n_monitors, string_agg(title || ':' || status, ',' ORDER BY title, status) AS monitors FROM r GROUP BY dataset, chunk_no""")
def monitors_per_dataset(spark, sf_dir):
    """A-17 / M-3: declared monitors per dataset, de-duplicated, in lists of at most four."""
    o = read_table(spark, sf_dir, "orders").select(
        F.concat(F.lit("ds"), (F.col("o_custkey") % 40).cast("string")).alias("dataset"),
        F.col("o_orderpriority").alias("title"), F.col("o_orderstatus").alias("status"))
    m = gov.monitors_per_dataset(o, "dataset", size=4)
    return m.select("dataset", "chunk_no", F.size("monitors").alias("n_monitors"),
                    F.array_join(F.transform("monitors", lambda x: F.concat(x["title"], F.lit(":"), x["status"])), ",").alias("monitors"))


def _manifests(spark, sf_dir):
    p = read_table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    uid = F.concat(F.lit("model.proj.m"), k.cast("string"))
    mat = (F.when(k % 5 == 0, "table").when(k % 5 == 1, "view").when(k % 5 == 2, "incremental")
           .when(k % 5 == 3, "ephemeral").otherwise("custom"))
    code = F.concat(F.lit("select * from "), F.col("p_name"))
    deps = F.filter(F.array(F.when(k > 0, F.concat(F.lit("model.proj.m"), F.floor(k / 2).cast("string"))),
                            F.concat(F.lit("source.proj.s"), (k % 10).cast("string")), F.lit("macro.proj.x")),
                    lambda d: d.isNotNull())
    cols = F.map_from_entries(F.transform(F.sequence(F.lit(1), k % 4 + 1), lambda i: F.struct(
        F.concat(F.lit("c"), i.cast("string")), F.struct(F.concat(F.lit("c"), i.cast("string")).alias("name"),
                                                      F.lit("d").alias("description")))))
    meta = F.when(k % 3 == 0, F.create_map(F.lit("owner"), F.lit("alice"))) \
        .when(k % 3 == 1, F.create_map(F.lit("owner"), F.lit("bob@corp.com, carol")))
    node = F.struct(F.lit("model").alias("resource_type"), F.concat(F.lit("m"), k.cast("string")).alias("name"),
                    F.when(k % 2 == 0, code).alias("raw_code"), F.when(k % 2 == 1, code).alias("raw_sql"),
                    F.struct(mat.alias("materialized")).alias("config"), F.struct(deps.alias("nodes")).alias("depends_on"),
                    cols.alias("columns"), meta.alias("meta"))
    return p.select(F.to_json(F.create_map(uid, node)).alias("nodes_json"))


@register("dbt_nodes", """SELECT 'model.proj.m' || CAST(p_partkey AS VARCHAR) AS unique_id,
  CASE p_partkey % 5 WHEN 0 THEN 'TABLE' WHEN 1 THEN 'VIEW' WHEN 2 THEN 'INCREMENTAL' WHEN 3 THEN 'EPHEMERAL' ELSE 'OTHER' END AS materialization,
  'select * from ' || p_name AS code, CAST(p_partkey % 4 + 1 AS INTEGER) AS n_columns,
  CASE WHEN p_partkey > 0 THEN 'model.proj.m' || CAST(p_partkey // 2 AS VARCHAR) ELSE '' END AS parent_models,
  'source.proj.s' || CAST(p_partkey % 10 AS VARCHAR) AS parent_sources,
  CASE p_partkey % 3 WHEN 0 THEN 'alice@example.com' WHEN 1 THEN 'bob@corp.com,carol@example.com' END AS owners
FROM part""")
def dbt_nodes(spark, sf_dir):
    """S-16 / R-7 / N-8 / N-9: manifest nodes -> rows (materialisation, code
    with the older field name as fallback, columns, parents by kind, owners)."""
    n = gov.manifest_nodes(_manifests(spark, sf_dir)).filter(gov.should_include("code", "name"))
    return n.select("unique_id", "materialization", "code", "n_columns",
                    F.array_join("parent_models", ",").alias("parent_models"),
                    F.array_join("parent_sources", ",").alias("parent_sources"),
                    F.array_join("owners", ",").alias("owners"))


@register("test_results", """SELECT 'test.proj.t' || CAST(p_partkey AS VARCHAR) AS unique_id,
  CASE WHEN p_partkey % 3 = 0 THEN 'model.proj.m' || CAST(p_partkey AS VARCHAR) ELSE 'model.proj.m' || CAST(p_partkey // 2 AS VARCHAR) END AS model,
  CASE p_partkey % 4 WHEN 0 THEN 'PASSED' WHEN 1 THEN 'ERROR' WHEN 2 THEN 'WARNING' ELSE 'UNKNOWN' END AS status,
  TIMESTAMP '2024-01-01' + to_minutes(2 * p_partkey) AS last_run
FROM part WHERE p_partkey % 3 <> 2""")
def test_results(spark, sf_dir):
    """J-11 / A-20 / M-7: data tests with their latest run status, on models only."""
    p = read_table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    tests = p.select(F.concat(F.lit("test.proj.t"), k.cast("string")).alias("unique_id"),
                     F.when(k % 3 == 0, F.concat(F.lit("model.proj.m"), k.cast("string"))).alias("attached_node"),
                     F.when(k % 3 == 1, F.array(F.concat(F.lit("model.proj.m"), F.floor(k / 2).cast("string"))))
                     .when(k % 3 == 0, F.array(F.lit("source.proj.s1")))
                     .otherwise(F.array(F.lit("source.proj.s1"))).alias("depends_on"))
    base = F.lit("2024-01-01").cast("timestamp_ntz")
    results = p.select(F.concat(F.lit("test.proj.t"), k.cast("string")).alias("unique_id"),
                       F.when(k % 4 == 0, "pass").when(k % 4 == 1, "fail").when(k % 4 == 2, "warn").otherwise("skipped").alias("status"),
                       F.array(F.struct(F.lit("compile").alias("name"), (base + F.make_dt_interval(F.lit(0), F.lit(0), k)).alias("completed_at")),
                               F.struct(F.lit("execute").alias("name"), (base + F.make_dt_interval(F.lit(0), F.lit(0), k * 2)).alias("completed_at")))
                       .alias("timing"))
    return gov.test_results(tests, results)


@register("subscriptions", """WITH s AS (SELECT DISTINCT 'sub' || CAST(l_orderkey % 50 AS VARCHAR) AS subscription_id, l_suppkey AS user_id FROM lineitem),
r AS (SELECT subscription_id, lower(su.s_name) || '@x.com' AS email,
  CAST((row_number() OVER (PARTITION BY subscription_id ORDER BY lower(su.s_name) || '@x.com', user_id) - 1) // 20 AS INTEGER) AS chunk_no
  FROM s JOIN supplier su ON s.user_id = su.s_suppkey)
SELECT subscription_id, chunk_no, string_agg(email, ',' ORDER BY email) AS emails FROM r GROUP BY subscription_id, chunk_no""")
def subscriptions(spark, sf_dir):
    """J-16: subscribers de-duplicated, joined to users, grouped per subscription in lists
    of at most twenty."""
    li = read_table(spark, sf_dir, "lineitem")
    subs = li.select(F.concat(F.lit("sub"), (F.col("l_orderkey") % 50).cast("string")).alias("subscription_id"), F.col("l_suppkey").alias("user_id"))
    users = read_table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("user_id"),
                                                         F.concat(F.lower("s_name"), F.lit("@x.com")).alias("email"))
    out = gov.distinct_subscribers(subs, users, size=20)
    return out.select("subscription_id", "chunk_no", F.array_join("emails", ",").alias("emails"))


@register("app_dashboards", """WITH d AS (SELECT 'd' || CAST(p_partkey AS VARCHAR) AS dashboard_id,
    CASE WHEN p_partkey % 5 = 0 THEN 'https://bi/groups/g/apps/a/dashboards/d' || CAST(p_partkey // 5 AS VARCHAR)
         ELSE 'https://bi/groups/g/dashboards/d' || CAST(p_partkey AS VARCHAR) END AS url FROM part),
app AS (SELECT regexp_extract(url, '/dashboards/([^/?]+)', 1) AS orig_id, dashboard_id AS app_id FROM d WHERE contains(url, '/apps/'))
SELECT d.dashboard_id, d.url, app.app_id FROM d LEFT JOIN app ON d.dashboard_id = app.orig_id
WHERE d.dashboard_id NOT IN (SELECT app_id FROM app)""")
def app_dashboards(spark, sf_dir):
    """J-17: app-version dashboards folded into their originals."""
    p = read_table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    d = p.select(F.concat(F.lit("d"), k.cast("string")).alias("dashboard_id"),
                 F.when(k % 5 == 0, F.concat(F.lit("https://bi/groups/g/apps/a/dashboards/d"), F.floor(k / 5).cast("string")))
                 .otherwise(F.concat(F.lit("https://bi/groups/g/dashboards/d"), k.cast("string"))).alias("url"))
    return gov.fold_app_dashboards(d).select("dashboard_id", "url", "app_id")


@register("topic_subjects", """WITH t AS (SELECT 't' || CAST(p_partkey AS VARCHAR) AS topic, 'rec' || CAST(p_partkey % 30 AS VARCHAR) AS record FROM part),
s AS (SELECT DISTINCT subject FROM (
  SELECT 't' || CAST(p_partkey AS VARCHAR) || '-value' AS subject FROM part WHERE p_partkey % 3 = 0
  UNION ALL SELECT 'rec' || CAST(p_partkey % 30 AS VARCHAR) FROM part WHERE p_partkey % 3 = 1
  UNION ALL SELECT 't' || CAST(p_partkey AS VARCHAR) || '-rec' || CAST(p_partkey % 30 AS VARCHAR) || '-key' FROM part WHERE p_partkey % 3 = 2))
SELECT topic, subject, 'topic' AS strategy FROM t JOIN s ON s.subject IN (t.topic || '-key', t.topic || '-value')
UNION ALL SELECT topic, subject, 'record' FROM t JOIN s ON s.subject = t.record
UNION ALL SELECT topic, subject, 'topic_record' FROM t JOIN s ON s.subject IN (t.topic || '-' || t.record || '-key', t.topic || '-' || t.record || '-value')""")
def topic_subjects(spark, sf_dir):
    """J-13 / S-18: topics resolved to schema subjects under each naming strategy."""
    p = read_table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    topics = p.select(F.concat(F.lit("t"), k.cast("string")).alias("topic"), F.concat(F.lit("rec"), (k % 30).cast("string")).alias("record"))
    subjects = p.select(F.when(k % 3 == 0, F.concat(F.lit("t"), k.cast("string"), F.lit("-value")))
                        .when(k % 3 == 1, F.concat(F.lit("rec"), (k % 30).cast("string")))
                        .otherwise(F.concat(F.lit("t"), k.cast("string"), F.lit("-rec"), (k % 30).cast("string"), F.lit("-key")))
                        .alias("subject")).distinct()
    out = None
    for strat in ("topic", "record", "topic_record"):
        x = gov.topic_subjects(topics, subjects, strat).select("topic", "subject", F.lit(strat).alias("strategy"))
        out = x if out is None else out.unionByName(x)
    return out


@register("openapi_endpoints", """SELECT 'https://api.example.com/v1/parts/' || CAST(p_partkey AS VARCHAR) AS endpoint, 'GET' AS method,
  'get ' || p_name AS summary, p_brand AS tags FROM part
UNION ALL SELECT 'https://api.example.com/v1/parts/' || CAST(p_partkey AS VARCHAR), 'POST', 'update ' || p_name, p_brand || ',' || p_type
FROM part WHERE p_partkey % 2 = 0""")
def openapi_endpoints(spark, sf_dir):
    """S-17 / R-10 / F-19: API specs -> endpoints and methods (non-methods such as 'parameters' skipped)."""
    p = read_table(spark, sf_dir, "part")
    path = F.concat(F.lit("/parts/"), F.col("p_partkey").cast("string"))
    ops = F.map_from_arrays(
        F.when(F.col("p_partkey") % 2 == 0, F.array(F.lit("get"), F.lit("post"), F.lit("parameters")))
        .otherwise(F.array(F.lit("get"), F.lit("parameters"))),
        F.when(F.col("p_partkey") % 2 == 0, F.array(
            F.struct(F.concat(F.lit("get "), F.col("p_name")).alias("summary"), F.array("p_brand").alias("tags")),
            F.struct(F.concat(F.lit("update "), F.col("p_name")).alias("summary"), F.array("p_brand", "p_type").alias("tags")),
            F.struct(F.lit(None).cast("string").alias("summary"), F.lit(None).cast("array<string>").alias("tags"))))
        .otherwise(F.array(
            F.struct(F.concat(F.lit("get "), F.col("p_name")).alias("summary"), F.array("p_brand").alias("tags")),
            F.struct(F.lit(None).cast("string").alias("summary"), F.lit(None).cast("array<string>").alias("tags")))))
    specs = p.select(F.to_json(F.create_map(path, ops)).alias("paths_json"))
    out = gov.openapi_endpoints(specs, "https://api.example.com/v1")
    return out.select("endpoint", "method", "summary", F.array_join("tags", ",").alias("tags"))


@register("extends_chain", """WITH RECURSIVE v AS (SELECT 'v' || CAST(p_partkey AS VARCHAR) AS view,
    CASE WHEN p_partkey > 0 THEN 'v' || CAST(p_partkey // 3 AS VARCHAR) END AS parent FROM part),
props AS (SELECT 'v' || CAST(p_partkey AS VARCHAR) AS view, 'sql_table_name' AS key, 'tbl' || CAST(p_partkey AS VARCHAR) AS value FROM part WHERE p_partkey % 4 = 0
  UNION ALL SELECT 'v' || CAST(p_partkey AS VARCHAR), 'label', 'L' || CAST(p_partkey AS VARCHAR) FROM part WHERE p_partkey % 5 = 0),
walk(node, anc, dist, nxt) AS (SELECT view, view, 0, parent FROM v
  UNION ALL SELECT w.node, v.view, w.dist + 1, v.parent FROM walk w JOIN v ON v.view = w.nxt)
SELECT w.node AS view, p.key, arg_min(p.value, w.dist) AS value FROM walk w JOIN props p ON p.view = w.anc GROUP BY w.node, p.key""")
def extends_chain(spark, sf_dir):
    """G-7: view properties inherited along 'extends' chains (nearest wins)."""
    p = read_table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    views = p.select(F.concat(F.lit("v"), k.cast("string")).alias("view"),
                     F.when(k > 0, F.concat(F.lit("v"), F.floor(k / 3).cast("string"))).alias("extends"))
    props = p.filter(k % 4 == 0).select(F.concat(F.lit("v"), k.cast("string")).alias("view"), F.lit("sql_table_name").alias("key"),
                                        F.concat(F.lit("tbl"), k.cast("string")).alias("value")) \
        .unionByName(p.filter(k % 5 == 0).select(F.concat(F.lit("v"), k.cast("string")).alias("view"), F.lit("label").alias("key"),
                                                 F.concat(F.lit("L"), k.cast("string")).alias("value")))
    return gov.extends_chain(views, props)


@register("user_display", """SELECT o.o_orderkey, coalesce(CASE WHEN c.c_custkey % 2 = 0 THEN c.c_name END,
    CASE WHEN c.c_custkey % 3 = 0 THEN lower(c.c_name) || '@x.com' END, CAST(o.o_custkey AS VARCHAR)) AS display_name
FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey""")
def user_display(spark, sf_dir):
    """J-10: user ids resolved to display names, then e-mails, else the id."""
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("user_id"))
    c = read_table(spark, sf_dir, "customer")
    users = c.select(F.col("c_custkey").alias("user_id"),
                     F.when(F.col("c_custkey") % 2 == 0, F.col("c_name")).alias("display_name"),
                     F.when(F.col("c_custkey") % 3 == 0, F.concat(F.lower("c_name"), F.lit("@x.com"))).alias("email"))
    return gov.display_names(o, users, "user_id").select("o_orderkey", "display_name")


@register("tag_objects", """SELECT p_partkey, concat_ws(',', CASE WHEN p_partkey % 7 <> 0 THEN 'brand=' || p_brand END,
    CASE WHEN p_partkey % 2 = 0 THEN p_type END, CASE WHEN p_size > 20 THEN 'Verified' END) AS tags FROM part""")
def tag_objects(spark, sf_dir):
    """M-10: tag objects -> key=value or bare values; deleted / hidden skipped; 'Verified'
    added to verified objects."""
    p = read_table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    items = F.array(
        F.struct(F.lit("brand").alias("key"), F.col("p_brand").alias("value"), (k % 7 == 0).alias("deleted"),
                 F.lit(False).alias("hidden"), F.lit(False).alias("deprecated")),
        F.struct(F.col("p_type").alias("key"), F.lit("").alias("value"), F.lit(False).alias("deleted"),
                 (k % 2 == 1).alias("hidden"), F.lit(None).cast("boolean").alias("deprecated")))
    return p.select("p_partkey", F.array_join(gov.tag_objects(items, F.col("p_size") > 20), ",").alias("tags"))


@register("description_import", """SELECT c_custkey, coalesce(CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE 'edited ' || c_name END, 'plain ' || c_name) AS description,
  'owner' || CAST(c_nationkey AS VARCHAR) AS author FROM customer""")
def description_import(spark, sf_dir):
    """M-6: imported descriptions (editable beats plain; author = first owner)."""
    c = read_table(spark, sf_dir, "customer")
    d = gov.imported_description(
        F.when(F.col("c_custkey") % 3 != 0, F.concat(F.lit("edited "), F.col("c_name"))).otherwise(F.lit("")),
        F.concat(F.lit("plain "), F.col("c_name")),
        F.array(F.concat(F.lit("owner"), F.col("c_nationkey").cast("string")), F.lit("backup")))
    return c.select("c_custkey", d["description"].alias("description"), d["author"].alias("author"))
