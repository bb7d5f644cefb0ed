"""Log jobs: text-log pairing, fragment re-assembly, dedup, newest rows, JSON
access / audit logs, query-log projection (S-12 .. S-14, R-3, R-4, W-1, W-3,
W-5, W-6, W-8, O-5, A-11, N-1, N-6, N-7, P-8 .. P-10, P-16).

Every landed log here is derived from the tables by Spark itself (lines from
``events``, JSON documents from ``orders`` + ``lineitem``), so the work grows
with them; the oracle computes the same fields directly with SQL.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from lakelens.operators import logs
from lakelens.plans.common import r6, sql_r6
from lakelens.plans.registry import register
from lakelens.session import groups_for
from lakelens.sources.tables import read_table, spread

# ----------------------------------------------------------- W-1 / A-11


def fragments(spark, sf_dir, size: int = 200):
    """Query texts landed as ordered fragments (documents split every 200 chars)."""
    d = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    n = F.greatest(F.ceil(F.length("text") / size).cast("int"), F.lit(1))
    x = d.select("doc_id", "text", F.explode(F.sequence(F.lit(0), n - 1)).alias("sequence"))
    return x.select(F.col("doc_id").alias("query_id"), "sequence",
                    F.substring("text", F.col("sequence") * size + 1, F.lit(size)).alias("text"))


@register("query_text_reassembly", """WITH f AS (
  SELECT doc_id AS query_id, seq AS sequence, substr(text, seq * 200 + 1, 200) AS text
  FROM (SELECT doc_id, text, unnest(range(0, greatest(CAST(ceil(length(text) / 200.0) AS BIGINT), 1))) AS seq FROM documents))
SELECT query_id, string_agg(CASE WHEN length(rtrim(text, ' ')) = 0 THEN text ELSE rtrim(text, ' ') END, '' ORDER BY sequence) AS query_text,
  coalesce(sum(length(text)) >= 65536, FALSE) AS too_long
FROM f GROUP BY query_id""")
def query_text_reassembly(spark, sf_dir):
    """W-1 + A-11: fragments re-assembled in order, each right-trimmed unless
    blank; texts of 65 536 characters or more are marked."""
    return logs.reassemble_fragments(fragments(spark, sf_dir), "query_id", "sequence", "text")


# ------------------------------------------------------------------ W-3

EXCLUDED_USERS = ("user13", "user26")


def text_log(spark, sf_dir):
    return text_log_from(spread(read_table(spark, sf_dir, "events")))


def text_log_from(events):
    """Landed text log: per event a statement line, sometimes a continuation
    line without the date prefix, and a duration line. One in ten statement
    lines is an ERROR line instead of LOG. Works on batch and stream inputs."""
    e = events.select("event_id", "ts", "user_id", "event_type", "value")
    prefix = F.concat(
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), F.lit(" UTC:10.1.1."), (F.col("user_id") % 250).cast("string"),
        F.lit("(5432):user"), F.col("user_id").cast("string"), F.lit("@db_"), F.col("event_type"),
        F.lit(":["), F.col("user_id").cast("string"), F.lit("]:"))
    level = F.when(F.col("event_id") % 10 == 3, F.lit("ERROR")).otherwise(F.lit("LOG"))
    stmt = F.concat(prefix, level, F.lit(":  statement: SELECT value, 'a:b' FROM t_"), F.col("event_type"),
                    F.lit(" WHERE id = "), F.col("event_id").cast("string"))
    cont = F.concat(F.lit("    AND note = 'x:"), F.col("event_id").cast("string"), F.lit("'"))
    dur = F.concat(prefix, F.lit("LOG:  duration: "), F.col("value").cast("decimal(10,2)").cast("string"), F.lit(" ms"))
    lines = F.array(
        F.struct((F.col("event_id") * 3).alias("line_no"), stmt.alias("value")),
        F.struct((F.col("event_id") * 3 + 1).alias("line_no"), F.when(F.col("event_id") % 10 == 7, cont).alias("value")),
        F.struct((F.col("event_id") * 3 + 2).alias("line_no"), dur.alias("value")),
    )
    return e.select(F.inline(lines)).filter(F.col("value").isNotNull())


LOG_SQL = r"""lines AS (
  SELECT event_id * 3 AS line_no,
    strftime(ts, '%Y-%m-%d %H:%M:%S') || ' UTC:10.1.1.' || CAST(user_id % 250 AS VARCHAR) || '(5432):user' || CAST(user_id AS VARCHAR)
      || '@db_' || event_type || ':[' || CAST(user_id AS VARCHAR) || ']:' || CASE WHEN event_id % 10 = 3 THEN 'ERROR' ELSE 'LOG' END
      || ':  statement: SELECT value, ''a:b'' FROM t_' || event_type || ' WHERE id = ' || CAST(event_id AS VARCHAR) AS value FROM events
  UNION ALL
  SELECT event_id * 3 + 2,
    strftime(ts, '%Y-%m-%d %H:%M:%S') || ' UTC:10.1.1.' || CAST(user_id % 250 AS VARCHAR) || '(5432):user' || CAST(user_id AS VARCHAR)
      || '@db_' || event_type || ':[' || CAST(user_id AS VARCHAR) || ']:LOG:  duration: ' || CAST(CAST(value AS DECIMAL(10,2)) AS VARCHAR) || ' ms' FROM events
  UNION ALL
  SELECT event_id * 3 + 1, '    AND note = ''x:' || CAST(event_id AS VARCHAR) || '''' FROM events WHERE event_id % 10 = 7),
parsed AS (
  SELECT line_no, strptime(p[1] || ':' || p[2] || ':' || regexp_replace(p[3], ' [A-Za-z]+$', ''), '%Y-%m-%d %H:%M:%S') AS log_time,
    split_part(p[5], '@', 1) AS user_name, split_part(p[5], '@', 2) AS database, p[6] AS session, p[7] AS log_level, p[8:] AS body
  FROM (SELECT line_no, string_split(value, ':') AS p FROM lines
        WHERE regexp_matches(value, '^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2} [A-Za-z]+:') AND len(string_split(value, ':')) >= 8)),
ok AS (SELECT * FROM parsed WHERE log_level = 'LOG' AND user_name NOT IN ('user13', 'user26') AND user_name <> '' AND database <> ''),
lagged AS (
  SELECT *, lag(body) OVER w AS prev_body, lag(log_time) OVER w AS prev_time, lag(line_no) OVER w AS prev_line
  FROM ok WINDOW w AS (PARTITION BY session ORDER BY log_time, line_no))"""


@register("log_pairing", f"""WITH {LOG_SQL}
SELECT session, user_name, database, prev_time AS start_time, prev_line AS line_no,
  ltrim(array_to_string(prev_body[2:], ':')) AS sql,
  {sql_r6("CAST(regexp_extract(body[2], '([0-9]+(?:[.][0-9]+)?) ms', 1) AS DOUBLE) / 1000.0")} AS duration_seconds
FROM lagged
WHERE starts_with(ltrim(body[1]), 'duration') AND prev_body IS NOT NULL AND len(prev_body) >= 2
  AND (starts_with(ltrim(prev_body[1]), 'statement') OR starts_with(ltrim(prev_body[1]), 'execute'))""")
def log_pairing(spark, sf_dir):
    """S-13 + W-3: parse prefixed text lines, pair each duration line with the
    previous accepted statement line of its session."""
    parsed = logs.parse_prefixed_log(text_log(spark, sf_dir))
    out = logs.pair_statement_duration(parsed, EXCLUDED_USERS)
    return out.withColumn("duration_seconds", r6("duration_seconds"))


# ------------------------------------------------------- W-5, W-6, W-8, O-5

@register("dedup_last_wins", """SELECT event_type || '-' || CAST(user_id % 7 AS VARCHAR) AS request_id,
  arg_max(event_id, event_id) AS event_id, arg_max(ts, event_id) AS ts, arg_max(value, event_id) AS value,
  arg_max(user_id, event_id) AS user_id, min(event_id) AS first_seq
FROM events GROUP BY 1""")
def dedup_last_wins(spark, sf_dir):
    """W-5 / T-4 (batch): one row per request id holding the last row's values
    and the first row's position."""
    e = read_table(spark, sf_dir, "events").select(
        F.concat(F.col("event_type"), F.lit("-"), (F.col("user_id") % 7).cast("string")).alias("request_id"),
        "event_id", "ts", "value", "user_id")
    out = logs.last_per_key(e, ["request_id"], "event_id", first_col="first_seq")
    return out.select("request_id", "event_id", "ts", "value", "user_id", "first_seq")


@register("last_completed", """SELECT user_id,
  arg_max(value, ts) FILTER (WHERE event_type = 'purchase') AS last_purchase_value,
  max(ts) FILTER (WHERE event_type = 'purchase') AS last_purchase_ts
FROM events GROUP BY user_id""")
def last_completed(spark, sf_dir):
    """W-6: newest row satisfying a condition, per key (null when none)."""
    e = read_table(spark, sf_dir, "events")
    cond = F.col("event_type") == "purchase"
    a = logs.newest_where(e, ["user_id"], "ts", cond, F.col("value"), "last_purchase_value")
    b = logs.newest_where(e, ["user_id"], "ts", cond, F.col("ts"), "last_purchase_ts")
    return a.join(b, "user_id")


@register("latest_per_key", """SELECT o_custkey, arg_max(o_orderkey, o_orderdate) AS o_orderkey, max(o_orderdate) AS o_orderdate
FROM (SELECT * FROM orders WHERE o_orderdate > (SELECT max(o_orderdate) FROM orders) - INTERVAL 365 DAY
      QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1)
GROUP BY o_custkey""")
def latest_per_key(spark, sf_dir):
    """W-8: latest run of each pipeline (customer) within the look-back; ties
    on time broken by the larger id."""
    o = read_table(spark, sf_dir, "orders")
    as_of = o.select(F.max("o_orderdate")).scalar()
    recent = o.filter(F.col("o_orderdate") > as_of - F.make_dt_interval(F.lit(365)))
    out = recent.groupBy("o_custkey").agg(F.max_by(F.struct("o_orderkey", "o_orderdate"),
                                                   F.struct("o_orderdate", "o_orderkey")).alias("s"))
    return out.select("o_custkey", "s.o_orderkey", "s.o_orderdate")


@register("newest_n_per_key", """SELECT user_id, event_id, ts, rank_in_key FROM (
  SELECT user_id, event_id, ts, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rank_in_key
  FROM events WHERE event_type NOT IN ('view')) WHERE rank_in_key <= 3""")
def newest_n_per_key(spark, sf_dir):
    """O-5 + P-16: newest 3 history entries per key after dropping no-op kinds,
    ranked in two salted rounds."""
    events = read_table(spark, sf_dir, "events")
    salts = groups_for(events.count(), minimum=16)
    e = events.filter(~F.col("event_type").isin("view")).select("user_id", "event_id", "ts")
    out = logs.top_n_per_key(e, ["user_id"], [F.col("ts").desc(), F.col("event_id").desc()], 3, salts=salts)
    return out.select("user_id", "event_id", "ts", F.col("rank_in_key").cast("long").alias("rank_in_key"))


# ------------------------------------------------------------------- N-1

def access_history(spark, sf_dir):
    """Landed access history: one JSON array of accessed objects per order."""
    li = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")
    n = F.col("l_linenumber")
    domain = (F.when(n == 1, "Table").when(n == 2, "VIEW").when(n == 3, "Stage").when(n == 4, "materialized view")
              .when(n == 5, "Stream").otherwise("Table"))
    name = F.when(n == 6, F.concat(F.lit("DB.PART_"), F.col("l_partkey").cast("string"))).otherwise(
        F.concat(F.lit("DB_"), (F.col("l_suppkey") % 3).cast("string"), F.lit(".SCH.PART_"), F.col("l_partkey").cast("string")))
    cols = F.when(n % 2 == 1, F.array(
        F.struct(F.lit(1).cast("long").alias("columnId"), F.lit("L_QUANTITY").alias("columnName")),
        F.struct(F.lit(2).cast("long").alias("columnId"), F.lit("L_TAX").alias("columnName")),
    )).otherwise(F.array().cast("array<struct<columnId:bigint,columnName:string>>"))
    obj = F.struct(domain.alias("objectDomain"), name.alias("objectName"), F.col("l_partkey").alias("objectId"), cols.alias("columns"))
    return li.groupBy(F.col("l_orderkey").alias("query_id")).agg(
        F.to_json(F.transform(F.array_sort(F.collect_list(F.struct(n.alias("n"), obj.alias("o")))), lambda s: s["o"]))
        .alias("direct_objects_accessed"))


@register("accessed_objects_json", """SELECT l_orderkey AS query_id,
  'DATASET~' || upper(md5('{"account":"acct","name":' || to_json(name) || ',"platform":"SNOWFLAKE"}')) AS id,
  split_part(name, '.', 1) AS database, split_part(name, '.', 2) AS schema, split_part(name, '.', 3) AS "table",
  CASE WHEN l_linenumber % 2 = 1 THEN 'L_QUANTITY,L_TAX' END AS columns
FROM (SELECT l_orderkey, l_linenumber, lower('DB_' || CAST(l_suppkey % 3 AS VARCHAR) || '.SCH.PART_' || CAST(l_partkey AS VARCHAR)) AS name
      FROM lineitem WHERE l_linenumber IN (1, 2, 4, 5, 7))""")
def accessed_objects_json(spark, sf_dir):
    """N-1: accessed-objects JSON -> queried datasets (supported domains, three-part names)."""
    h = access_history(spark, sf_dir)
    ds = h.select("query_id", F.explode(logs.accessed_datasets("direct_objects_accessed", F.lit("acct"))).alias("d"))
    return ds.select("query_id", "d.id", "d.database", "d.schema", "d.table",
                     F.array_join("d.columns", ",").alias("columns"))


# ------------------------------------------------------------------- N-6

def audit_log(spark, sf_dir):
    """Landed audit log: one JSON entry per order (query / copy / load jobs)."""
    o = read_table(spark, sf_dir, "orders")
    li = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")
    path = F.when(F.col("l_linenumber") == 3, F.lit("projects/p/datasets/_session/tables/x")).otherwise(F.concat(
        F.lit("projects/p/datasets/d"), (F.col("l_suppkey") % 3).cast("string"), F.lit("/tables/part"),
        (F.col("l_partkey") % 20).cast("string")))
    view = F.when(F.col("l_linenumber") == 2, F.lit("projects/p/datasets/v/tables/INFORMATION_SCHEMA.COLUMNS"))
    refs = li.groupBy("l_orderkey").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("l_linenumber", path.alias("p")))), lambda s: s["p"]).alias("tables"),
        F.filter(F.transform(F.array_sort(F.collect_list(F.struct("l_linenumber", view.alias("p")))), lambda s: s["p"]),
                 lambda p: p.isNotNull()).alias("views"),
        F.count(F.lit(1)).alias("n"))
    x = o.join(refs, o.o_orderkey == refs.l_orderkey)
    k = F.col("o_orderkey") % 5
    jtype = F.when(k == 0, "COPY").when(k == 1, "LOAD").otherwise("QUERY")
    dest = F.concat(F.lit("projects/p/datasets/"), F.when(F.col("o_custkey") % 4 == 0, "_tmp").otherwise("sales"),
                    F.lit("/tables/orders_p"), F.substring("o_orderpriority", 1, 1), F.lit("_"),
                    F.date_format("o_orderdate", "yyyyMMdd"))
    stamp = F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
    end = F.date_format(F.col("o_orderdate") + F.expr("INTERVAL 90 MINUTES"), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
    entry = F.struct(
        F.struct(F.when(F.col("o_orderkey") % 17 == 0, "other").otherwise("bigquery_project").alias("type")).alias("resource"),
        stamp.alias("timestamp"),
        F.struct(
            F.struct(F.concat(F.lit("user"), F.col("o_custkey").cast("string"), F.lit("@example.com")).alias("principalEmail"))
            .alias("authenticationInfo"),
            F.struct(F.struct(
                F.when(F.col("o_orderstatus") == "P", "RUNNING").otherwise("DONE").alias("after"),
                F.struct(
                    F.concat(F.lit("projects/p/jobs/"), F.col("o_orderkey").cast("string")).alias("jobName"),
                    F.struct(
                        jtype.alias("type"),
                        F.when(jtype == "QUERY", F.struct(
                            F.concat(F.lit("INSERT INTO sales.orders SELECT * FROM part -- "), F.col("o_orderpriority")).alias("query"),
                            dest.alias("destinationTable"),
                            F.lit("INSERT").alias("statementType"),
                        )).alias("queryConfig"),
                        F.when(jtype == "COPY", F.struct(F.col("tables").alias("sourceTables"), dest.alias("destinationTable")))
                        .alias("tableCopyConfig"),
                    ).alias("jobConfig"),
                    F.struct(
                        stamp.alias("startTime"), end.alias("endTime"),
                        F.struct(F.col("tables").alias("referencedTables"), F.col("views").alias("referencedViews"),
                                 F.round(F.col("o_totalprice") * 100).cast("long").cast("string").alias("totalProcessedBytes"),
                                 F.col("n").cast("string").alias("outputRowCount")).alias("queryStats"),
                    ).alias("jobStats"),
                ).alias("job"),
            ).alias("jobChange")).alias("metadata"),
        ).alias("protoPayload"),
    )
    return x.select(F.to_json(entry).alias("entry"))


@register("audit_jobs", """WITH refs AS (
  SELECT l_orderkey, l_linenumber,
    'p.d' || CAST(l_suppkey % 3 AS VARCHAR) || '.part' || CAST(l_partkey % 20 AS VARCHAR) AS src
  FROM lineitem WHERE l_linenumber <> 3),
firsts AS (SELECT l_orderkey, src, min(l_linenumber) AS pos FROM refs GROUP BY ALL),
srcs AS (SELECT l_orderkey, string_agg(src, ',' ORDER BY pos, src) AS sources FROM firsts GROUP BY l_orderkey),
cnt AS (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY l_orderkey)
SELECT 'projects/p/jobs/' || CAST(o.o_orderkey AS VARCHAR) AS job_name,
  CASE WHEN o.o_orderkey % 5 = 0 THEN 'COPY' ELSE 'QUERY' END AS job_type,
  'user' || CAST(o.o_custkey AS VARCHAR) || '@example.com' AS user_email,
  CASE WHEN o.o_orderkey % 5 <> 0 THEN 'INSERT INTO sales.orders SELECT * FROM part -- ' || o.o_orderpriority END AS query,
  CASE WHEN o.o_orderkey % 5 <> 0 THEN 'INSERT' END AS statement_type,
  s.sources,
  CASE WHEN o.o_custkey % 4 <> 0 THEN 'p.sales.orders_p' || o.o_orderpriority[1:1] END AS destination,
  o.o_orderdate AS start_time, o.o_orderdate + INTERVAL 90 MINUTE AS end_time,
  CASE WHEN o.o_orderkey % 5 <> 0 THEN CAST(round(o.o_totalprice * 100) AS BIGINT) END AS input_bytes,
  CASE WHEN o.o_orderkey % 5 <> 0 THEN c.n END AS output_rows
FROM orders o JOIN srcs s ON o.o_orderkey = s.l_orderkey JOIN cnt c ON o.o_orderkey = c.l_orderkey
WHERE o.o_orderkey % 17 <> 0 AND o.o_orderstatus <> 'P' AND o.o_orderkey % 5 <> 1""")
def audit_jobs(spark, sf_dir):
    """S-12 / N-6 / U-6 prep: audit JSON -> finished query and copy jobs with
    cleaned, de-duplicated sources (temporary and information-schema removed)."""
    out = logs.audit_jobs(audit_log(spark, sf_dir))
    return out.select("job_name", "job_type", "user_email", "query", "statement_type",
                      F.array_join("sources", ",").alias("sources"), "destination",
                      F.col("start_time").cast("timestamp_ntz").alias("start_time"),
                      F.col("end_time").cast("timestamp_ntz").alias("end_time"), "input_bytes", "output_rows")


# ------------------------------------------------------------------- N-7

@register("props_entries", """SELECT event_id, j.key AS key, CAST(j.value AS VARCHAR) AS value_json
FROM events, json_each(events.props) AS j""")
def props_entries(spark, sf_dir):
    """N-7: a JSON object column -> (key, JSON value) rows."""
    e = read_table(spark, sf_dir, "events").select("event_id", "props")
    m = F.from_json("props", "map<string,string>")
    return e.select("event_id", F.explode(m).alias("key", "value_json"))


# ------------------------------------------------------------- R-3 / R-4

@register("query_log_rows", """SELECT 'POSTGRESQL:' || CAST(o_orderkey AS VARCHAR) AS id, CAST(o_orderkey AS VARCHAR) AS query_id,
  'POSTGRESQL' AS platform, 'acct' AS account,
  'SELECT * FROM orders WHERE o_orderkey = ' || CAST(o_orderkey AS VARCHAR) AS sql,
  md5('SELECT * FROM orders WHERE o_orderkey = ' || CAST(o_orderkey AS VARCHAR)) AS sql_hash,
  o_orderdate AS start_time, round(round(CAST(o_totalprice AS DOUBLE) / 1000.0, 10), 6) AS duration,
  CASE WHEN o_custkey % 2 = 1 THEN 'user' || CAST(o_custkey AS VARCHAR) END AS user_id,
  CASE WHEN o_custkey % 2 = 0 THEN 'user' || CAST(o_custkey AS VARCHAR) || '@example.com' END AS email,
  'db' AS default_database, CAST(NULL AS VARCHAR) AS default_schema,
  CAST(o_custkey AS DOUBLE) AS rows_read, CAST(NULL AS DOUBLE) AS rows_written,
  CAST(NULL AS DOUBLE) AS bytes_read, CAST(NULL AS DOUBLE) AS bytes_written,
  CASE o_orderkey % 6 WHEN 0 THEN 'SELECT' WHEN 1 THEN 'INSERT' WHEN 2 THEN 'CREATE_TABLE' WHEN 3 THEN 'MERGE'
                      WHEN 4 THEN 'OTHER' ELSE 'TRUNCATE' END AS log_type
FROM orders WHERE o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate < TIMESTAMP '1997-01-01'""")
def query_log_rows(spark, sf_dir):
    """R-3 / R-4 / P-8: history rows in a [start, end) window projected onto
    query logs (PLATFORM:id, sql hash, user vs e-mail, seconds) with the
    statement type mapped to a log type."""
    o = read_table(spark, sf_dir, "orders")
    o = o.filter(logs.in_time_range("o_orderdate", F.lit("1996-01-01").cast("timestamp_ntz"),
                                    F.lit("1997-01-01").cast("timestamp_ntz")))
    k = F.col("o_orderkey") % 6
    stype = (F.when(k == 0, "select").when(k == 1, "insert").when(k == 2, "CREATE_TABLE_AS_SELECT")
             .when(k == 3, "merge").when(k == 4, "call").otherwise("truncate_table"))
    user = F.concat(F.lit("user"), F.col("o_custkey").cast("string"),
                    F.when(F.col("o_custkey") % 2 == 0, F.lit("@example.com")).otherwise(F.lit("")))
    o = o.withColumn("__stype", stype).withColumn("__user", user) \
        .withColumn("__sql", F.concat(F.lit("SELECT * FROM orders WHERE o_orderkey = "), F.col("o_orderkey").cast("string")))
    q = logs.to_query_log(o, "POSTGRESQL", "o_orderkey", "__sql", "o_orderdate", "__user",
                          duration_seconds=F.col("o_totalprice") / 1000.0, account=F.lit("acct"),
                          rows_read="o_custkey", default_database=F.lit("db"))
    lt = o.select(F.col("o_orderkey").cast("string").alias("query_id"), logs.log_type("__stype").alias("log_type"))
    return q.withColumn("duration", r6("duration")).join(lt, "query_id")


@register("log_gates", """SELECT event_type, length(props) < 10 AS short_props, CAST(count(*) AS BIGINT) AS n
FROM events WHERE ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-20'
  AND user_id NOT IN (3, 5, 7) AND event_type <> 'error'
GROUP BY ALL""")
def log_gates(spark, sf_dir):
    """P-8 .. P-10: time range, excluded users, success-only (pushed down); the size
    gate marks rows and drops none."""
    e = read_table(spark, sf_dir, "events")
    e = e.filter(logs.in_time_range("ts", F.lit("2024-01-05").cast("timestamp_ntz"), F.lit("2024-01-20").cast("timestamp_ntz"))
                 & ~F.col("user_id").isin(3, 5, 7) & (F.col("event_type") != "error"))
    return e.groupBy("event_type", (F.length("props") < 10).alias("short_props")).agg(F.count(F.lit(1)).alias("n"))
