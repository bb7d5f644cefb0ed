"""Query / audit log operators (S-12 .. S-14, R-3, R-4, W-1, W-3, W-5, W-6,
W-8, O-5, A-11, N-1, N-6, N-7).

Skew: a single session, request or query id may hold a large share of a log.
None of these operators sorts a whole key group in one task:
  * "last row per key" is ``max_by`` (map-side partial aggregation);
  * "previous line in the session" (W-3) sorts within (session, time bucket)
    and repairs bucket edges from a small per-bucket "last line" table;
  * "newest n per key" (O-5) ranks within (key, salt) first, then among at
    most n x salts survivors per key;
  * fragment re-assembly (A-11) only nests groups that passed the length gate,
    so a nested group is bounded by that gate.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakelens.functions import names
from lakelens.functions.scalars import col_of, duration_text_seconds, once, parse_iso8601, text_to_long

# ---------------------------------------------------------------- text logs

# Fixed pattern: a log line starts with "YYYY-MM-DD HH:MM:SS TZ:".
LOG_PREFIX_RE = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2} [A-Za-z]+:"


def parse_prefixed_log(df: DataFrame, text: str = "value", line_no: str = "line_no") -> DataFrame:
    """S-13: '%t:%r:%u@%d:[%p]:LEVEL: body' lines -> columns. Lines without the
    date prefix, with fewer than 8 ':'-parts or without user/database are dropped."""
    parts = F.split(F.col(text), ":")
    part = [F.get(parts, i) for i in range(7)]  # null-safe even if evaluated before the size filter
    ud = F.split(part[4], "@")
    out = df.filter(F.col(text).rlike(LOG_PREFIX_RE) & (F.size(parts) >= 8)).select(
        F.col(line_no),
        F.try_to_timestamp(F.regexp_replace(F.concat_ws(":", part[0], part[1], part[2]), r" [A-Za-z]+$", ""),
                           F.lit("yyyy-MM-dd HH:mm:ss")).cast("timestamp_ntz").alias("log_time"),
        F.get(ud, 0).alias("user_name"),
        F.get(ud, 1).alias("database"),
        part[5].alias("session"),
        part[6].alias("log_level"),
        F.slice(parts, F.lit(8), F.size(parts)).alias("body"),
    )
    return out.filter((F.col("user_name") != "") & F.col("database").isNotNull() & (F.col("database") != ""))


def lag_within(df: DataFrame, key: str, ts: str, seq: str, payload: Column, bucket_seconds: int = 300,
               out: str = "prev") -> DataFrame:
    """Previous row's ``payload`` within ``key`` ordered by (ts, seq), computed
    without sorting a whole key in one task (see module notes)."""
    b = F.floor(F.unix_micros(F.col(ts).cast("timestamp")) / (bucket_seconds * 1_000_000)).cast("long")
    x = df.withColumn("__b", b).withColumn("__p", payload)
    w = Window.partitionBy(key, "__b").orderBy(ts, seq)
    x = x.withColumn("__prev_in", F.lag("__p").over(w)).withColumn("__rn", F.row_number().over(w))
    lasts = x.groupBy(key, "__b").agg(F.max_by("__p", F.struct(ts, seq)).alias("__last"))
    prev_bucket = lasts.withColumn(
        "__prev_last", F.lag("__last").over(Window.partitionBy(key).orderBy("__b"))
    ).select(key, "__b", "__prev_last")
    x = x.join(prev_bucket, [key, "__b"], "left")
    return x.withColumn(out, F.when(F.col("__rn") == 1, F.col("__prev_last")).otherwise(F.col("__prev_in"))) \
        .drop("__b", "__p", "__prev_in", "__rn", "__prev_last")


def pair_statement_duration(parsed: DataFrame, excluded_users: Sequence[str] = (), duration_enabled: bool = True,
                            bucket_seconds: int = 300, gap_seconds: int | None = None) -> DataFrame:
    """W-3 / T-1 (batch form): a 'duration:' line takes its SQL from the
    previous accepted LOG line of the same session. Only LOG lines of users not
    excluded enter the pairing (they alone update the per-session 'cache'). With
    ``gap_seconds``, lines further apart are no pair."""
    ok = parsed.filter(F.col("log_level") == "LOG")
    if excluded_users:
        ok = ok.filter(~F.col("user_name").isin(list(excluded_users)))
    payload = F.struct(F.col("log_time"), F.col("line_no"), F.col("body"))
    if duration_enabled:
        x = lag_within(ok, "session", "log_time", "line_no", payload, bucket_seconds)
        x = x.filter(F.ltrim(F.col("body")[0]).startswith("duration") & F.col("prev").isNotNull()
                     & (F.size(F.col("prev.body")) >= 2))
        if gap_seconds is not None:
            x = x.filter(F.col("log_time") <= F.col("prev.log_time") + F.make_dt_interval(secs=F.lit(gap_seconds)))
        src = F.col("prev")
        duration = duration_text_seconds(F.col("body")[1])
    else:
        x = ok.withColumn("prev", payload)
        src = F.col("prev")
        duration = F.lit(None).cast("double")
    kind = F.ltrim(src["body"][0])
    x = x.filter(kind.startswith("statement") | kind.startswith("execute"))
    sql = F.ltrim(F.array_join(F.slice(src["body"], F.lit(2), F.size(src["body"])), ":"))
    return x.select(
        "session", "user_name", "database",
        src["log_time"].alias("start_time"), src["line_no"].alias("line_no"),
        sql.alias("sql"), duration.alias("duration_seconds"),
    )


# ----------------------------------------------------------- row selection

def last_per_key(df: DataFrame, keys: Sequence[str], order: str, first_col: str | None = None) -> DataFrame:
    """W-5: values of the last row per key (greatest ``order``); with
    ``first_col`` also the smallest ``order`` (position of the first row)."""
    cols = [c for c in df.columns if c not in keys]
    aggs = [F.max_by(F.struct(*cols), F.col(order)).alias("__last")]
    if first_col:
        aggs.append(F.min(order).alias(first_col))
    out = df.groupBy(*keys).agg(*aggs)
    return out.select(*keys, "__last.*", *([first_col] if first_col else []))


def newest_where(df: DataFrame, keys: Sequence[str], ts: str, cond: Column, value: Column, out: str) -> DataFrame:
    """W-6 / A-20: per key, ``value`` of the newest row satisfying ``cond``
    (null when none). ``max_by`` skips rows whose ordering value is null."""
    return df.groupBy(*keys).agg(F.max_by(value, F.when(cond, F.col(ts))).alias(out))


def top_n_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int, salts: int = 16,
                  salt_col: Column | None = None) -> DataFrame:
    """O-5 / W-8: the first ``n`` rows per key by ``order``. Two rounds: top n
    within (key, salt), then top n among those (n x salts rows per key)."""
    salt = salt_col if salt_col is not None else F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), F.lit(salts))
    x = df.withColumn("__salt", salt)
    w1 = Window.partitionBy(*keys, "__salt").orderBy(*order)
    x = x.withColumn("__r1", F.row_number().over(w1)).filter(F.col("__r1") <= n)
    w2 = Window.partitionBy(*keys).orderBy(*order)
    return x.withColumn("rank_in_key", F.row_number().over(w2)).filter(F.col("rank_in_key") <= n) \
        .drop("__salt", "__r1")


# -------------------------------------------------------- fragments (A-11)

def reassemble_fragments(frags: DataFrame, key: str, seq: str, text: str, max_length: int = 65536,
                         out: str = "query_text") -> DataFrame:
    """W-1 + A-11: fragments concatenated in ``seq`` order, each right-trimmed of
    spaces unless it is blank. Every key is returned; ``too_long`` marks those whose
    fragments total ``max_length`` characters or more."""
    piece = F.when(F.length(F.rtrim(F.col(text))) == 0, F.col(text)).otherwise(F.rtrim(F.col(text)))
    return frags.groupBy(key).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(F.col(seq), piece.alias("t")))),
                                 lambda s: s["t"]), "").alias(out),
        F.coalesce(F.sum(F.length(text)) >= max_length, F.lit(False)).alias("too_long"),
    )


# ----------------------------------------------------------- JSON objects

# Object domains that count as datasets.
SUPPORTED_DOMAINS = ("TABLE", "VIEW", "MATERIALIZED VIEW", "STREAM")

ACCESSED_SCHEMA = T.ArrayType(T.StructType([
    T.StructField("objectDomain", T.StringType()),
    T.StructField("objectName", T.StringType()),
    T.StructField("objectId", T.LongType()),
    T.StructField("columns", T.ArrayType(T.StructType([
        T.StructField("columnId", T.LongType()),
        T.StructField("columnName", T.StringType()),
    ]))),
]))


def accessed_datasets(raw, account, platform: str = "SNOWFLAKE") -> Column:
    """N-1: accessed-objects JSON -> array of (id, database, schema, table,
    columns) for supported domains whose name has exactly three parts."""
    objs = F.from_json(col_of(raw), ACCESSED_SCHEMA)
    kept = F.filter(objs, lambda o: F.upper(o["objectDomain"]).isin(*SUPPORTED_DOMAINS)
                    & (F.size(F.split(F.lower(o["objectName"]), r"\.")) == 3))

    def conv(o):
        name = F.lower(o["objectName"])
        p = F.split(name, r"\.")
        cols = F.transform(o["columns"], lambda c: c["columnName"])
        return F.struct(
            names.dataset_id(name, F.lit(platform), account).alias("id"),
            p[0].alias("database"), p[1].alias("schema"), p[2].alias("table"),
            F.when(F.size(cols) > 0, cols).alias("columns"),
        )
    return F.transform(kept, conv)


AUDIT_SCHEMA = T.StructType([
    T.StructField("resource", T.StructType([T.StructField("type", T.StringType())])),
    T.StructField("timestamp", T.StringType()),
    T.StructField("protoPayload", T.StructType([
        T.StructField("authenticationInfo", T.StructType([T.StructField("principalEmail", T.StringType())])),
        T.StructField("metadata", T.StructType([T.StructField("jobChange", T.StructType([
            T.StructField("after", T.StringType()),
            T.StructField("job", T.StructType([
                T.StructField("jobName", T.StringType()),
                T.StructField("jobConfig", T.StructType([
                    T.StructField("type", T.StringType()),
                    T.StructField("queryConfig", T.StructType([
                        T.StructField("query", T.StringType()),
                        T.StructField("queryTruncated", T.BooleanType()),
                        T.StructField("destinationTable", T.StringType()),
                        T.StructField("statementType", T.StringType()),
                        T.StructField("defaultDataset", T.StringType()),
                    ])),
                    T.StructField("tableCopyConfig", T.StructType([
                        T.StructField("sourceTables", T.ArrayType(T.StringType())),
                        T.StructField("destinationTable", T.StringType()),
                    ])),
                ])),
                T.StructField("jobStats", T.StructType([
                    T.StructField("startTime", T.StringType()),
                    T.StructField("endTime", T.StringType()),
                    T.StructField("queryStats", T.StructType([
                        T.StructField("referencedTables", T.ArrayType(T.StringType())),
                        T.StructField("referencedViews", T.ArrayType(T.StringType())),
                        T.StructField("totalProcessedBytes", T.StringType()),
                        T.StructField("outputRowCount", T.StringType()),
                    ])),
                ])),
            ])),
        ]))])),
    ])),
])


def _clean_resource(p: Column) -> Column:
    """Parsed resource struct -> 'project.dataset.table', or null when
    temporary (dataset starting with '_') or an information-schema table."""
    ok = p.isNotNull() & ~p["dataset"].startswith("_") & ~F.upper(p["table"]).startswith("INFORMATION_SCHEMA.")
    return F.when(ok, F.concat_ws(".", p["project"], p["dataset"], p["table"]))


def audit_jobs(df: DataFrame, json_col: str = "entry") -> DataFrame:
    """S-12 / N-6 / P-12: audit entries -> finished QUERY/COPY jobs with sources
    (referenced tables + views, or copy sources), cleaned and de-duplicated in
    first-seen order; jobs left without sources are dropped.

    The JSON is parsed once: the parsed struct goes through a one-element
    ``explode`` (a Generate node), which Catalyst does not inline into the
    later filters and projections."""
    x = df.select(F.explode(F.array(F.from_json(F.col(json_col), AUDIT_SCHEMA))).alias("e"))
    job = F.col("e.protoPayload.metadata.jobChange.job")
    jtype = job["jobConfig"]["type"]
    qc = job["jobConfig"]["queryConfig"]
    cc = job["jobConfig"]["tableCopyConfig"]
    qs = job["jobStats"]["queryStats"]
    x = x.filter(
        (F.col("e.resource.type") == "bigquery_project")
        & (F.col("e.protoPayload.metadata.jobChange.after") == "DONE")
        & jtype.isin("QUERY", "COPY")
    ).select(
        jtype.alias("job_type"), job["jobName"].alias("job_name"), qc.alias("qc"), qs.alias("qs"),
        job["jobStats"].alias("stats"), F.col("e.protoPayload.authenticationInfo.principalEmail").alias("email"),
        F.when(jtype == "COPY", cc["sourceTables"]).otherwise(
            F.concat(F.coalesce(qs["referencedTables"], F.array().cast("array<string>")),
                     F.coalesce(qs["referencedViews"], F.array().cast("array<string>")))).alias("raw_sources"),
        F.when(jtype == "COPY", cc["destinationTable"]).otherwise(qc["destinationTable"]).alias("raw_dest"),
    )
    parsed = F.transform(F.col("raw_sources"), names.resource_table_parts)
    sources = F.array_distinct(F.filter(F.transform(parsed, _clean_resource), lambda s: s.isNotNull()))
    # Generated like the struct, so that the last filter does not compute them again.
    x = x.select("*", F.explode_outer(F.array(sources)).alias("sources")).filter(F.size("sources") > 0)
    out = x.select(
        "job_name", "job_type",
        F.coalesce(F.col("email"), F.lit("")).alias("user_email"),
        F.when(F.col("job_type") == "QUERY", F.col("qc.query")).alias("query"),
        F.when(F.col("job_type") == "QUERY", F.col("qc.statementType")).alias("statement_type"),
        "sources",
        once(names.resource_table_parts(F.col("raw_dest")), _clean_resource).alias("destination"),
        parse_iso8601(F.col("stats.startTime")).alias("start_time"),
        parse_iso8601(F.col("stats.endTime")).alias("end_time"),
        F.when(F.col("job_type") == "QUERY", text_to_long(F.col("qs.totalProcessedBytes"))).alias("input_bytes"),
        F.when(F.col("job_type") == "QUERY", text_to_long(F.col("qs.outputRowCount"))).alias("output_rows"),
    )
    return out


def json_entries(raw, value_type: str = "string") -> Column:
    """N-7: a JSON object / map -> array of (key, value-as-JSON) entries."""
    m = F.from_json(col_of(raw), f"map<string,{value_type}>")
    return F.transform(F.map_entries(m), lambda kv: F.struct(kv["key"].alias("key"), F.to_json(F.array(kv["value"])).alias("json")))


# -------------------------------------------------------- query-log rows

# Statement type -> query log type.
STATEMENT_TYPES = {
    "SELECT": "SELECT", "INSERT": "INSERT", "UPDATE": "UPDATE", "DELETE": "DELETE", "MERGE": "MERGE",
    "CREATE_TABLE": "CREATE_TABLE", "CREATE_TABLE_AS_SELECT": "CREATE_TABLE",
    "CREATE_VIEW": "CREATE_VIEW", "DROP_TABLE": "DROP_TABLE", "ALTER_TABLE": "ALTER_TABLE",
    "TRUNCATE_TABLE": "TRUNCATE", "CREATE": "CREATE_TABLE", "DROP": "DROP_TABLE", "ALTER": "ALTER_TABLE",
    "TRUNCATE": "TRUNCATE", "COPY": "COPY",
}


def log_type(statement_type) -> Column:
    """R-4: statement type -> log type; anything else -> OTHER."""
    m = F.create_map(*[x for k, v in STATEMENT_TYPES.items() for x in (F.lit(k), F.lit(v))])
    return F.coalesce(m[F.upper(col_of(statement_type))], F.lit("OTHER"))


def to_query_log(df: DataFrame, platform: str, query_id, sql, start_time, user, duration_seconds=None,
                 account=None, rows_read=None, rows_written=None, bytes_read=None, bytes_written=None,
                 default_database=None, default_schema=None) -> DataFrame:
    """R-3: project any engine's history row onto the query-log columns:
    id = PLATFORM:query_id, sql hash = md5(sql), user split into user_id/email."""
    def opt(c, t):
        return col_of(c).cast(t) if c is not None else F.lit(None).cast(t)
    u = col_of(user)
    is_mail = u.rlike(r"^[^@\s]+@[^@\s]+\.[^@\s]+$")
    return df.select(
        names.query_log_id(F.lit(platform), col_of(query_id).cast("string")).alias("id"),
        col_of(query_id).cast("string").alias("query_id"),
        F.lit(platform).alias("platform"),
        opt(account, "string").alias("account"),
        col_of(sql).alias("sql"),
        names.sql_hash(col_of(sql)).alias("sql_hash"),
        col_of(start_time).alias("start_time"),
        opt(duration_seconds, "double").alias("duration"),
        F.when(~is_mail, u).alias("user_id"),
        F.when(is_mail, u).alias("email"),
        opt(default_database, "string").alias("default_database"),
        opt(default_schema, "string").alias("default_schema"),
        opt(rows_read, "double").alias("rows_read"),
        opt(rows_written, "double").alias("rows_written"),
        opt(bytes_read, "double").alias("bytes_read"),
        opt(bytes_written, "double").alias("bytes_written"),
    )


def in_time_range(ts, start, end, closed: str = "left") -> Column:
    """P-8: ``[start, end)`` by default; ``closed='right'`` gives ``(start, end]``."""
    t = col_of(ts)
    if closed == "right":
        return (t > start) & (t <= end)
    return (t >= start) & (t < end)
