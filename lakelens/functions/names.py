"""Name, id and path builders (Column -> Column). All JVM-side expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lakelens.functions.scalars import col_of, once


def normalize_name(c) -> Column:
    """Lower-case a dotted name and drop back-ticks and double quotes."""
    return F.lower(F.translate(col_of(c), '`"', ""))


def dotted_name(*parts) -> Column:
    """Join the non-null parts with '.', then normalise (concat_ws skips nulls)."""
    return normalize_name(F.concat_ws(".", *[col_of(p) for p in parts]))


def _id(kind: str, logical: Column) -> Column:
    # to_json drops null fields, and the struct fields are given in
    # alphabetical order, which is the canonical JSON the ids hash.
    return F.concat(F.lit(kind + "~"), F.upper(F.md5(F.to_json(logical))))


def dataset_id(name, platform, account=None) -> Column:
    """DATASET~MD5 of {"account","name","platform"} with nulls left out."""
    acc = col_of(account) if account is not None else F.lit(None).cast("string")
    return _id("DATASET", F.struct(acc.alias("account"), col_of(name).alias("name"), col_of(platform).alias("platform")))


def virtual_view_id(name, view_type) -> Column:
    return _id("VIRTUAL_VIEW", F.struct(col_of(name).alias("name"), col_of(view_type).alias("type")))


def dashboard_id(dashboard_id_col, platform) -> Column:
    return _id("DASHBOARD", F.struct(col_of(dashboard_id_col).alias("dashboardId"), col_of(platform).alias("platform")))


def person_id(email) -> Column:
    return _id("PERSON", F.struct(F.lower(col_of(email)).alias("email")))


def pipeline_id(name, pipeline_type) -> Column:
    return _id("PIPELINE", F.struct(col_of(name).alias("name"), col_of(pipeline_type).alias("type")))


def metric_id(name, metric_type) -> Column:
    return _id("METRIC", F.struct(col_of(name).alias("name"), col_of(metric_type).alias("type")))


def hierarchy_id(path) -> Column:
    return _id("HIERARCHY", F.struct(col_of(path).alias("path")))


def field_path(name, parent=None) -> Column:
    """Field path: lower-case, with '.', '<', '>' percent-encoded; parent joined by '.'."""
    enc = F.replace(F.replace(F.replace(F.lower(col_of(name)), F.lit("."), F.lit("%2E")), F.lit("<"), F.lit("%3C")), F.lit(">"), F.lit("%3E"))
    if parent is None:
        return enc
    p = F.lower(col_of(parent))
    return F.when(p.isNull() | (p == ""), enc).otherwise(F.concat(p, F.lit("."), enc))


def query_log_id(platform, query_id) -> Column:
    """F-6: query-log id 'PLATFORM:query_id'."""
    return F.concat(col_of(platform), F.lit(":"), col_of(query_id))


def sql_hash(sql) -> Column:
    """F-6: MD5 hex of the SQL text."""
    return F.md5(col_of(sql))


def normalize_warehouse_account(host, remove_default_region: bool = False) -> Column:
    """Lower-case an account host and strip the host suffix, private-link and
    (optionally) the default region suffix."""
    h = F.lower(col_of(host))
    h = F.regexp_replace(h, r"\.snowflakecomputing\.com$", "")
    h = F.regexp_replace(h, r"\.privatelink$", "")
    if remove_default_region:
        h = F.regexp_replace(h, r"\.us-west-2$", "")
    return h


def quote_identifier(*parts) -> Column:
    """"a"."b" with embedded quotes doubled."""
    return F.concat_ws(".", *[F.concat(F.lit('"'), F.replace(col_of(p), F.lit('"'), F.lit('""')), F.lit('"')) for p in parts])


def backtick_identifier(*parts) -> Column:
    return F.concat_ws(".", *[F.concat(F.lit("`"), F.replace(col_of(p), F.lit("`"), F.lit("``")), F.lit("`")) for p in parts])


# Fixed pattern: partitioned / sharded table suffix and snapshot suffix.
PARTITION_SUFFIX_RE = r"^(.+)[$_](\d{4}|\d{6}|\d{8}|\d{10}|__PARTITIONS_SUMMARY__)$"
SNAPSHOT_SUFFIX_RE = r"^(.+)@(\d{13})$"


def resource_table_parts(resource) -> Column:
    """'projects/p/datasets/d/tables/t' -> struct(project, dataset, table), with
    partition, shard and snapshot suffixes removed; null when malformed or when
    the table name still holds '$' or '@' afterwards."""
    def named(parts: Column) -> Column:
        part = [F.get(parts, i) for i in range(6)]  # null (not an error) when missing
        # Each strip is a no-op when its pattern does not match.
        stripped = F.regexp_replace(F.regexp_replace(part[5], PARTITION_SUFFIX_RE, "$1"), SNAPSHOT_SUFFIX_RE, "$1")
        ok = (F.size(parts) == 6) & (part[0] == "projects") & (part[2] == "datasets") & (part[4] == "tables")
        return once(stripped, lambda t: F.when(ok & ~t.contains("$") & ~t.contains("@"), F.struct(
            part[1].alias("project"), part[3].alias("dataset"), t.alias("table"))))

    return once(F.split(col_of(resource), "/"), named)


def monitor_object_name(mcon) -> Column:
    """'MCON++a++b++table++db:schema.table' -> 'db.schema.table' (lower-case)."""
    last = F.element_at(F.split(col_of(mcon), r"\+\+"), -1)
    return F.lower(F.replace(last, F.lit(":"), F.lit(".")))


def complete_name(name, default_db, default_schema) -> Column:
    """F-20: complete a 1-, 2- or 3-part name with defaults, by number of parts."""
    n = F.size(F.split(col_of(name), r"\."))
    return (
        F.when(n == 1, F.concat_ws(".", col_of(default_db), col_of(default_schema), col_of(name)))
        .when(n == 2, F.concat_ws(".", col_of(default_db), col_of(name)))
        .otherwise(col_of(name))
    )
