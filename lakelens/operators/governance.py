"""Governance, data-quality and BI/ETL mappings (M-2, M-3, M-4, M-6, M-7, M-8,
M-10, J-10, J-11, J-13, J-15, J-16, J-17, R-5, R-7, R-10, R-17, G-7, S-16,
S-17, N-8, N-9, P-15, A-17, A-20).

Each is a relational mapping over landed tables: joins on ids, ``max_by`` for
"latest wins", ``coalesce`` for precedence, lookup maps for enums, and
``explode`` for nested lists. Lookup tables that are configuration (status and
severity maps) are literal maps; lookups that are data are joined.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakelens.functions import names
from lakelens.functions.scalars import col_of, is_email
from lakelens.operators.nesting import LENGTH, nested_lists


def lookup(c, mapping: Mapping[str, str], default: str | None = None) -> Column:
    m = F.create_map(*[x for k, v in mapping.items() for x in (F.lit(k), F.lit(v))])
    out = m[F.lower(col_of(c))]
    return F.coalesce(out, F.lit(default)) if default is not None else out


# ------------------------------------------------------------- monitors

# External monitor / alert status and severity names.
MONITOR_STATUS = {"pass": "PASSED", "passed": "PASSED", "success": "PASSED", "fail": "ERROR", "failed": "ERROR",
                  "error": "ERROR", "warn": "WARNING", "warning": "WARNING"}
SEVERITY = {"sev-1": "HIGH", "sev-2": "MEDIUM", "sev-3": "LOW", "sev-4": "LOW"}


def external_monitors(monitors: DataFrame, warehouses: DataFrame) -> DataFrame:
    """J-15 / M-4 / F-18: monitors (entity id list) exploded, dataset name
    parsed from the object id, joined to the warehouse map; unknown platforms
    are dropped. Status / severity through fixed maps."""
    x = monitors.select("*", F.explode("mcons").alias("__mcon"))
    x = x.withColumn("dataset_name", names.monitor_object_name("__mcon")) \
        .withColumn("__db", F.split("dataset_name", r"\.")[0])
    w = warehouses.select(F.col("database").alias("__db"), "platform")
    return x.join(w, "__db").select(
        "monitor_id", "dataset_name", "platform",
        names.dataset_id(F.col("dataset_name"), F.col("platform")).alias("entity_id"),
        lookup("status", MONITOR_STATUS, "UNKNOWN").alias("status"),
        lookup("severity", SEVERITY, "UNKNOWN").alias("severity"),
    )


def open_alerts(alerts: DataFrame, ts: str, as_of: Column, days: int) -> DataFrame:
    """M-4: only alerts without a handling status, inside the look-back."""
    return alerts.filter(F.col("handled_status").isNull()
                         & (F.col(ts) >= as_of - F.make_dt_interval(F.lit(days))))


def monitors_per_dataset(monitors: DataFrame, dataset: str, size: int = LENGTH) -> DataFrame:
    """A-17 / M-3: distinct monitors nested per dataset (sorted), in chunks of at most
    ``size``; repeats go before anything is nested."""
    cols = [c for c in monitors.columns if c != dataset]
    return nested_lists(monitors.distinct(), [dataset], cols, F.struct(*cols), "monitors", size)


# ------------------------------------------------------- assignments

def governance_rows(assign: DataFrame) -> DataFrame:
    """M-2: (dataset, kind, value[, column]) assignment rows -> per dataset the
    owners (person ids), tags, column tags and description."""
    owners = assign.filter(F.col("kind") == "owner").groupBy("dataset").agg(
        F.array_sort(F.collect_set(names.person_id(F.col("value")))).alias("owners"))
    tags = assign.filter(F.col("kind") == "tag").groupBy("dataset").agg(F.array_sort(F.collect_set("value")).alias("tags"))
    ctags = assign.filter(F.col("kind") == "column_tag").groupBy("dataset").agg(
        F.array_sort(F.collect_set(F.concat(F.lower("column_name"), F.lit(":"), F.col("value")))).alias("column_tags"))
    desc = assign.filter(F.col("kind") == "description").groupBy("dataset").agg(
        F.max_by("value", "seq").alias("description"))
    ds = assign.select("dataset").distinct()
    return ds.join(owners, "dataset", "left").join(tags, "dataset", "left").join(ctags, "dataset", "left") \
        .join(desc, "dataset", "left")


def imported_description(editable, plain, owners) -> Column:
    """M-6: the editable description beats the plain one; the author falls back
    to the first owner."""
    return F.struct(F.coalesce(F.nullif(col_of(editable), F.lit("")), col_of(plain)).alias("description"),
                    F.get(col_of(owners), 0).alias("author"))


def attributions(rows: DataFrame) -> DataFrame:
    """M-8: query id -> e-mail; rows whose e-mail is not valid are flagged."""
    return rows.withColumn("valid_email", is_email(F.col("email")))


def tag_objects(tags, verified=None) -> Column:
    """M-10: tag items -> 'key=value' or bare 'value' when the value is empty;
    deleted / hidden / deprecated items are skipped. Objects for which ``verified`` is
    true get the tag 'Verified' at the end."""
    kept = F.filter(col_of(tags), lambda t: ~F.coalesce(t["deleted"], F.lit(False)) & ~F.coalesce(t["hidden"], F.lit(False))
                    & ~F.coalesce(t["deprecated"], F.lit(False)))
    found = F.transform(kept, lambda t: F.when(F.coalesce(t["value"], F.lit("")) == "", t["key"])
                        .otherwise(F.concat(t["key"], F.lit("="), t["value"])))
    return found if verified is None else F.when(col_of(verified), F.array_append(found, F.lit("Verified"))).otherwise(found)


# ----------------------------------------------------------- artifacts

# Model materialisations.
MATERIALIZATIONS = {"table": "TABLE", "view": "VIEW", "incremental": "INCREMENTAL", "ephemeral": "EPHEMERAL",
                    "snapshot": "SNAPSHOT", "materialized_view": "MATERIALIZED_VIEW"}
TEST_STATUS = {"pass": "PASSED", "success": "PASSED", "fail": "ERROR", "error": "ERROR", "warn": "WARNING",
               "skipped": "UNKNOWN"}

NODE_SCHEMA = ("map<string,struct<resource_type:string,name:string,raw_code:string,raw_sql:string,"
               "config:struct<materialized:string>,depends_on:struct<nodes:array<string>>,"
               "columns:map<string,struct<name:string,description:string>>,tags:array<string>,"
               "meta:map<string,string>,attached_node:string>>")


def manifest_nodes(manifests: DataFrame, json_col: str = "nodes_json") -> DataFrame:
    """S-16 / R-7 / N-8 / N-9: manifest node maps -> one row per node with
    materialisation (unknown -> OTHER), code (raw_code, else the older raw_sql),
    columns, parents split by kind, and owners from meta."""
    x = manifests.select(F.explode(F.from_json(F.col(json_col), NODE_SCHEMA)).alias("unique_id", "n"))
    deps = F.coalesce(F.col("n.depends_on.nodes"), F.array().cast("array<string>"))
    owner = F.col("n.meta")["owner"]
    return x.select(
        "unique_id", F.col("n.resource_type").alias("resource_type"), F.col("n.name").alias("name"),
        lookup(F.col("n.config.materialized"), MATERIALIZATIONS, "OTHER").alias("materialization"),
        F.coalesce(F.col("n.raw_code"), F.col("n.raw_sql")).alias("code"),
        F.size(F.coalesce(F.map_keys(F.col("n.columns")), F.array())).alias("n_columns"),
        F.filter(deps, lambda d: d.startswith("model.") | d.startswith("snapshot.")).alias("parent_models"),
        F.filter(deps, lambda d: d.startswith("source.")).alias("parent_sources"),
        F.when(owner.isNotNull(), F.transform(F.split(owner, r"\s*,\s*"),
                                              lambda o: F.when(o.contains("@"), o).otherwise(F.concat(o, F.lit("@example.com")))))
        .alias("owners"),
        F.col("n.attached_node").alias("attached_node"),
        deps.alias("depends_on"),
    )


def should_include(*aspects) -> Column:
    """P-15: keep an entity only if some aspect is set."""
    return F.coalesce(*[col_of(a) for a in aspects]).isNotNull()


def test_results(tests: DataFrame, results: DataFrame) -> DataFrame:
    """J-11 / A-20 / M-7: tests joined to their run results; the model is the
    attached node, else the first dependency; only model targets; status via a
    fixed map; last run = latest completion among the timings."""
    model = F.coalesce(F.col("attached_node"), F.get(F.col("depends_on"), 0))
    t = tests.withColumn("model", model).filter(F.col("model").startswith("model."))
    r = results.select("unique_id", "status",
                       F.array_max(F.transform("timing", lambda x: x["completed_at"])).alias("last_run"))
    return t.join(r, "unique_id", "left").select(
        "unique_id", "model", lookup("status", TEST_STATUS, "UNKNOWN").alias("status"), "last_run")


OPENAPI_SCHEMA = "map<string,map<string,struct<summary:string,tags:array<string>,operationId:string>>>"
HTTP_METHODS = ("get", "put", "post", "delete", "options", "head", "patch", "trace")


def openapi_endpoints(specs: DataFrame, base_url: str, json_col: str = "paths_json") -> DataFrame:
    """S-17 / R-10 / F-19: API spec path maps -> (endpoint url, method, summary,
    tags); only HTTP methods count."""
    p = specs.select("*", F.explode(F.from_json(F.col(json_col), OPENAPI_SCHEMA)).alias("path", "ops"))
    m = p.select("*", F.explode("ops").alias("method", "op")).filter(F.lower("method").isin(*HTTP_METHODS))
    return m.select(F.concat(F.lit(base_url.rstrip("/")), F.col("path")).alias("endpoint"),
                    F.upper("method").alias("method"), F.col("op.summary").alias("summary"),
                    F.col("op.tags").alias("tags"))


# ----------------------------------------------------------- BI / ETL

def topic_subjects(topics: DataFrame, subjects: DataFrame, strategy: str) -> DataFrame:
    """J-13: topic -> schema subjects by naming strategy: 'topic' (topic-key /
    topic-value), 'record' (record name, via the topic's record table) or
    'topic_record' (topic-record-key/value)."""
    if strategy == "topic":
        cand = topics.select("topic", F.explode(F.array(F.concat("topic", F.lit("-key")),
                                                       F.concat("topic", F.lit("-value")))).alias("subject"))
    elif strategy == "topic_record":
        cand = topics.select("topic", F.explode(F.array(F.concat_ws("-", "topic", "record", F.lit("key")),
                                                       F.concat_ws("-", "topic", "record", F.lit("value")))).alias("subject"))
    else:
        cand = topics.select("topic", F.col("record").alias("subject"))
    return cand.join(subjects.select("subject"), "subject")


def distinct_subscribers(subs: DataFrame, users: DataFrame, size: int = LENGTH) -> DataFrame:
    """J-16: distinct (subscription, user) joined to users, users nested per
    subscription in chunks of at most ``size``."""
    x = subs.select("subscription_id", "user_id").distinct().join(users, "user_id")
    return nested_lists(x, ["subscription_id"], ["email", "user_id"], F.col("email"), "emails", size)


def fold_app_dashboards(dash: DataFrame) -> DataFrame:
    """J-17: app copies (id parsed from their url) folded into originals: an
    original gets its app copy's id, the copies disappear (anti join)."""
    app = dash.filter(F.col("url").contains("/apps/")).select(
        F.regexp_extract("url", r"/dashboards/([^/?]+)", 1).alias("orig_id"), F.col("dashboard_id").alias("app_id"))
    out = dash.join(app, dash.dashboard_id == app.orig_id, "left").drop("orig_id")
    return out.join(app.select(F.col("app_id").alias("dashboard_id")), "dashboard_id", "left_anti")


def display_names(rows: DataFrame, users: DataFrame, id_col: str) -> DataFrame:
    """J-10: ids -> display name or e-mail (broadcast lookup when the user
    table is small enough to ship; a shuffle join otherwise)."""
    u = users.select(F.col("user_id").alias(id_col), F.coalesce("display_name", "email").alias("display_name"))
    return rows.join(u, id_col, "left").withColumn("display_name", F.coalesce("display_name", F.col(id_col).cast("string")))


def activity_rows(activities: DataFrame, kinds: Sequence[str]) -> DataFrame:
    """R-5 / R-17: view activities that carry an artifact id and an e-mail."""
    return activities.filter(F.col("activity").isin(*kinds) & F.col("artifact_id").isNotNull()
                             & F.col("email").isNotNull())


# Properties of a view of which it has one, its own or the nearest ancestor's.
EXCLUDING = ("sql_table_name", "derived_table")


def extends_chain(views: DataFrame, props: DataFrame, excluding: Sequence[Sequence[str]] = (EXCLUDING,)) -> DataFrame:
    """G-7: properties merged along the 'extends' chain (the view itself wins
    over its ancestors); a view whose chain is broken has its own only. Of each group
    of ``excluding`` properties only those at the nearest view that has one are kept."""
    from lakelens.operators.graph import ancestor_rows
    rows = ancestor_rows(views.select(F.col("view").alias("id"), F.col("extends").alias("parent_id"))).filter(~F.col("broken") | (F.col("dist") == 0))
    group = F.col("key")
    for i, members in enumerate(excluding):
        group = F.when(F.col("key").isin(*members), F.lit(f"#{i}")).otherwise(group)
    x = rows.join(props.select(F.col("view").alias("anc"), "key", "value", group.alias("group")), "anc")
    nearest = x.groupBy("node", "group").agg(F.min("dist").alias("dist"))
    return x.join(nearest, ["node", "group", "dist"]).select(F.col("node").alias("view"), "key", "value")
