"""Connector-side relational mappings (J-12, J-14, J-18, J-20 .. J-22, J-25,
G-8, G-11, G-12, R-8, R-12, P-11, P-14, P-17, Q-7, Q-8).

All are joins / explodes / aggregations over landed tables. Nested outputs are
built only where the group is one entity's own list (a table's columns, a
chart's fields); fan-in that can grow with the data stays in long form.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakelens.functions import names
from lakelens.functions.scalars import col_of


def nest_schemas(schemas: DataFrame, tables: DataFrame, columns: DataFrame) -> DataFrame:
    """J-12: replication connector schemas -> tables -> columns by parent id;
    orphans (no parent) are dropped by the inner joins; columns nested per table."""
    t = tables.join(schemas, tables.schema_id == schemas.id_schema).drop("id_schema")
    c = columns.join(t.select("table_id"), "table_id")
    nested = c.groupBy("table_id").agg(F.array_sort(F.collect_list(F.struct("column_name", "source_column"))).alias("columns"))
    return t.join(nested, "table_id", "left")


def replication_edges(nested: DataFrame) -> DataFrame:
    """G-11: destination table / column <- source table / column rows."""
    x = nested.select("dest_table", "source_table", F.explode_outer("columns").alias("c"))
    return x.select("dest_table", "source_table", F.col("c.column_name").alias("dest_column"),
                    F.col("c.source_column").alias("source_column"))


def catalog_dump(tables: DataFrame, columns: DataFrame, tags: DataFrame, owners: DataFrame) -> DataFrame:
    """J-14: table -> columns -> column tags -> owner from another catalog's dump."""
    ct = tags.groupBy("column_id").agg(F.array_sort(F.collect_set("tag")).alias("tags"))
    c = columns.join(ct, "column_id", "left")
    per_table = c.groupBy("table_id").agg(
        F.array_sort(F.collect_list(F.struct("column_name", F.coalesce("tags", F.array().cast("array<string>")).alias("tags"))))
        .alias("columns"))
    return tables.join(per_table, "table_id", "left").join(owners, "table_id", "left")


def mapping_lineage(mappings: DataFrame, connections: DataFrame, keep: bool = False) -> DataFrame:
    """J-18: ETL mapping references -> (source, target) tables through their
    connections (database from the connection, schema/table from the object
    path 'schema/table'). With ``keep`` a mapping whose connection is unknown
    stays, with a null table."""
    how = "left" if keep else "inner"
    c = connections.select(F.col("connection_id").alias("cid"), F.col("database").alias("db"))
    s = mappings.join(c.withColumnRenamed("cid", "source_connection").withColumnRenamed("db", "source_db"), "source_connection", how)
    s = s.join(c.withColumnRenamed("cid", "target_connection").withColumnRenamed("db", "target_db"), "target_connection", how)
    sp, tp = F.split("source_object", "/"), F.split("target_object", "/")
    return s.select("mapping_id",
                    F.when(F.col("source_db").isNotNull(), F.lower(F.concat_ws(".", "source_db", F.get(sp, 0), F.get(sp, 1)))).alias("source_table"),
                    F.when(F.col("target_db").isNotNull(), F.lower(F.concat_ws(".", "target_db", F.get(tp, 0), F.get(tp, 1)))).alias("target_table"))


def card_sources(cards: DataFrame, tables: DataFrame, databases: DataFrame, platform_map: dict) -> DataFrame:
    """J-20: card -> table -> database -> dataset id; a native-SQL card keeps
    its query text instead (its lineage comes from the SQL)."""
    m = F.create_map(*[x for k, v in platform_map.items() for x in (F.lit(k), F.lit(v))])
    x = cards.join(tables, "table_id", "left").join(databases, "database_id", "left")
    name = F.lower(F.concat_ws(".", "db_name", "schema_name", "table_name"))
    return x.select("card_id",
                    F.when(F.col("native_sql").isNull() & F.col("table_name").isNotNull(),
                           names.dataset_id(name, m[F.col("engine")])).alias("source_dataset"),
                    F.col("native_sql").alias("query"))


def workbook_sources(embedded: DataFrame, published: DataFrame, custom_sql: DataFrame) -> DataFrame:
    """J-21: workbook upstreams: custom SQL sources win over upstream tables;
    an embedded source is skipped when a published one has the same name."""
    emb = embedded.join(published.select("workbook_id", "source_name"), ["workbook_id", "source_name"], "left_anti")
    both = emb.select("workbook_id", "source_name", "upstream_table").unionByName(
        published.select("workbook_id", "source_name", "upstream_table"))
    cs = custom_sql.select("workbook_id", "source_name", F.col("sql_table").alias("__custom"))
    return both.join(cs, ["workbook_id", "source_name"], "left").select(
        "workbook_id", "source_name", F.coalesce("__custom", "upstream_table").alias("upstream_table"))


def field_references(viz: DataFrame, columns: DataFrame) -> DataFrame:
    """J-22: visualization column references -> (entity, field); references
    that resolve to nothing are dropped."""
    r = viz.select("viz_id", F.explode("column_refs").alias("column_ref"))
    return r.join(columns, "column_ref").select("viz_id", "entity_id", "field")


def storage_views(mvs: DataFrame, catalog: str) -> DataFrame:
    """J-25: materialised view <-> its storage table: lineage from the storage
    table to the view, both as dataset ids."""
    view = F.lower(F.concat_ws(".", F.lit(catalog), "view_schema", "view_name"))
    store = F.lower(F.concat_ws(".", F.lit(catalog), "storage_schema", "storage_table"))
    return mvs.select(view.alias("view"), store.alias("storage"),
                      names.dataset_id(view, F.lit("TRINO")).alias("view_id"),
                      names.dataset_id(store, F.lit("TRINO")).alias("storage_id"))


def explore_upstreams(explores: DataFrame, joins: DataFrame) -> DataFrame:
    """G-8: explore upstream = base view plus joined views, de-duplicated (long form)."""
    base = explores.select("explore", F.col("base_view").alias("view"))
    return base.unionByName(joins.select("explore", F.col("joined_view").alias("view"))).distinct()


def dashboard_upstreams(charts: DataFrame, explores: DataFrame) -> DataFrame:
    """G-12: chart -> explore -> dashboard: the distinct explores behind each
    dashboard's charts (long form)."""
    c = charts.select("dashboard", F.explode("filterables").alias("explore"))
    return c.join(explores.select("explore").distinct(), "explore").select("dashboard", "explore").distinct()


def latest_docs(docs: DataFrame) -> DataFrame:
    """R-8: per (dataset, lower(column)) the latest description; empty ones removed."""
    d = docs.withColumn("column", F.lower("column")).filter(F.coalesce(F.col("description"), F.lit("")) != "")
    # Ties on the sequence are broken by the text itself, so reruns agree.
    return d.groupBy("dataset", "column").agg(F.max_by("description", F.struct("seq", "description")).alias("description"))


def column_formulas(columns: DataFrame, formulas: DataFrame) -> DataFrame:
    """R-12: column -> formula expression: a formula entry is keyed by formula
    id and by name; a column looks up its formula id, else its name."""
    f = formulas.select(F.explode(F.array(
        F.struct(F.col("formula_id").alias("key"), F.col("expr")),
        F.struct(F.col("formula_name").alias("key"), F.col("expr")))).alias("f")).select("f.key", "f.expr").distinct()
    key = F.coalesce(F.col("formula_id"), F.col("column_name"))
    return columns.withColumn("key", key).join(f, "key", "left").drop("key")


def valid_endpoints(datasets) -> Column:
    """P-11: keep queried datasets whose database, schema and table are all non-empty."""
    return F.filter(col_of(datasets), lambda d: (F.coalesce(d["database"], F.lit("")) != "")
                    & (F.coalesce(d["schema"], F.lit("")) != "") & (F.coalesce(d["table"], F.lit("")) != ""))


def include_ids(c, includes: Sequence[str] | None = None, excludes: Sequence[str] | None = None,
                prefixes: Sequence[str] | None = None) -> Column:
    """P-14: id-list includes / excludes and path-prefix includes."""
    x = col_of(c)
    cond = F.lit(True)
    if includes:
        cond = cond & x.isin(*includes)
    if excludes:
        cond = cond & ~x.isin(*excludes)
    if prefixes:
        p = F.lit(False)
        for pre in prefixes:
            p = p | x.startswith(pre)
        cond = cond & p
    return cond


def no_dotted_parts(*parts) -> Column:
    """P-17: names whose parts contain a dot are dropped."""
    cond = F.lit(True)
    for p in parts:
        cond = cond & ~F.coalesce(col_of(p).contains("."), F.lit(False))
    return cond


def fully_qualified(table) -> Column:
    """Q-8: custom-SQL sources count only when fully qualified (three parts)."""
    return F.size(F.split(col_of(table), r"\.")) == 3


def only_types(c, types: Sequence[str]) -> Column:
    """P-13: profile only the chosen materialisations."""
    return F.upper(col_of(c)).isin(*[t.upper() for t in types])


def dashboard_charts(dashboards: DataFrame, cards: DataFrame) -> DataFrame:
    """R-6: BI dashboards with their charts (cards joined by id, nested per
    dashboard, ordered by position; one dashboard's own list)."""
    d = dashboards.select("dashboard_id", "title", F.posexplode("card_ids").alias("position", "card_id"))
    x = d.join(cards, "card_id")
    return x.groupBy("dashboard_id", "title").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("position", "card_id", "chart_type"))),
                    lambda c: c.dropFields("position")).alias("charts"))


def semantic_tables(models: DataFrame) -> DataFrame:
    """R-11: semantic-model tables -> (table, columns, measures) with names and
    expressions flattened from nested arrays (one table's own lists)."""
    t = models.select("model_id", F.explode("tables").alias("t"))
    return t.select("model_id", F.col("t.name").alias("table_name"),
                    F.transform("t.columns", lambda c: c["name"]).alias("columns"),
                    F.transform("t.measures", lambda m: F.concat(m["name"], F.lit("="), m["expression"])).alias("measures"))


def refresh_schedule(models: DataFrame, model_schedules: DataFrame, dq_schedules: DataFrame) -> DataFrame:
    """R-13: the model's own refresh schedule, else the direct-query schedule
    (with its frequency)."""
    m = model_schedules.select("model_id", F.struct("days", "times").alias("__ms"))
    d = dq_schedules.select("model_id", F.struct(F.lit(None).cast("array<string>").alias("days"),
                                                 F.array(F.concat(F.lit("every "), F.col("frequency_minutes").cast("string"),
                                                                  F.lit("m"))).alias("times")).alias("__dq"))
    x = models.join(m, "model_id", "left").join(d, "model_id", "left")
    return x.select("model_id", F.coalesce("__ms", "__dq").alias("schedule"))


def first_family(params: DataFrame, families: list[tuple[str, str, str]]) -> DataFrame:
    """R-14: data-source parameters -> (platform, database, account) from the
    first parameter family that is set, in the given order."""
    cols = [F.when(F.col(f).isNotNull(), F.struct(F.lit(platform).alias("platform"), F.col(f"{f}.{db}").alias("database"),
                                                  F.col(f"{f}.host").alias("account")))
            for f, platform, db in families]
    return params.select("source_id", F.coalesce(*cols).alias("source"))


def storage_path(kind, account, container, folder, file) -> Column:
    """R-15: storage location -> path by location kind (null parts skipped)."""
    k = col_of(kind)
    return (F.when(k == "AzureBlobStorageLocation", F.concat_ws("/", F.concat(F.lit("https://"), col_of(account), F.lit(".blob.core.windows.net")),
                                                                 col_of(container), col_of(folder), col_of(file)))
            .when(k == "AzureBlobFSLocation", F.concat_ws("/", F.concat(F.lit("abfss://"), col_of(container), F.lit("@"), col_of(account),
                                                                         F.lit(".dfs.core.windows.net")), col_of(folder), col_of(file)))
            .otherwise(F.concat_ws("/", col_of(folder), col_of(file))))


def extra_items(**values) -> Column:
    """R-16: table extras as (key, value) items, null values left out."""
    items = F.array(*[F.struct(F.lit(k).alias("key"), col_of(v).cast("string").alias("value")) for k, v in values.items()])
    return F.filter(items, lambda i: i["value"].isNotNull())


def suite_monitors(results: DataFrame) -> DataFrame:
    """M-5: validation-suite results -> one monitor per suite: status from all
    expectations, targeted columns, and the failed expectations as exceptions."""
    r = results.select("suite", "dataset", F.explode("results").alias("r"))
    return r.groupBy("suite", "dataset").agg(
        F.when(F.bool_and("r.success"), F.lit("PASSED")).otherwise(F.lit("ERROR")).alias("status"),
        F.array_sort(F.array_distinct(F.collect_list("r.column"))).alias("columns"),
        F.array_sort(F.collect_list(F.when(~F.col("r.success"), F.col("r.expectation")))).alias("exceptions"))


# Stream modes and the kinds of objects that streams read.
STREAM_TYPES = {"DEFAULT": "STANDARD", "APPEND_ONLY": "APPEND_ONLY", "INSERT_ONLY": "INSERT_ONLY"}
STREAM_SOURCES = {"TABLE": "TABLE", "VIEW": "VIEW", "EXTERNAL_TABLE": "TABLE", "DIRECTORY_TABLE": "TABLE"}


def stream_catalog(streams: DataFrame) -> DataFrame:
    """T-6: stream objects as catalog rows: type by mode and source type by the kind of
    what they read (null: unknown to the maps), staleness, and lineage to each of the
    base tables, which come as one list."""
    known = lambda names, c: F.create_map(*[F.lit(x) for pair in names.items() for x in pair])[F.upper(F.replace(c, F.lit(" "), F.lit("_")))]
    each = streams.withColumn("base", F.explode_outer(F.split("base_tables", r"\s*,\s*")))
    return each.select("stream_name", known(STREAM_TYPES, F.col("mode")).alias("stream_type"), known(STREAM_SOURCES, F.col("source_kind")).alias("source_type"),
                       (F.upper("stale") == "TRUE").alias("is_stale"), F.lower("base").alias("source_table"))
