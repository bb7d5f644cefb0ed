"""Catalog assembly from landed information-schema tables (J-1 .. J-8, R-1, R-2,
R-9, A-13, A-19, U-1 .. U-3), and stored catalog statistics / properties of
Spark catalog tables (A-5, R-18).

Inputs are DataFrames shaped like information-schema views. Every nesting is a
``groupBy(table keys).agg(collect_list(struct))`` whose group size is bounded by
one table's own width (its columns, tags or constraints), never by the data
volume; nested arrays are sorted so the output is deterministic.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakelens.functions.scalars import col_of

TABLE_KEYS = ("table_catalog", "table_schema", "table_name")


def _tag_struct() -> Column:
    return F.struct(F.col("tag_name"), F.col("tag_value"))


def nest_tags(tags: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys..., tag_name, tag_value) -> (keys..., tags ARRAY<STRUCT>) sorted by name, value."""
    return tags.groupBy(*keys).agg(F.array_sort(F.collect_list(_tag_struct())).alias("tags"))


def nested_tables(tables: DataFrame, views: DataFrame, table_tags: DataFrame, columns: DataFrame,
                  column_tags: DataFrame, keys: Sequence[str] = TABLE_KEYS) -> DataFrame:
    """J-1: tables left-join views and table tags; columns left-join column
    tags, nested per table (ordered by ordinal position, then name)."""
    keys = list(keys)
    tt = nest_tags(table_tags, keys)
    ct = nest_tags(column_tags, [*keys, "column_name"])
    cols = columns.join(ct, [*keys, "column_name"], "left")
    cf = cols.groupBy(*keys).agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct(
                F.col("ordinal_position"), F.col("column_name"), F.col("data_type"), F.col("data_precision"),
                F.col("is_nullable"), F.col("comment"), F.col("tags")))),
            lambda s: s.dropFields("ordinal_position"),
        ).alias("columns")
    )
    return (
        tables.join(views.select(*keys, "view_definition"), keys, "left")
        .join(tt, keys, "left")
        .join(cf, keys, "left")
    )


def hierarchy_with_tags(objects: DataFrame, tags: DataFrame, keys: Sequence[str]) -> DataFrame:
    """J-2 / R-9: catalog or schema rows with their tags nested."""
    return objects.join(nest_tags(tags, keys), list(keys), "left")


def columns_into_tables(tables: DataFrame, columns: DataFrame, keys: Sequence[str] = TABLE_KEYS) -> DataFrame:
    """J-3: columns attached to known tables only (inner), ordered by ordinal."""
    keys = list(keys)
    known = columns.join(tables.select(*keys), keys, "left_semi")
    return known.groupBy(*keys).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("ordinal_position", "column_name", "data_type"))),
                    lambda s: s.dropFields("ordinal_position")).alias("columns")
    )


def key_flags(columns: DataFrame, constraints: DataFrame, keys: Sequence[str] = TABLE_KEYS) -> DataFrame:
    """J-5 / J-7: primary / unique flags folded onto columns with ``bool_or``
    (duplicate index rows collapse); the column match is case-insensitive."""
    keys = list(keys)
    c = constraints.withColumn("__col", F.lower("column_name")).groupBy(*keys, "__col").agg(
        F.bool_or(F.col("constraint_type") == "PRIMARY KEY").alias("is_primary_key"),
        F.bool_or(F.col("constraint_type").isin("UNIQUE", "PRIMARY KEY")).alias("is_unique"),
    )
    out = columns.withColumn("__col", F.lower("column_name")).join(c, [*keys, "__col"], "left").drop("__col")
    return out.fillna(False, ["is_primary_key", "is_unique"])


def zip_foreign_keys(fks: DataFrame) -> DataFrame:
    """J-6: one row per (constrained column, referred column) pair; constraints
    whose column lists differ in length are dropped."""
    ok = fks.filter(F.size("constrained_columns") == F.size("referred_columns"))
    return ok.select(
        *[c for c in fks.columns if c not in ("constrained_columns", "referred_columns")],
        F.posexplode(F.arrays_zip(F.col("constrained_columns").alias("col"), F.col("referred_columns").alias("ref"))),
    ).select("*", F.col("col.col").alias("column_name"), F.col("col.ref").alias("referred_column")).drop("col")


def overlay(base: DataFrame, extra: DataFrame, keys: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """J-8: left-join extra facts; a non-null new value replaces the old one."""
    keys = list(keys)
    e = extra.select(*keys, *[F.col(f).alias(f"__new_{f}") for f in fields])
    out = base.join(e, keys, "left")
    for f in fields:
        if f in base.columns:
            out = out.withColumn(f, F.coalesce(F.col(f"__new_{f}"), F.col(f)))
        else:
            out = out.withColumn(f, F.col(f"__new_{f}"))
        out = out.drop(f"__new_{f}")
    return out


def map_values(c, mapping: dict, default: str | None = None) -> Column:
    """R-2 / R-4: enum mapping through a literal map; unknown -> default."""
    m = F.create_map(*[x for k, v in mapping.items() for x in (F.lit(k), F.lit(v))])
    out = m[F.upper(col_of(c))]
    return F.coalesce(out, F.lit(default)) if default is not None else out


def union_distinct(*dfs: DataFrame) -> DataFrame:
    """U-1."""
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d)
    return out.distinct()


def union_all(*dfs: DataFrame) -> DataFrame:
    """U-2 / U-5 (missing columns filled with null)."""
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d, allowMissingColumns=True)
    return out


def minus(left: DataFrame, *rights: DataFrame, keys: Sequence[str]) -> DataFrame:
    """U-3: rows of ``left`` whose keys appear in none of ``rights`` (anti joins)."""
    out = left
    for r in rights:
        out = out.join(r.select(*keys), list(keys), "left_anti")
    return out


def fields_per_table(columns: DataFrame, keys: Sequence[str]) -> DataFrame:
    """A-19: one row per table with its fields nested (no repeats across catalogs)."""
    return columns.groupBy(*keys).agg(
        F.array_sort(F.collect_list(F.struct("ordinal_position", "column_name", "data_type"))).alias("fields"))


def concat_constraint_columns(key_usage: DataFrame, keys: Sequence[str]) -> DataFrame:
    """A-13: constraint columns concatenated in position order."""
    return key_usage.groupBy(*keys).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("position", "column_name"))),
                                 lambda s: s["column_name"]), ",").alias("columns"))


def stored_statistics(spark, table: str, columns: Sequence[str], analyze: bool = True) -> DataFrame:
    """A-5: statistics kept by the catalog. Runs ``ANALYZE TABLE ... COMPUTE
    STATISTICS FOR COLUMNS`` (the scan is a Spark job), then reads the stored
    table size / rows and each column's distinct count, nulls, min and max with
    ``DESCRIBE EXTENDED``. The commands return metadata rows only (a handful
    per column), never table data."""
    if analyze:
        cols = ", ".join(f"`{c}`" for c in columns)
        spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS FOR COLUMNS {cols}")
    rows = []
    for c in columns:
        info = {r["info_name"]: r["info_value"] for r in spark.sql(f"DESCRIBE EXTENDED {table} `{c}`").collect()}
        rows.append((c, info.get("distinct_count"), info.get("num_nulls"), info.get("min"), info.get("max")))
    stats = spark.sql(f"DESCRIBE EXTENDED {table}").filter(F.col("col_name") == "Statistics").select("data_type").collect()
    text = stats[0][0] if stats else ""
    size = re.search(r"(\d+) bytes", text or "")
    nrows = re.search(r"(\d+) rows", text or "")
    df = spark.createDataFrame(rows, "column_name string, distinct_count string, num_nulls string, min string, max string")
    return df.select(
        "column_name", F.col("distinct_count").cast("double").alias("distinct_value_count"),
        F.col("num_nulls").cast("double").alias("null_value_count"),
        F.when(F.col("min") != "NULL", F.col("min")).alias("min_value"),
        F.when(F.col("max") != "NULL", F.col("max")).alias("max_value"),
        F.lit(float(size.group(1)) if size else None).cast("double").alias("data_size_bytes"),
        F.lit(float(nrows.group(1)) if nrows else None).cast("double").alias("record_count"))


def table_properties(spark, table: str) -> DataFrame:
    """R-18: table properties as (key, value) rows (``SHOW TBLPROPERTIES``)."""
    return spark.sql(f"SHOW TBLPROPERTIES {table}").select(F.col("key"), F.col("value"))
