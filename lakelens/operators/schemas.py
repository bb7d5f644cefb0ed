"""Schema operators (N-2 .. N-5): nested schema flattening, schema inference
over JSON documents, Avro schema walks, and the root of a message graph.

Spark has no recursive types, so schema trees are flattened into one row per
field path. Documents are opened as VARIANT values on the JVM; the walks of schema
texts run inside tasks (``mapInPandas``), where each row is small. All cross-row work
(counting types, deciding nullability) is a Spark aggregation.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakelens.session import cut_lineage


def _encode(name: str) -> str:
    return name.lower().replace(".", "%2E").replace("<", "%3C").replace(">", "%3E")


def _join(parent: str, name: str) -> str:
    return f"{parent.lower()}.{_encode(name)}" if parent else _encode(name)


# ---------------------------------------------------------------- N-2

FLAT_SCHEMA = T.StructType([
    T.StructField("key", T.StringType()), T.StructField("field_path", T.StringType()),
    T.StructField("field_name", T.StringType()), T.StructField("native_type", T.StringType()),
    T.StructField("nullable", T.BooleanType()), T.StructField("depth", T.IntegerType()),
    T.StructField("parent_path", T.StringType()),
])


def _walk_table_schema(fields, parent: str, depth: int, key, out: list) -> None:
    for f in fields or []:
        mode = (f.get("mode") or "NULLABLE").upper()
        ftype = str(f.get("type", ""))
        path = _join(parent, f["name"])
        native = f"ARRAY<{ftype}>" if mode == "REPEATED" else ftype
        out.append((key, path, f["name"], native, mode == "NULLABLE", depth, parent or None))
        if f.get("fields"):
            _walk_table_schema(f["fields"], path, depth + 1, key, out)


def flatten_table_schemas(df: DataFrame, key: str, schema_json: str) -> DataFrame:
    """N-2 / X-3 (a table function via mapInPandas): rows of (key, schema JSON = list of {name, type, mode, fields}) ->
    one row per field path; REPEATED becomes ARRAY<type>, paths lower-case and
    encoded, nested paths joined with '.'."""
    def run(batches):
        import pandas as pd
        for pdf in batches:
            out: list = []
            for k, s in zip(pdf[key], pdf[schema_json]):
                if s is None:
                    continue
                _walk_table_schema(json.loads(s), "", 0, k, out)
            yield pd.DataFrame(out, columns=[f.name for f in FLAT_SCHEMA.fields])
    return df.select(F.col(key).cast("string").alias(key), schema_json).mapInPandas(run, FLAT_SCHEMA)


def flatten_struct_type(spark, dt: T.StructType) -> DataFrame:
    """N-2 for a DataFrame's own schema (driver-side metadata, one row per path)."""
    rows: list = []

    def walk(t: T.DataType, parent: str, depth: int):
        if isinstance(t, T.StructType):
            for f in t.fields:
                path = _join(parent, f.name)
                rows.append((path, f.name, f.dataType.simpleString(), f.nullable, depth))
                walk(f.dataType, path, depth + 1)
        elif isinstance(t, T.ArrayType):
            walk(t.elementType, parent, depth)
        elif isinstance(t, T.MapType):
            walk(t.valueType, parent, depth)

    walk(dt, "", 0)
    return spark.createDataFrame(rows, "field_path string, field_name string, native_type string, nullable boolean, depth int")


# ---------------------------------------------------------------- N-3

LEVELS = 4  # levels of a document that one pass over the documents opens

_NODE = "array<struct<path:array<string>,value:variant>>"


def _object(value: Column) -> Column:
    return F.try_variant_get(value, "$", "map<string,variant>")


def _list(value: Column) -> Column:
    return F.try_variant_get(value, "$", "array<variant>")


def _fields(members: Column, path: Column) -> Column:
    """Nodes of an object's members."""
    return F.transform(F.map_entries(members), lambda e: F.struct(F.array_append(path, e["key"]).alias("path"), e["value"].alias("value")))


def _below(nodes: Column) -> Column:
    """The next level: fields of the objects among ``nodes``, and of the objects that
    are items of their lists, in document order."""
    none = F.array().cast(_NODE)

    def one(node: Column) -> Column:
        items = F.transform(_list(node["value"]), lambda x: F.coalesce(_fields(_object(x), node["path"]), none))
        return F.coalesce(_fields(_object(node["value"]), node["path"]), F.flatten(items), none)
    return F.flatten(F.transform(nodes, one))


def _kind(value: Column) -> Column:
    """Native type of a value; null for JSON nulls. Numbers written with a point or an
    exponent are floats: as decimals without a scale they have at most 18 digits, which
    integers of that length do not become."""
    found = F.schema_of_variant(value)
    return (F.when(value.isNull(), None).when(_object(value).isNotNull(), "object").when(_list(value).isNotNull(), "array").when(F.is_variant_null(value), None)
            .when(found == "STRING", "string").when(found == "BOOLEAN", "bool").when(found == "BIGINT", "int")
            .when(found.endswith(",0)") & (F.regexp_extract(found, r"\((\d+),", 1).try_cast("int") > 18), "int").otherwise("float"))


def _summary(nodes: DataFrame) -> DataFrame:
    """Mergeable counts of (seq, at, path, value) rows by path and type: values, lists
    without items, objects among list items, and where the first one stands."""
    typed = nodes.select("path", _kind(F.col("value")).alias("kind"), "value", (F.col("seq").cast("decimal(38,0)") * (1 << 31) + F.col("at")).cast("decimal(38,0)").alias("place"))
    items = F.when(F.col("kind") == "array", _list(F.col("value")))
    typed = typed.select("path", "kind", "place", F.size(items).alias("length"), F.size(F.filter(items, lambda x: _object(x).isNotNull())).alias("members"))
    return typed.groupBy("path", "kind").agg(
        F.count("*").alias("n"), F.count_if(F.col("length") == 0).alias("hollow"), F.sum(F.greatest("members", F.lit(0))).alias("members"),
        F.min("place").alias("first"))


def infer_schema(docs: DataFrame, doc_col: str, seq_col: str) -> DataFrame:
    """N-3 / O-6: one row per field path of a document collection: ``path`` (its keys),
    ``field_path`` (joined by dots), its native type (one type: that; int and float:
    float; else the most common, ties: the first seen), how many values were seen, and
    whether it is nullable: some document is no object or lacks the field somewhere,
    holds null, an empty list or a plain value on the way.

    Documents are opened level by level as VARIANT values, a few levels in one pass. The
    per-path summaries are counts that add up in any order. A path is present
    everywhere if its parent is, the parent has no empty list and no plain value, and
    there are as many values as objects that could hold one; so presence needs no second
    look at the documents."""
    root = docs.select(F.col(seq_col).cast("long").alias("seq"), F.try_parse_json(doc_col).alias("value"))
    no_path = F.array().cast("array<string>")
    first = F.coalesce(_fields(_object(F.col("value")), no_path), F.array().cast(_NODE))
    frontier = root.select("seq", F.array(F.struct(no_path.alias("path"), "value")).alias("done"), F.explode(F.array(first)).alias("nodes"))
    parts = []
    while True:
        opened = frontier
        for _ in range(LEVELS - 1):
            # The generator keeps the optimizer from computing a level once for each use.
            opened = opened.select("seq", F.concat("done", "nodes").alias("done"), F.explode(F.array(_below(F.col("nodes")))).alias("nodes"))
        rows = opened.select("seq", F.posexplode(F.concat("done", "nodes")).alias("at", "node")).select("seq", "at", "node.*")
        parts.append(cut_lineage(_summary(rows)))
        deepest = LEVELS * len(parts)
        if parts[-1].filter((F.size("path") >= deepest) & ((F.col("kind") == "object") | (F.col("members") > 0))).isEmpty():
            break
        frontier = opened.select("seq", F.array().cast(_NODE).alias("done"), F.explode(F.array(_below(F.col("nodes")))).alias("nodes"))
    counts = parts[0]
    for more in parts[1:]:
        counts = counts.unionByName(more)
    known = F.col("kind").isNotNull()
    paths = counts.groupBy("path").agg(
        F.array_sort(F.collect_set("kind")).alias("types"), F.sum(F.when(known, F.col("n"))).alias("n"),
        F.max_by("kind", F.when(known, F.struct("n", -F.col("first")))).alias("most"),
        F.sum(F.when(F.col("kind") == "object", F.col("n")).otherwise(F.col("members"))).alias("holders"),
        F.sum(F.when(known & ~F.col("kind").isin("object", "array"), F.col("n")).otherwise(F.col("hollow"))).alias("barren"),
        F.sum(F.when(~known, F.col("n")).otherwise(0)).alias("nulls"))
    # A path is complete below its parent; the root is, if every document is an object.
    above = paths.select(F.col("path").alias("up"), F.col("holders").alias("could"), F.col("barren").alias("lost"),
                         ((F.size("path") == 0) & ((F.col("types") != F.array(F.lit("object"))) | (F.col("nulls") > 0))).alias("odd"))
    below = paths.filter((F.size("path") > 0) & F.col("n").isNotNull()).withColumn("up", F.slice("path", 1, F.size("path") - 1))
    whole = below.join(above, "up").select("path", ((F.col("n") == F.col("could")) & (F.col("lost") == 0) & ~F.col("odd")).alias("whole"))
    steps = below.select("path", F.explode(F.transform(F.sequence(F.lit(1), F.size("path")), lambda k: F.slice("path", 1, k))).alias("step"))
    chains = steps.join(whole.select(F.col("path").alias("step"), "whole"), "step").groupBy("path").agg(F.bool_and("whole").alias("whole"))
    native = (F.when(F.size("types") == 1, F.col("types")[0]).when(F.col("types") == F.array(F.lit("float"), F.lit("int")), "float").otherwise(F.col("most")))
    return below.join(chains, "path").select("path", F.array_join("path", ".").alias("field_path"), native.alias("native_type"),
                                             F.col("n").cast("long").alias("n"), (~F.col("whole")).alias("nullable"))



# ---------------------------------------------------------------- N-4

AVRO_ROWS = T.StructType([
    T.StructField("key", T.StringType()), T.StructField("field_path", T.StringType()),
    T.StructField("native_type", T.StringType()), T.StructField("nullable", T.BooleanType()),
    T.StructField("depth", T.IntegerType()),
])


def _avro_type_name(t) -> str:
    if isinstance(t, str):
        return t.upper() if t in ("null", "boolean", "int", "long", "float", "double", "bytes", "string") else t
    if isinstance(t, list):
        return "UNION<" + ",".join(_avro_type_name(x) for x in t) + ">"
    kind = t.get("type")
    if kind == "record":
        return "RECORD"
    if kind == "array":
        return "ARRAY<" + _avro_type_name(t.get("items")) + ">"
    if kind == "map":
        return "MAP<STRING," + _avro_type_name(t.get("values")) + ">"
    if kind == "enum":
        return "ENUM"
    if kind == "fixed":
        return "FIXED"
    return _avro_type_name(kind) if isinstance(kind, (str, list)) else str(kind)


def _avro_children(t):
    """Record fields reachable below a type (through arrays, maps, unions)."""
    if isinstance(t, list):
        for x in t:
            yield from _avro_children(x)
    elif isinstance(t, dict):
        if t.get("type") == "record":
            yield from t.get("fields", [])
        elif t.get("type") == "array":
            yield from _avro_children(t.get("items"))
        elif t.get("type") == "map":
            yield from _avro_children(t.get("values"))
        elif isinstance(t.get("type"), (dict, list)):
            yield from _avro_children(t.get("type"))


def _walk_avro(fields, parent: str, depth: int, key, out: list) -> None:
    for f in fields:
        t = f.get("type")
        path = _join(parent, f["name"])
        nullable = isinstance(t, list) and "null" in t
        if nullable and len([x for x in t if x != "null"]) == 1:
            t = next(x for x in t if x != "null")
        out.append((key, path, _avro_type_name(t), nullable, depth))
        _walk_avro(list(_avro_children(t)), path, depth + 1, key, out)


def flatten_avro(df: DataFrame, key: str, schema_json: str) -> DataFrame:
    """N-4: Avro schema texts -> one row per field path (records nest, arrays
    and maps show their element type, ['null', T] is a nullable T)."""
    def run(batches):
        import pandas as pd
        for pdf in batches:
            out: list = []
            for k, s in zip(pdf[key], pdf[schema_json]):
                if s is None:
                    continue
                root = json.loads(s)
                _walk_avro(list(_avro_children(root)), "", 0, k, out)
            yield pd.DataFrame(out, columns=[f.name for f in AVRO_ROWS.fields])
    return df.select(F.col(key).cast("string").alias(key), schema_json).mapInPandas(run, AVRO_ROWS)


# ---------------------------------------------------------------- N-5

def root_messages(refs: DataFrame, message: str = "message", ref: str = "ref_message") -> DataFrame:
    """N-5: top-level messages = messages that no field of another message
    refers to (anti join on the reference table)."""
    msgs = refs.select(F.col(message).alias("message")).distinct()
    used = refs.filter(F.col(ref).isNotNull() & (F.col(ref) != F.col(message))).select(F.col(ref).alias("message")).distinct()
    return msgs.join(used, "message", "left_anti")
