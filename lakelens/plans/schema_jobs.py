"""Schema jobs (N-2 .. N-5). Documents and schema texts are built by Spark from
``orders`` + ``lineitem`` (one per order), so the work grows with the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakelens.operators import schemas
from lakelens.plans.registry import register
from lakelens.sources.tables import read_table


def _orders_with_lines(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders")
    li = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_returnflag")
    lines = li.groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct(
        "l_linenumber", "l_partkey", "l_quantity", "l_returnflag"))).alias("lines"))
    return o.join(lines, o.o_orderkey == lines.l_orderkey)


def order_documents(spark, sf_dir):
    """One JSON document per order (nested customer, list of line items)."""
    x = _orders_with_lines(spark, sf_dir)
    k = F.col("o_orderkey")
    doc = F.struct(
        k.alias("id"),
        F.col("o_orderstatus").alias("status"),
        F.when(k % 3 == 0, F.col("o_totalprice").cast("long").cast("string")).otherwise(
            F.format_string("%.2f", F.col("o_totalprice"))).alias("__price"),
        F.when(k % 4 != 0, F.date_format("o_orderdate", "yyyy-MM-dd")).alias("when"),
        F.transform("lines", lambda l: F.struct(
            l["l_partkey"].alias("part"), l["l_quantity"].alias("qty"),
            F.when(l["l_linenumber"] != 2, l["l_returnflag"]).alias("flag"))).alias("items"),
        F.struct(F.col("o_custkey").alias("key"),
                 F.when(F.col("o_custkey") % 5 != 0, F.col("o_orderpriority")).alias("segment")).alias("customer"),
    )
    # "price" must be an integer literal for some orders and a decimal for
    # others: splice the raw number text into the JSON.
    js = F.regexp_replace(F.to_json(doc), r'"__price":"([^"]*)"', '"price":$1')
    return x.select(k.alias("doc_seq"), js.alias("doc"))


@register("infer_schema_counts", """WITH o AS (SELECT o.*, (SELECT count(*) FROM lineitem l WHERE l.l_orderkey = o.o_orderkey) AS nl,
    (SELECT count(*) FROM lineitem l WHERE l.l_orderkey = o.o_orderkey AND l.l_linenumber <> 2) AS nf
  FROM orders o WHERE o.o_orderkey IN (SELECT l_orderkey FROM lineitem)),
t AS (SELECT count(*) AS n_docs, CAST(sum(nl) AS BIGINT) AS n_items, CAST(sum(nf) AS BIGINT) AS n_flags,
        count(*) FILTER (WHERE o_orderkey % 4 <> 0) AS n_when, count(*) FILTER (WHERE o_custkey % 5 <> 0) AS n_seg,
        count(*) FILTER (WHERE nf < nl) AS n_docs_missing_flag FROM o)
SELECT 'id' AS field_path, 'int' AS native_type, CAST(n_docs AS BIGINT) AS n, FALSE AS nullable FROM t
UNION ALL SELECT 'status', 'string', n_docs, FALSE FROM t
UNION ALL SELECT 'price', 'float', n_docs, FALSE FROM t
UNION ALL SELECT 'when', 'string', n_when, n_when < n_docs FROM t
UNION ALL SELECT 'items', 'array', n_docs, FALSE FROM t
UNION ALL SELECT 'items.part', 'int', n_items, FALSE FROM t
UNION ALL SELECT 'items.qty', 'float', n_items, FALSE FROM t
UNION ALL SELECT 'items.flag', 'string', n_flags, n_docs_missing_flag > 0 FROM t
UNION ALL SELECT 'customer', 'object', n_docs, FALSE FROM t
UNION ALL SELECT 'customer.key', 'int', n_docs, FALSE FROM t
UNION ALL SELECT 'customer.segment', 'string', n_seg, n_seg < n_docs FROM t""")
def infer_schema_counts(spark, sf_dir):
    """N-3: schema inferred over JSON documents: per path type, value count, nullable."""
    return schemas.infer_schema(order_documents(spark, sf_dir), "doc", "doc_seq").drop("path")


def order_table_schemas(spark, sf_dir):
    x = _orders_with_lines(spark, sf_dir)
    fields = F.array(
        F.struct(F.lit("id").alias("name"), F.lit("INTEGER").alias("type"), F.lit("REQUIRED").alias("mode"),
                 F.lit(None).cast("array<struct<name:string,type:string,mode:string>>").alias("fields")),
        F.struct(F.lit("Lines").alias("name"), F.lit("RECORD").alias("type"), F.lit("REPEATED").alias("mode"),
                 F.transform("lines", lambda l: F.struct(
                     F.concat(F.lit("Q.ty<"), l["l_linenumber"].cast("string"), F.lit(">")).alias("name"),
                     F.when(l["l_linenumber"] % 2 == 0, F.lit("FLOAT")).otherwise(F.lit("STRING")).alias("type"),
                     F.lit("NULLABLE").alias("mode"))).alias("fields")),
    )
    return x.select(F.col("o_orderkey").alias("key"), F.to_json(fields).alias("schema_json"))


@register("nested_schema_paths", """SELECT CAST(o_orderkey AS VARCHAR) AS key, 'id' AS field_path, 'id' AS field_name, 'INTEGER' AS native_type,
  FALSE AS nullable, 0 AS depth, CAST(NULL AS VARCHAR) AS parent_path FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)
UNION ALL SELECT CAST(o_orderkey AS VARCHAR), 'lines', 'Lines', 'ARRAY<RECORD>', FALSE, 0, NULL FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)
UNION ALL SELECT CAST(l_orderkey AS VARCHAR), 'lines.q%2Ety%3C' || CAST(l_linenumber AS VARCHAR) || '%3E', 'Q.ty<' || CAST(l_linenumber AS VARCHAR) || '>',
  CASE WHEN l_linenumber % 2 = 0 THEN 'FLOAT' ELSE 'STRING' END, TRUE, 1, 'lines' FROM lineitem""")
def nested_schema_paths(spark, sf_dir):
    """N-2: nested table schemas (JSON) flattened to encoded field paths."""
    return schemas.flatten_table_schemas(order_table_schemas(spark, sf_dir), "key", "schema_json") \
        .withColumn("depth", F.col("depth").cast("int"))


def order_avro_schemas(spark, sf_dir):
    x = _orders_with_lines(spark, sf_dir)
    line_fields = F.transform("lines", lambda l: F.struct(
        F.concat(F.lit("l"), l["l_linenumber"].cast("string")).alias("name"), F.lit("double").alias("type")))
    # Avro unions are JSON arrays mixing strings and objects: written as text.
    rec = F.to_json(F.struct(F.lit("record").alias("type"), F.lit("Line").alias("name"), line_fields.alias("fields")))
    text = F.concat(
        F.lit('{"type":"record","name":"Order","fields":[{"name":"id","type":"long"},'
              '{"name":"status","type":["null","string"]},{"name":"lines","type":{"type":"array","items":'),
        rec, F.lit("}}]}"))
    return x.select(F.col("o_orderkey").alias("key"), text.alias("schema_json"))


@register("avro_fields", """SELECT CAST(o_orderkey AS VARCHAR) AS key, 'id' AS field_path, 'LONG' AS native_type, FALSE AS nullable, 0 AS depth
FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)
UNION ALL SELECT CAST(o_orderkey AS VARCHAR), 'status', 'STRING', TRUE, 0 FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)
UNION ALL SELECT CAST(o_orderkey AS VARCHAR), 'lines', 'ARRAY<RECORD>', FALSE, 0 FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)
UNION ALL SELECT CAST(l_orderkey AS VARCHAR), 'lines.l' || CAST(l_linenumber AS VARCHAR), 'DOUBLE', FALSE, 1 FROM lineitem""")
def avro_fields(spark, sf_dir):
    """N-4: Avro schema texts walked into field paths (records, arrays, unions)."""
    return schemas.flatten_avro(order_avro_schemas(spark, sf_dir), "key", "schema_json") \
        .withColumn("depth", F.col("depth").cast("int"))


@register("root_messages", """WITH r AS (SELECT 'M' || CAST(p_partkey AS VARCHAR) AS message,
    CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE 'M' || CAST(p_partkey * 2 + 1 AS VARCHAR) END AS ref_message FROM part)
SELECT DISTINCT message FROM r WHERE message NOT IN (SELECT ref_message FROM r WHERE ref_message IS NOT NULL AND ref_message <> message)""")
def root_messages(spark, sf_dir):
    """N-5: top-level messages of a message-reference table."""
    p = read_table(spark, sf_dir, "part")
    refs = p.select(F.concat(F.lit("M"), F.col("p_partkey").cast("string")).alias("message"),
                    F.when(F.col("p_partkey") % 3 != 0, F.concat(F.lit("M"), (F.col("p_partkey") * 2 + 1).cast("string")))
                    .alias("ref_message"))
    return schemas.root_messages(refs)
