"""Depth, digits and lengths beyond the limits that the operators once had."""

import datetime as dt
import json

from pyspark.sql import functions as F

from lakelens.functions import scalars
from lakelens.operators import governance, graph, lake, logs, schemas

DEPTH = 200


def _chain(spark, extra=()):
    rows = [(i, i - 1 if i else None) for i in range(DEPTH)]
    return spark.createDataFrame([*rows, *extra], "id long, parent_id long")


def test_parent_chains_have_no_depth_limit(spark):
    # 500 -> 501 -> 500 is a cycle that 502 leads into; 600 has an unknown parent.
    nodes = _chain(spark, [(500, 501), (501, 500), (502, 500), (600, 999), (601, 600), (700, 700)])
    paths = {r.node: list(r.path) for r in graph.ancestor_paths(nodes).collect()}
    for i in range(DEPTH):
        assert paths[i] == [str(k) for k in range(i + 1)]
    assert all(paths[i] == [] for i in (500, 501, 502, 600, 601, 700))
    below = {r.node: r.descendants for r in graph.descendant_counts(nodes).collect()}
    assert below == {i: DEPTH - 1 - i for i in range(DEPTH - 1)}


def test_walks_end_on_cycles_and_pass_64_nodes(spark):
    n = 66
    edges = spark.createDataFrame([*((i, i + 1) for i in range(n)), (n, 0)], "src long, dst long")
    found = {r.node: r.hop for r in graph.reachable(spark.createDataFrame([(0,)], "s long"), edges).collect()}
    assert found == {i: i for i in range(n + 1)}
    lineage = spark.createDataFrame([("a", "b"), ("b", "a"), ("b", "root1"), ("c", "a")], "dst string, src string")
    roots = graph.resolve_to_roots(lineage, lambda c: c.startswith("root")).collect()
    assert sorted((r.dst, r.root) for r in roots) == [("a", "root1"), ("b", "root1"), ("c", "root1")]


def test_extends_reaches_the_far_end(spark):
    views = spark.createDataFrame([(f"v{i}", f"v{i - 1}" if i else None) for i in range(40)], "view string, extends string")
    props = spark.createDataFrame([("v0", "label", "far"), ("v20", "label", "near")], "view string, key string, value string")
    got = {r.view: r.value for r in governance.extends_chain(views, props).collect()}
    assert got == {f"v{i}": "far" if i < 20 else "near" for i in range(40)}


def test_long_integers_and_fractions(spark):
    texts = ["1700000000000000000", " -9223372036854775808 ", "9223372036854775808", "x", "0007"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in df.select(scalars.text_to_long("t")).collect()] == [1700000000000000000, -(2**63), None, None, 7]
    times = {"2024-05-31T01:02:03.1234567Z": dt.datetime(2024, 5, 31, 1, 2, 3, 123456),
             "2024-05-31T01:02:03.5+02:00": dt.datetime(2024, 5, 31, 1, 2, 3, 500000),
             "20240531T010203Z": dt.datetime(2024, 5, 31, 1, 2, 3),
             "2024-05-31 01:02": dt.datetime(2024, 5, 31, 1, 2), "2024-05-31": dt.datetime(2024, 5, 31),
             "2024-02-30": None, "yesterday": None, "": None}
    df = spark.createDataFrame([(t,) for t in times], "t string")
    got = df.select("t", scalars.parse_iso8601("t").cast("timestamp_ntz").alias("v")).collect()
    assert {r.t: r.v for r in got} == times


def test_newest_partition_of_long_integers(spark):
    values = ["1700000000000000000", "1700000000000000001", "99", "-5"]
    df = spark.createDataFrame([("t1", [("ts", v, "int64")]) for v in values],
                               "table_path string, partitions array<struct<name string, raw_value string, inferred_type string>>")
    assert [tuple(r) for r in lake.newest_partition(df, 1).collect()] == [("t1", "ts=1700000000000000001")]


def test_long_texts_come_back_marked(spark):
    df = spark.createDataFrame([(1, 0, "a" * 70000), (1, 1, "b "), (2, 0, "c")], "q long, s int, t string")
    got = {r.q: (r.query_text, r.too_long) for r in logs.reassemble_fragments(df, "q", "s", "t").collect()}
    assert got == {1: ("a" * 70000 + "b", True), 2: ("c", False)}


def test_deep_avro_fields(spark):
    schema = "string"
    for i in reversed(range(40)):
        schema = {"type": "record", "name": f"r{i}", "fields": [{"name": f"f{i}", "type": schema}]}
    df = spark.createDataFrame([("k", json.dumps(schema))], "key string, schema string")
    assert schemas.flatten_avro(df, "key", "schema").filter(F.col("key") == "k").count() == 40


def test_rows_without_a_partner_stay(spark, small_dir):
    from __spark_entry__ import queries

    q = queries()
    orders = spark.read.parquet(f"{small_dir}/orders.parquet").count()
    assert q["mapping_lineage_all"](spark, small_dir).count() == orders
    assert q["chunk_vectors_all"](spark, small_dir).count() == q["doc_chunks"](spark, small_dir).count()


def test_a_walk_sends_no_frontier_through_the_driver(spark, monkeypatch):
    plans, cut = [], graph.cut_lineage

    def seen(df):
        df.collect()
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return cut(df)
    monkeypatch.setattr(graph, "cut_lineage", seen)
    edges = spark.range(1, 64).selectExpr("id div 2 AS src", "id AS dst")
    assert graph.reachable(spark.createDataFrame([(1,)], "s long"), edges).count() == 63
    assert plans and not any("BroadcastExchange" in plan for plan in plans)
