"""Bounded nesting, meta, activity lineage, sentence windows, dot segments."""

import random

from pyspark.sql import functions as F

from lakelens.operators import documents, lake, lineage, metadata, nesting


def test_a_hot_key_is_nested_in_bounded_lists(spark):
    rows = [("hot" if i % 3 else f"k{i}", i % 700, "v" * 20 + str(i)) for i in range(6000)] + [(None, 1, "n"), (None, 0, "m")]
    df = spark.createDataFrame(rows, "key string, at int, value string").repartition(7)
    found = nesting.nested_lists(df, ["key"], ["at", "value"], F.struct("at", "value"), "items", size=250).collect()
    assert all(len(r["items"]) <= 250 for r in found) and sum(len(r["items"]) for r in found) == len(rows)
    hot = [tuple(x) for r in sorted((r for r in found if r.key == "hot"), key=lambda r: r.chunk_no) for x in r["items"]]
    assert hot == sorted((a, v) for k, a, v in rows if k == "hot")
    assert [[tuple(x) for x in r["items"]] for r in found if r.key is None] == [[(0, "m"), (1, "n")]]


def test_meta_of_any_shape(spark):
    texts = ['{"owner":["a@b.co","  ","c"],"t":"x"}', '{"owner":{"a":1},"t":["p",2,null]}', "[1]", "nope", None, '{"owner":null,"t":3}']
    nodes = spark.createDataFrame(list(enumerate(texts)), "id int, s string").select("id", F.try_parse_json("s").alias("meta"))
    rules = spark.createDataFrame([("owner", "O", None, "both")], "meta_key string, designation string, email_domain string, target string")
    assert sorted((r.id, r.target, r.email) for r in metadata.meta_owners(nodes, rules).collect()) == [(0, "dbt_model", "a@b.co"), (0, "materialized_table", "a@b.co")]
    assert sorted(tuple(r) for r in metadata.listed_tags(nodes, "t").collect()) == [(0, "x"), (1, "p")]
    match = spark.createDataFrame([("t", "x|3", "hit"), ("t", "x+y", "no")], "meta_key string, matcher string, tag string")
    assert sorted(tuple(r) for r in metadata.meta_tags(nodes, match).collect()) == [(0, "hit"), (5, "hit")]


def test_activities_of_many_ends(spark):
    many = [f"d{i}" for i in range(50)]
    rows = [("p", "a", "copy", many, ["d1", "d2", "gone"]), ("p", "b", "flow", ["d3", "gone", "d4"], ["d5", "d6"]), ("p", "c", "copy", [], ["d1"]), ("p", "d", "copy", ["d1"], [])]
    activities = spark.createDataFrame(rows, "pipeline string, activity string, kind string, inputs array<string>, outputs array<string>")
    datasets = spark.createDataFrame([(d, d.upper()) for d in many], "name string, entity_id string")
    for block in (7, 1000):
        got = {tuple(r)[1:] for r in lineage.activity_lineage(activities, datasets, block).collect()}
        assert got == {("a", f"D{i}", s) for i in range(50) for s in ("D1", "D2")} | {("b", "D3", "D5")}


def test_sentence_windows():
    cut = lambda text, size, overlap: [" ".join(text.split()[a:b]) for a, b in documents.sentence_windows(text.split(), size, overlap)]
    assert cut("One two. Three four five. Six!", 5, 0) == ["One two. Three four five.", "Six!"]
    assert cut("One two. Three four five. Six! Seven eight.", 6, 1) == ["One two. Three four five. Six!", "Six! Seven eight."]
    assert cut("a b c d e f g", 3, 1) == ["a b c", "d e f", "g"] and cut("x.", 4, 4) == ["x."]
    assert cut('He said "no." Then left.) And so on', 4, 4) == ['He said "no."', "Then left.)", "And so on"]
    rng = random.Random(1)
    for _ in range(300):
        words = [f"w{rng.choice(['', '', '', '.', '!)', '?'])}" for _ in range(rng.randrange(1, 200))]
        size, overlap = rng.randrange(2, 30), rng.randrange(0, 10)
        spans = documents.sentence_windows(words, size, overlap)
        ends = set(documents.sentence_spans(words, size).tolist())
        assert spans[0][0] == 0 and spans[-1][1] == len(words) and all(0 < b - a <= size and b in ends and (a == 0 or a in ends) for a, b in spans)
        for (a, b), (c, d) in zip(spans, spans[1:]):
            assert a < c <= b < d and b - c <= overlap


def test_dot_segments(spark):
    base = "https://s.com/a/b/c.html?q#f"
    want = {"../w": "https://s.com/a/w", "./x/./y": "https://s.com/a/b/x/y", "../../../up": "https://s.com/up", "..": "https://s.com/a/", "/p/../q/.": "https://s.com/q/",
            "z?u=../v": "https://s.com/a/b/z?u=../v", "..k": "https://s.com/a/b/..k", "//t.com/a/../b": "https://t.com/b", "../..": "https://s.com/"}
    df = spark.createDataFrame([(base, h) for h in want], "b string, h string")
    assert {r.h: r.u for r in df.select("h", documents.resolve_href("b", "h").alias("u")).collect()} == want


def test_integers_beyond_64_bits_are_doubles(spark):
    df = spark.createDataFrame([("9223372036854775807",), ("9223372036854775808",), ("1" * 25,), ("-12",), ("1.5",), ("x",)], "v string")
    assert [r[0] for r in df.select(lake.inferred_type("v")).collect()] == ["int64", "double", "double", "int64", "double", "string"]
