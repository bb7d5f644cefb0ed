"""Unit cases for names, ids, globs, filters, tags and percentiles (cases as data)."""

import fnmatch
import random

import pytest
from pyspark.sql import functions as F

from lakelens.functions import globs, names, scalars
from lakelens.functions.globs import glob_to_regex, python_glob_match
from lakelens.operators import filters, tags, usage


def one(spark, col):
    return spark.range(1).select(col.alias("x")).first()["x"]


def test_dataset_entity_id_goldens(spark):
    assert one(spark, names.dataset_id(F.lit("name"), F.lit("SNOWFLAKE"))) == "DATASET~B1B4CE1961D6D6C4427DC8F1D9F4EF34"
    assert one(spark, names.dataset_id(F.lit("name"), F.lit("SNOWFLAKE"), F.lit("account"))) == \
        "DATASET~5AC8814ADBAFDA3D2B6D1AC58782C5D4"


def test_normalized_name_and_field_path(spark):
    assert one(spark, names.dotted_name(F.lit('"DB"'), F.lit(None).cast("string"), F.lit("`Tbl`"))) == "db.tbl"
    assert one(spark, names.field_path(F.lit("A.b<c>"), F.lit("Parent"))) == "parent.a%2Eb%3Cc%3E"


def test_sanitize_text(spark):
    assert one(spark, scalars.sanitize_text(F.lit("  a\n\tb \r  c  "))) == "a b c"


def test_resource_suffixes(spark):
    p = names.resource_table_parts(F.lit("projects/p/datasets/d/tables/events_20240101"))
    assert one(spark, p["table"]) == "events"
    assert one(spark, names.resource_table_parts(F.lit("projects/p/datasets/d/tables/t$x"))) is None
    assert one(spark, names.resource_table_parts(F.lit("bad/path"))) is None


def test_glob_translation_matches_fnmatch():
    random.seed(7)
    for _ in range(5000):
        pat = "".join(random.choice("ab/.*?") for _ in range(random.randint(0, 6)))
        name = "".join(random.choice("ab/.") for _ in range(random.randint(0, 8)))
        assert python_glob_match(name, pat) == fnmatch.fnmatchcase(name, pat), (pat, name)
    assert glob_to_regex("db?") == "(?s)^db.\\z"


def kept_names(spark, flt, names):
    df = spark.createDataFrame(names, "d string, s string, t string")
    by_column = {tuple(r) for r in df.filter(filters.include_table(flt, "d", "s", "t")).collect()}
    by_rules = {tuple(r) for r in filters.filter_by_rules(df, filters.rules_frame(spark, flt), "d", "s", "t").collect()}
    if flt.includes != (("",),):  # a rule table cannot say "include nothing"
        assert by_column == by_rules
    return {".".join(map(str, r)) for r in by_column}


TIDES = [("Sea", "North", "ebb"), ("sea", "north", "flow_1"), ("sea", "south", "flow_2"), ("Lake", "north", "ebb"), ("lake", None, "ebb"), (None, "north", "ebb")]


def test_include_table(spark):
    kept = lambda inc=None, exc=None: kept_names(spark, filters.DatasetFilter.of(inc, exc).normalized(), TIDES)
    everything = {".".join(map(str, r)) for r in TIDES}
    assert kept() == everything
    assert kept({"SEA": None}) == {"Sea.North.ebb", "sea.north.flow_1", "sea.south.flow_2"}
    assert kept({"s?a": {"n*": {"flow_[0-9]", "none"}, "south": None}}) == {"sea.north.flow_1", "sea.south.flow_2"}
    assert kept({"*": {"north": None}}) == {"Sea.North.ebb", "sea.north.flow_1", "Lake.north.ebb"}
    assert kept(None, {"*": {"*": {"*b"}}}) == everything - {"Sea.North.ebb", "Lake.north.ebb"}
    assert kept({"lake": None, "sea": {"north": {"ebb"}}}, {"l*": {"north": None}}) == {"lake.None.ebb", "Sea.North.ebb"}
    assert kept({}) == set() and kept({"sea": {}}) == set() and kept({"sea": {"north": set()}}) == set()


def test_rule_table_of_ten_thousand_rules(spark, capsys):
    flt = filters.DatasetFilter.of({"*": {f"s{i}*": {f"*t{i}", f"x{i}?"} for i in range(5000)}}).normalized()
    names = spark.range(20000).selectExpr("'d' d", "concat('s', id % 6000, '_') s", "concat(if(id % 3 = 0, 't', 'x'), id % 6000, if(id % 3 = 1, 'y', '')) t")
    found = filters.filter_by_rules(names, filters.rules_frame(spark, flt), "d", "s", "t")
    found.explain()
    plan = capsys.readouterr().out
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    own = lambda r: int(r.s[1:-1])
    fits = lambda r, i: r.t.endswith(f"t{i}") or (len(r.t) == len(f"x{i}?") and r.t.startswith(f"x{i}"))
    want = sum(any(fits(r, int(str(own(r))[:n])) for n in range(1, len(str(own(r))) + 1) if int(str(own(r))[:n]) < 5000) for r in names.collect())
    assert found.count() == want > 1000


def test_include_schema_and_database(spark):
    flt = filters.DatasetFilter.of({"sea": {"north": {"ebb"}}, "l*": None}, {"lagoon": None, "lake": {"deep": None, "mud": {"worm"}}}).normalized()
    rows = [("sea", "north", True), ("sea", "south", False), ("Lake", "any", True), ("lake", "DEEP", False), ("lake", "mud", True), ("lagoon", "x", False)]
    df = spark.createDataFrame(rows, "d string, s string, e boolean")
    assert all(r.e == r.g for r in df.select("e", filters.include_schema(flt, "d", "s").alias("g")).collect())
    dbs = spark.createDataFrame([("Sea", True), ("lake", True), ("Lagoon", False), ("pond", False)], "d string, e boolean")
    assert all(r.e == r.g for r in dbs.select("e", filters.include_database(flt, "d").alias("g")).collect())


def test_filter_algebra(spark):
    one = filters.DatasetFilter.of({"Sea": None, "lake": {"deep": None, "MUD": {"Worm"}}, "pond": {}})
    two = filters.DatasetFilter.of({"sea": {"north": {"ebb"}}, "lake": {"deep": {"fish"}, "mud": None}, "pond": None}, {"bog": None})
    both = one.normalized().merged(two.normalized())
    assert both.includes == (("sea", "north", "ebb"), ("lake", "deep", "fish"), ("lake", "mud", "worm"), ("pond", ""))
    assert both.excludes == (("bog",),) and one.merged(two).normalized() == both
    assert both.merged(both) == both and filters.DatasetFilter().merged(two) == two
    rows = lambda f: {tuple(r) for r in f.collect()}
    frame = lambda f: filters.rules_frame(spark, f)
    assert rows(filters.merge_rules(frame(one), frame(two))) == rows(frame(both))


def test_two_level_and_default_excludes(spark):
    flt = filters.DatasetFilter.two_level({"North": {"e*"}, "south": None}, {"*": {"*_2"}}).normalized()
    df = spark.createDataFrame([r[1:] for r in TIDES], "s string, t string")
    assert [tuple(r) for r in df.filter(filters.include_table_two_level(flt, "s", "t")).collect()] == [("North", "ebb"), ("north", "ebb"), ("north", "ebb")]
    own = filters.with_default_excludes(filters.DatasetFilter.of(excludes={"SYSTEM": {"runtime": None}}), "trino")
    assert own.excludes == (("system", "runtime"), ("*", "information_schema"))


def test_tag_matching_order_and_dedup(spark):
    ms = [tags.TagMatcher("*foo*", ("a", "b")), tags.TagMatcher("x*", ("b", "c"))]
    assert one(spark, tags.match_tags(F.lit("xfoo"), ms)) == ["a", "b", "c"]
    assert one(spark, tags.match_tags(F.lit("zzz"), ms)) == []


PERCENTILE_GOLDENS = [
    ([1, 2, 10], [1 / 3, 2 / 3, 1.0]),
    ([3, 3, 20], [0.5, 0.5, 1.0]),
    ([1, 1, 3, 3, 5], [0.3, 0.3, 0.7, 0.7, 1.0]),
    ([1, 1, 1, 1, 5], [0.5, 0.5, 0.5, 0.5, 1.0]),
    ([0, 0, 1], [0.0, 0.0, 1.0]),
    ([7], [1.0]),
]


@pytest.mark.parametrize("counts,expected", PERCENTILE_GOLDENS)
def test_mean_rank_percentile_goldens(spark, counts, expected):
    df = spark.createDataFrame([(i, c) for i, c in enumerate(counts)], "id int, cnt long")
    for fn in (lambda d: usage.mean_rank_percentile(d, "cnt"),
               lambda d: usage.mean_rank_percentile_grouped(d.withColumn("g", F.lit(1)), "cnt", "g")):
        got = {r.id: r.percentile for r in fn(df).collect()}
        assert [round(got[i], 9) for i in range(len(counts))] == [round(e, 9) for e in expected]


def test_rules_are_filed_under_their_rarest_literal(spark, monkeypatch):
    # All names share a long database; the ends of the tables tell them apart.
    names = spark.range(400).selectExpr("'a_very_long_database_name' AS db", "concat('t', id) AS tab")
    rules = spark.range(400).selectExpr("id AS rule_no", "'a_very_long_database_name' AS g_db", "concat('*t', id) AS g_tab")
    extra = spark.createDataFrame([(900, None, "*"), (901, "*", "t3?"), (902, "zz*", None), (903, "a_very*", "*[7-9]")], "rule_no long, g_db string, g_tab string")
    pairs = globs.glob_pairs(names, ["db", "tab"], rules.unionByName(extra), ["g_db", "g_tab"]).cache()
    assert pairs.filter("rule_no < 900").count() == 400 and pairs.filter("rule_no < 900 AND g_tab = concat('*', tab)").count() == 400
    assert {r.rule_no: r["count"] for r in pairs.filter("rule_no >= 900").groupBy("rule_no").count().collect()} == {900: 400, 901: 10, 903: 120}
    monkeypatch.setattr(F, "regexp", lambda name, pattern: F.lit(True))  # what the regexes see
    assert globs.glob_pairs(names, ["db", "tab"], rules, ["g_db", "g_tab"]).count() == 400


def test_bound_values_are_computed_once(spark):
    """The plan of a parsed time or resource name holds each of its texts' steps once."""
    df = spark.createDataFrame([("2024-01-05T10:20:30.5Z", "projects/p/datasets/d/tables/t$20240105")], "s string, r string")
    out = df.select(scalars.parse_iso8601("s").cast("string").alias("s"), names.resource_table_parts("r").alias("r"))
    plan = out._jdf.queryExecution().optimizedPlan().toString().lower()
    assert plan.count("regexp_replace(") <= 5 and plan.count("split(") == 1
    row = out.first()
    assert row.s == "2024-01-05 10:20:30.5" and tuple(row.r) == ("p", "d", "t")
