"""Redaction, statement gates and COPY options, on statements of our own."""

import re

import pytest

from lakelens.operators import sqltext

ALL = sqltext.QueryRules(redact=True, drop_insert_values=True, drop_commands=True)
P = "'<REDACTED>'"


def done(spark, sql, rules=ALL):
    return spark.createDataFrame([(sql,)], "s string").select(sqltext.process_query("s", rules)).first()[0]


REDACTED = {
    "select tide from log where depth > 12.5 and port = 'Brest''s' or depth < 3e2": f"select tide from log where depth > {P} and port = {P} or depth < {P}",
    "select a1, b_2\n  from t3 -- keep 4\nwhere x in ('p', 'q', 7)": f"select a1, b_2 from t3 /* keep 4 */ where x in ({P}, {P}, {P})",
    "update ships set flag = null, name = 'x 1' where id = .5": f"update ships set flag = null, name = {P} where id = {P}",
    "with w as (select 1 as one /* two 2 */) select one from w": f"with w as (select {P} as one /* two 2 */) select one from w",
    "merge into a using b on a.k = b.k when not matched then insert (k, v) values (9, 'z')":
        f"merge into a using b on a.k = b.k when not matched then insert (k, v) values ({P}, {P})",
    "show harbors": None, "use sea": None, "insert into t (a) values (1)": None, "GET '@stage/9' file:///x": "GET '@stage/9' file:///x",
}


@pytest.mark.parametrize("sql", REDACTED)
def test_redaction(spark, sql):
    out = done(spark, sql)
    assert out == REDACTED[sql]
    if out and "@stage" not in out:  # no literal is left
        rest = re.sub(rf"{P}|/\*.*?\*/", "", out)
        assert "'" not in rest and not re.search(r"(?<![\w.])\d", rest)


def test_each_rule_alone(spark):
    rules = sqltext.QueryRules
    assert done(spark, "show x", rules()) == "show x" and done(spark, "show x", rules(drop_commands=True)) is None
    insert = "insert into t values (1)"
    assert done(spark, insert, rules(drop_commands=True)) == insert and done(spark, insert, rules(drop_insert_values=True)) is None
    assert done(spark, "select 5", rules(redact=True, placeholder="#")) == "select '#'"


def test_copy_options_go_in_one_pass(spark):
    sql = ("copy into dock.cargo (id, kind) from (select $1, 'purge = it' from @quay/in) files = ('a (1).csv', 'b.csv') force=true region = 'north sea'"
           " file_format = (type = csv null_if = ('x', ')') skip_header = 1) credentials = (key = 'k') on_error = skip_file match_by_column_name = none")
    df = spark.createDataFrame([(sql,), ("select force = true from t",)], "s string")
    got = [r[0] for r in df.select(sqltext.drop_copy_into_options("s")).collect()]
    assert got == ["copy into dock.cargo (id, kind) from (select $1, 'purge = it' from @quay/in)", "select force = true from t"]
