"""Landed-file readers on small files written to a temporary folder."""

from pyspark.sql import functions as F

from lakelens.operators import logs
from lakelens.sources import files


def test_text_log_pairing_from_file(spark, tmp_path):
    p = tmp_path / "pg.log"
    p.write_text(
        "2024-08-29 09:25:50 UTC:10.1.1.134(48507):alice@db:[615]:LOG:  statement: SELECT x, y from schema.table;\n"
        "    continued line without prefix\n"
        "2024-08-29 09:25:50 UTC:10.1.1.134(48507):alice@db:[615]:LOG:  duration: 55.66 ms\n"
        "2024-08-29 09:25:51 UTC:10.1.1.134(48507):bob@db:[616]:ERROR:  syntax error\n")
    lines = files.text_log(spark, str(p))
    pairs = logs.pair_statement_duration(logs.parse_prefixed_log(lines)).collect()
    assert len(pairs) == 1
    assert pairs[0].sql == "SELECT x, y from schema.table;"
    assert abs(pairs[0].duration_seconds - 0.05566) < 1e-9
    assert pairs[0].user_name == "alice" and pairs[0].database == "db"


def test_audit_csv(spark, tmp_path):
    p = tmp_path / "audit.csv"
    p.write_text("1700000000000000,srv,alice,host1,5,10,QUERY,db1,'select \\'a\\', b from t',0\n"
                 "1700000000000001,srv,bob,host2,6,11,CONNECT,db1,'',0\n")
    rows = files.audit_csv(spark, str(p)).collect()
    assert len(rows) == 1 and rows[0].query == "select 'a', b from t" and rows[0].user == "alice"


def test_whole_files_and_json_lines(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"x": 1}\n{"x": 2}\n')
    assert files.json_lines(spark, str(tmp_path / "a.json")).count() == 2
    w = files.whole_files(spark, str(tmp_path / "a.json")).select(F.length("content")).first()[0]
    assert w == len('{"x": 1}\n{"x": 2}\n')


def test_file_schemas_csv_and_json(spark, tmp_path):
    from lakelens.operators import lake
    (tmp_path / "t.csv").write_text("a,b,c,d\n1,2,3,4\n")
    (tmp_path / "t.json").write_text('{"x": 1, "y": "s"}\n')
    files = lake.listing(spark, str(tmp_path))
    rows = {(r.path.rsplit("/", 1)[-1], r.column_name): r.data_type for r in lake.file_schemas(files).collect()}
    assert rows[("t.csv", "a")] == "VARCHAR" and ("t.csv", "d") in rows
    assert rows[("t.json", "x")] == "INT" and rows[("t.json", "y")] == "STR"


def test_dealing_bounds_the_rows_of_a_part(spark):
    from lakelens.sources.tables import spread
    few, many = spark.range(0, 100, 1, 1), spark.range(0, 5000, 1, 16)
    cores = spark.sparkContext.defaultParallelism
    assert spread(few, 1000).rdd.getNumPartitions() == cores and spread(many).rdd.getNumPartitions() == max(cores, 16)
    sizes = spread(many, 50).rdd.glom().map(len).collect()
    assert sum(sizes) == 5000 and len(sizes) == 100 and max(sizes) < 150
