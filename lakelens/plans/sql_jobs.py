"""SQL-text jobs (Q-1 .. Q-6, Q-9, Q-10) over a query log generated from
``orders``: one statement per order, the statement kind by ``o_orderkey % 5``
and the table names from its keys. The oracle knows each kind's lineage by
construction and lists it with plain SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakelens.operators import sqlscope, sqltext
from lakelens.plans.registry import register
from lakelens.sources.tables import read_table, spread


ROWS_PER_PART = 25_000  # statements of one task


def query_log(spark, sf_dir):
    o = spread(read_table(spark, sf_dir, "orders"), ROWS_PER_PART)
    k = F.col("o_orderkey") % 5
    a = (F.col("o_custkey") % 50).cast("string")
    b = (F.col("o_orderkey") % 30).cast("string")
    c = (F.col("o_custkey") % 25).cast("string")
    prio = F.substring("o_orderpriority", 1, 1)
    price = F.col("o_totalprice").cast("decimal(12,2)").cast("string")
    key = F.col("o_orderkey").cast("string")
    sql = (
        F.when(k == 0, F.concat(F.lit("INSERT INTO sales.orders_p"), prio, F.lit(" SELECT * FROM db.part_"), a,
                                F.lit(" JOIN db.supp_"), b, F.lit(" ON x = y WHERE n IN (SELECT k FROM ref.nation_"), c,
                                F.lit(") AND price > "), price))
        .when(k == 1, F.concat(F.lit("WITH recent AS (SELECT * FROM db.part_"), a,
                               F.lit(" WHERE d > '1998-01-01')\nSELECT count(*) FROM recent, db.supp_"), b))
        .when(k == 2, F.concat(F.lit("UPDATE db.supp_"), b, F.lit(" SET bal = bal + "), price, F.lit(" FROM db.part_"), a,
                               F.lit(" WHERE supp_"), b, F.lit(".id = "), F.col("o_custkey").cast("string")))
        .when(k == 3, F.concat(F.lit("CREATE TABLE tmp.t_"), key, F.lit(" AS SELECT trim(BOTH ' ' FROM name) FROM db.part_"), a))
        .otherwise(F.concat(F.lit("MERGE INTO db.supp_"), b, F.lit(" t USING (SELECT * FROM db.part_"), a,
                            F.lit(") s ON t.id = s.id WHEN MATCHED THEN UPDATE SET t.v = "), price))
    )
    return o.select(F.col("o_orderkey").alias("query_id"), sql.alias("sql"))


ALL_RULES = sqltext.QueryRules(redact=True, drop_insert_values=True, drop_commands=True)

_LINEAGE_SQL = """WITH q AS (SELECT o_orderkey AS query_id, o_orderkey % 5 AS k, 'db.part_' || CAST(o_custkey % 50 AS VARCHAR) AS a,
    'db.supp_' || CAST(o_orderkey % 30 AS VARCHAR) AS b, 'ref.nation_' || CAST(o_custkey % 25 AS VARCHAR) AS c,
    'sales.orders_p' || o_orderpriority[1:1] AS p, 'tmp.t_' || CAST(o_orderkey AS VARCHAR) AS t FROM orders)
SELECT DISTINCT * FROM (
  SELECT query_id, 'source' AS role, a AS "table" FROM q
  UNION ALL SELECT query_id, 'source', b FROM q WHERE k IN (0, 1, 2)
  UNION ALL SELECT query_id, 'source', c FROM q WHERE k = 0
  UNION ALL SELECT query_id, 'target', p FROM q WHERE k = 0
  UNION ALL SELECT query_id, 'target', b FROM q WHERE k IN (2, 4)
  UNION ALL SELECT query_id, 'target', t FROM q WHERE k = 3)"""


@register("sql_lineage", _LINEAGE_SQL)
def sql_lineage(spark, sf_dir):
    """Q-5: table-level lineage (sources / targets) of every logged statement."""
    return sqlscope.table_lineage(query_log(spark, sf_dir), "query_id", "sql") \
        .withColumnRenamed("qid", "query_id")


@register("sql_redact", """SELECT o_orderkey AS query_id,
  CASE o_orderkey % 5
    WHEN 0 THEN 'INSERT INTO sales.orders_p' || o_orderpriority[1:1] || ' SELECT * FROM db.part_' || CAST(o_custkey % 50 AS VARCHAR)
             || ' JOIN db.supp_' || CAST(o_orderkey % 30 AS VARCHAR) || ' ON x = y WHERE n IN (SELECT k FROM ref.nation_'
             || CAST(o_custkey % 25 AS VARCHAR) || ') AND price > ''<REDACTED>'''
    WHEN 1 THEN 'WITH recent AS (SELECT * FROM db.part_' || CAST(o_custkey % 50 AS VARCHAR)
             || ' WHERE d > ''<REDACTED>'') SELECT count(*) FROM recent, db.supp_' || CAST(o_orderkey % 30 AS VARCHAR)
    WHEN 2 THEN 'UPDATE db.supp_' || CAST(o_orderkey % 30 AS VARCHAR) || ' SET bal = bal + ''<REDACTED>'' FROM db.part_'
             || CAST(o_custkey % 50 AS VARCHAR) || ' WHERE supp_' || CAST(o_orderkey % 30 AS VARCHAR) || '.id = ''<REDACTED>'''
    WHEN 3 THEN 'CREATE TABLE tmp.t_' || CAST(o_orderkey AS VARCHAR) || ' AS SELECT trim(BOTH ''<REDACTED>'' FROM name) FROM db.part_'
             || CAST(o_custkey % 50 AS VARCHAR)
    ELSE 'MERGE INTO db.supp_' || CAST(o_orderkey % 30 AS VARCHAR) || ' t USING (SELECT * FROM db.part_' || CAST(o_custkey % 50 AS VARCHAR)
             || ') s ON t.id = s.id WHEN MATCHED THEN UPDATE SET t.v = ''<REDACTED>''' END AS redacted
FROM orders""")
def sql_redact(spark, sf_dir):
    """Q-1 (+Q-2/Q-3 gate): literals replaced by '<REDACTED>', whitespace runs collapsed."""
    q = query_log(spark, sf_dir)
    return q.select("query_id", sqltext.process_query(F.col("sql"), ALL_RULES).alias("redacted"))


def command_log(spark, sf_dir):
    o = spread(read_table(spark, sf_dir, "orders"))
    k = F.col("o_orderkey") % 6
    key = F.col("o_orderkey").cast("string")
    sql = (F.when(k == 0, F.concat(F.lit("SHOW TABLES IN db_"), key))
           .when(k == 1, F.concat(F.lit("INSERT INTO t_"), key, F.lit(" (a, b) VALUES (1, 'x'), (2, 'y')")))
           .when(k == 2, F.concat(F.lit("INSERT INTO t_"), key, F.lit(" VALUES (1, 'x'), (2, ...")))
           .when(k == 3, F.concat(F.lit("/* job */ SELECT a FROM t_"), key))
           .when(k == 4, F.concat(F.lit("GET '@stage/"), key, F.lit("' file:///tmp")))
           .otherwise(F.concat(F.lit("  (select 1 from t_"), key, F.lit(")"))))
    return o.select(F.col("o_orderkey").alias("query_id"), sql.alias("sql"))


@register("sql_statement_gate", """SELECT o_orderkey AS query_id,
  o_orderkey % 6 IN (3, 5) AS kept, o_orderkey % 6 = 4 AS bad_pattern, o_orderkey % 6 = 2 AS truncated_insert,
  CASE o_orderkey % 6 WHEN 0 THEN 'SHOW' WHEN 1 THEN 'INSERT' WHEN 2 THEN 'INSERT' WHEN 3 THEN 'SELECT' WHEN 4 THEN 'GET'
       ELSE 'SELECT' END AS first_keyword
FROM orders""")
def sql_statement_gate(spark, sf_dir):
    """Q-2 / Q-3 / Q-10: keep DML/DDL/queries, drop commands and INSERT ...
    VALUES, flag known-bad patterns and truncated inserts."""
    q = command_log(spark, sf_dir)
    return q.select("query_id", sqltext.keep_statement(F.col("sql")).alias("kept"),
                    sqltext.is_bad_query(F.col("sql")).alias("bad_pattern"),
                    sqltext.is_truncated_insert_values(F.col("sql")).alias("truncated_insert"),
                    sqltext.first_keyword(F.col("sql")).alias("first_keyword"))


@register("sql_query_rules", """WITH c AS (SELECT o_orderkey AS query_id, o_orderkey % 6 AS k, CAST(o_orderkey AS VARCHAR) AS n,
  CASE o_orderkey % 6 WHEN 0 THEN 'SHOW TABLES IN db_' || CAST(o_orderkey AS VARCHAR)
    WHEN 1 THEN 'INSERT INTO t_' || CAST(o_orderkey AS VARCHAR) || ' (a, b) VALUES (1, ''x''), (2, ''y'')'
    WHEN 2 THEN 'INSERT INTO t_' || CAST(o_orderkey AS VARCHAR) || ' VALUES (1, ''x''), (2, ...'
    WHEN 3 THEN '/* job */ SELECT a FROM t_' || CAST(o_orderkey AS VARCHAR)
    WHEN 4 THEN 'GET ''@stage/' || CAST(o_orderkey AS VARCHAR) || ''' file:///tmp'
    ELSE '  (select 1 from t_' || CAST(o_orderkey AS VARCHAR) || ')' END AS sql FROM orders)
SELECT query_id, sql AS untouched,
  CASE k WHEN 0 THEN NULL WHEN 4 THEN sql ELSE trim(sql) END AS without_commands,
  CASE WHEN k IN (1, 2) THEN NULL WHEN k = 4 THEN sql ELSE trim(sql) END AS without_values,
  CASE k WHEN 1 THEN 'INSERT INTO t_' || n || ' (a, b) VALUES (''?'', ''?''), (''?'', ''?'')' WHEN 2 THEN 'INSERT INTO t_' || n || ' VALUES (''?'', ''?''), (''?'', ...'
    WHEN 4 THEN sql WHEN 5 THEN '(select ''?'' from t_' || n || ')' ELSE sql END AS redacted FROM c""")
def sql_query_rules(spark, sf_dir):
    """Q-1 / Q-2: each rule on its own, and none."""
    q, rules = command_log(spark, sf_dir), sqltext.QueryRules
    done = {"untouched": rules(), "without_commands": rules(drop_commands=True), "without_values": rules(drop_insert_values=True),
            "redacted": rules(redact=True, placeholder="?")}
    return q.select("query_id", *[sqltext.process_query("sql", r).alias(name) for name, r in done.items()])


@register("sql_copy_options", """SELECT o_orderkey AS query_id,
  'COPY INTO tgt_' || CAST(o_custkey AS VARCHAR) || ' ( foo, bar ) FROM ( SELECT * FROM src_' || CAST(o_orderkey % 9 AS VARCHAR) || ' )' AS stripped
FROM orders""")
def sql_copy_options(spark, sf_dir):
    """Q-4: COPY INTO load options removed (first occurrence of each)."""
    o = spread(read_table(spark, sf_dir, "orders"))
    sql = F.concat(
        F.lit("COPY INTO tgt_"), F.col("o_custkey").cast("string"), F.lit("\n(\n    foo,\n    bar\n)\nFROM\n    (\n        SELECT *\n        FROM src_"),
        (F.col("o_orderkey") % 9).cast("string"),
        F.lit("\n    )\nFILES = ('f"), F.col("o_orderkey").cast("string"),
        F.lit("') REGION = 'us-east-1' CREDENTIALS = (AWS_KEY_ID = 'id' AWS_SECRET_KEY = 'key') ENCRYPTION = (MASTER_KEY = '')"
              " FILE_FORMAT = ( TYPE = 'csv' COMPRESSION = 'zstd' SKIP_HEADER = 1 ) PURGE = TRUE ON_ERROR = abort_statement"))
    stripped = sqltext.drop_copy_into_options(sql)
    return o.select(F.col("o_orderkey").alias("query_id"),
                    F.trim(F.regexp_replace(stripped, r"\s+", " ")).alias("stripped"))


@register("sql_default_names", """WITH q AS (SELECT o_orderkey AS query_id, o_orderkey % 5 AS k, 'part_' || CAST(o_custkey % 50 AS VARCHAR) AS a,
    'db.supp_' || CAST(o_orderkey % 30 AS VARCHAR) AS b FROM orders)
SELECT query_id, 'prod.' || 'public.' || a AS qualified FROM q
UNION ALL SELECT query_id, 'prod.' || b FROM q""")
def sql_default_names(spark, sf_dir):
    """Q-5 + Q-6: sources of 'SELECT ... FROM part_n, db.supp_m' completed
    with the session database / schema."""
    o = spread(read_table(spark, sf_dir, "orders"))
    sql = F.concat(F.lit("SELECT * FROM part_"), (F.col("o_custkey") % 50).cast("string"),
                   F.lit(", db.supp_"), (F.col("o_orderkey") % 30).cast("string"))
    q = o.select(F.col("o_orderkey").alias("query_id"), sql.alias("sql"))
    lin = sqlscope.table_lineage(q, "query_id", "sql").filter(F.col("role") == "source")
    return lin.select(F.col("qid").alias("query_id"),
                      sqltext.fill_defaults(F.col("table"), F.lit("prod"), F.lit("public")).alias("qualified"))


@register("sql_column_mapping", """SELECT o_orderkey AS query_id, 'total' AS target, 'o.o_totalprice' AS source FROM orders
UNION ALL SELECT o_orderkey, 'cust_' || CAST(o_custkey % 7 AS VARCHAR), 'c.c_name' FROM orders
UNION ALL SELECT o_orderkey, 'score', 'o.o_custkey' FROM orders
UNION ALL SELECT o_orderkey, 'score', 'c.c_acctbal' FROM orders""")
def sql_column_mapping(spark, sf_dir):
    """Q-9: column mapping of simple SELECT lists (alias <- referenced columns)."""
    o = spread(read_table(spark, sf_dir, "orders"))
    sql = F.concat(F.lit("SELECT o.o_totalprice AS total, c.c_name cust_"), (F.col("o_custkey") % 7).cast("string"),
                   F.lit(", round(o.o_custkey * c.c_acctbal, 2) AS score FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey"))
    m = o.select(F.col("o_orderkey").alias("query_id"), F.explode(sqltext.select_column_mapping(sql)).alias("m"))
    return m.select("query_id", F.col("m.target").alias("target"), F.explode("m.sources").alias("source"))
