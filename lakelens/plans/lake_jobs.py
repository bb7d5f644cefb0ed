"""Lake jobs (S-1 .. S-8, A-14, A-15).

The object listing is derived from ``lineitem`` (one file per line item):
  s3://lake/warehouse/d{suppkey%3}/t{partkey%7}/year={yyyy}/month={m}/part-{order}-{line}.{ext}
with month written as 'm<m>' for line 7 of table t0 and '<m>.5' for line 6,
extension txt / csv / parquet by line number, line 4 landing in a 'staging'
folder outside the template, empty files when the quantity is a multiple of 10.
S-1 and S-8 also run on the real parquet folder of the tables.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from lakelens.operators import lake
from lakelens.plans.registry import register
from lakelens.sources.tables import read_table, spread

TEMPLATE = lake.PathTemplate(
    "s3://lake/warehouse/{dept}/{table}/{partition_key[0]}={partition[0]}/{partition_key[1]}={partition[1]}/*.*",
    excludes=["s3://lake/warehouse/d1/t3", "s3://lake/warehouse/*/t5/year=1998/"],
)
FLAT_TEMPLATE = lake.PathTemplate("s3://lake/warehouse/{dept}/{table}/*/*/*.*")


def object_listing(spark, sf_dir):
    li = spread(read_table(spark, sf_dir, "lineitem"))
    n = F.col("l_linenumber")
    dept = F.concat(F.lit("d"), (F.col("l_suppkey") % 3).cast("string"))
    tbl = F.concat(F.lit("t"), (F.col("l_partkey") % 7).cast("string"))
    mo = F.month("l_shipdate").cast("string")
    mval = (F.when((n == 7) & (F.col("l_partkey") % 7 == 0), F.concat(F.lit("m"), mo))
            .when(n == 6, F.concat(mo, F.lit(".5"))).otherwise(mo))
    ext = F.when(n % 5 == 0, "txt").when(n % 5 == 1, "csv").otherwise("parquet")
    name = F.concat(F.lit("part-"), F.col("l_orderkey").cast("string"), F.lit("-"), n.cast("string"), F.lit("."), ext)
    path = F.when(n == 4, F.concat(F.lit("s3://lake/warehouse/"), dept, F.lit("/staging/"), name)).otherwise(
        F.concat(F.lit("s3://lake/warehouse/"), dept, F.lit("/"), tbl, F.lit("/year="), F.year("l_shipdate").cast("string"),
                 F.lit("/month="), mval, F.lit("/"), name))
    row = F.struct(
        path.alias("path"),
        F.when(F.col("l_quantity") % 10 == 0, F.lit(0)).otherwise(F.col("l_extendedprice").cast("long")).alias("length"),
        (F.col("l_shipdate") + F.make_dt_interval(F.lit(0), n)).alias("modificationTime"),
    )
    # The listing is "landed" data: `inline` (a generator) keeps the optimizer
    # from re-deriving `path` inside every later expression that reads it.
    return li.select(F.inline(F.array(row)))


LISTING_SQL = """files AS (
  SELECT CASE WHEN l_linenumber = 4 THEN 's3://lake/warehouse/d' || CAST(l_suppkey % 3 AS VARCHAR) || '/staging/'
              ELSE 's3://lake/warehouse/d' || CAST(l_suppkey % 3 AS VARCHAR) || '/t' || CAST(l_partkey % 7 AS VARCHAR)
                   || '/year=' || CAST(year(l_shipdate) AS VARCHAR) || '/month='
                   || CASE WHEN l_linenumber = 7 AND l_partkey % 7 = 0 THEN 'm' || CAST(month(l_shipdate) AS VARCHAR)
                           WHEN l_linenumber = 6 THEN CAST(month(l_shipdate) AS VARCHAR) || '.5'
                           ELSE CAST(month(l_shipdate) AS VARCHAR) END || '/' END
         || 'part-' || CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) || '.'
         || CASE l_linenumber % 5 WHEN 0 THEN 'txt' WHEN 1 THEN 'csv' ELSE 'parquet' END AS path,
    CASE WHEN l_quantity % 10 = 0 THEN 0 ELSE CAST(trunc(l_extendedprice) AS BIGINT) END AS length,
    l_shipdate + to_hours(l_linenumber) AS modificationTime,
    'd' || CAST(l_suppkey % 3 AS VARCHAR) AS dept, 't' || CAST(l_partkey % 7 AS VARCHAR) AS tbl, l_linenumber
  FROM lineitem),
ok AS (SELECT *, 's3://lake/warehouse/' || dept || '/' || tbl AS table_path, dept || '/' || tbl AS table_name
       FROM files WHERE regexp_replace(path, '^s3://lake/', '') GLOB 'warehouse/*/*/*=*/*=*/*.*'
         AND lower(regexp_extract(path, '\\.([^.]*)$', 1)) IN ('avro', 'csv', 'tsv', 'parquet', 'json'))"""


@register("lake_key_match", f"""WITH {LISTING_SQL}
SELECT path, path IN (SELECT path FROM ok) AS accepted FROM files""")
def lake_key_match(spark, sf_dir):
    """S-2: keys accepted by the template (labels as '*', '*' crosses '/') and file type."""
    f = object_listing(spark, sf_dir)
    return f.select("path", lake.allow_key(TEMPLATE, lake.object_key("path")).alias("accepted"))


@register("lake_tables", f"""WITH {LISTING_SQL},
ranked AS (SELECT *, row_number() OVER (PARTITION BY table_path ORDER BY (length > 0) DESC, CASE WHEN length > 0 THEN modificationTime END DESC, path) AS rk
           FROM ok)
SELECT r.table_path, r.table_name, r.path AS full_path, r.modificationTime AS timestamp,
  CAST(s.total AS BIGINT) AS size_in_bytes, CAST(s.n AS BIGINT) AS number_of_files
FROM ranked r JOIN (SELECT table_path, sum(length) AS total, count(*) AS n FROM ok GROUP BY table_path) s USING (table_path)
WHERE r.rk = 1""")
def lake_tables(spark, sf_dir):
    """S-6 + A-14: files grouped into tables; newest non-empty file, summed sizes (partitioned)."""
    c = lake.classify(object_listing(spark, sf_dir), TEMPLATE)
    return lake.merge_tables(c, partitioned=True)


@register("lake_tables_unpartitioned", f"""WITH {LISTING_SQL},
ranked AS (SELECT *, row_number() OVER (PARTITION BY table_path ORDER BY (length > 0) DESC, CASE WHEN length > 0 THEN modificationTime END DESC, path) AS rk
           FROM ok)
SELECT table_path, table_name, path AS full_path, modificationTime AS timestamp, CAST(length AS BIGINT) AS size_in_bytes,
  CAST(1 AS BIGINT) AS number_of_files FROM ranked WHERE rk = 1""")
def lake_tables_unpartitioned(spark, sf_dir):
    """A-14 without partition labels: the newest non-empty file's size and one file."""
    c = lake.classify(object_listing(spark, sf_dir), FLAT_TEMPLATE)
    return lake.merge_tables(c, partitioned=False)


_PTYPE = """CASE WHEN regexp_matches({v}, '^\\s*[+-]?\\d+\\s*$') AND TRY_CAST({v} AS BIGINT) IS NOT NULL THEN 'int64'
     WHEN TRY_CAST({v} AS DOUBLE) IS NOT NULL THEN 'double'
     WHEN TRY_CAST({v} AS DATE) IS NOT NULL AND regexp_matches({v}, '^\\d{{4}}-\\d{{1,2}}-\\d{{1,2}}$') THEN 'datetime' ELSE 'string' END"""
_PARTS_SQL = f"""pp AS (
  SELECT path, table_path, 'year' AS name, regexp_extract(path, '/year=([^/]*)/', 1) AS raw_value, 0 AS idx FROM ok
  UNION ALL SELECT path, table_path, 'month', regexp_extract(path, '/month=([^/]*)/', 1), 1 FROM ok),
typed AS (SELECT *, {_PTYPE.format(v='raw_value')} AS t FROM pp)"""


@register("lake_partitions", f"""WITH {LISTING_SQL}, {_PARTS_SQL}
SELECT path, string_agg(name || '=' || raw_value || ':' || t, ';' ORDER BY idx) AS partitions
FROM (SELECT DISTINCT path, name, raw_value, t, idx FROM typed) GROUP BY path""")
def lake_partitions(spark, sf_dir):
    """S-7: partition fields of every accepted file with inferred types."""
    c = lake.classify(object_listing(spark, sf_dir), TEMPLATE)
    return c.select("path", F.array_join(F.transform("partitions", lambda p: F.concat(
        p["name"], F.lit("="), p["raw_value"], F.lit(":"), p["inferred_type"])), ";").alias("partitions")).distinct()


@register("lake_partition_types", f"""WITH {LISTING_SQL}, {_PARTS_SQL},
sets AS (SELECT table_path, name, list_distinct(list(t)) AS types FROM typed GROUP BY ALL)
SELECT table_path, name,
  CASE WHEN len(types) = 1 THEN types[1] WHEN list_contains(types, 'string') THEN 'string'
       WHEN list_contains(types, 'double') AND NOT (list_contains(types, 'int64') AND list_contains(types, 'datetime')) THEN 'double' END AS type,
  CASE WHEN len(types) = 1 OR list_contains(types, 'string')
         OR (list_contains(types, 'double') AND NOT (list_contains(types, 'int64') AND list_contains(types, 'datetime'))) THEN FALSE ELSE TRUE END AS conflict
FROM sets""")
def lake_partition_types(spark, sf_dir):
    """A-15: partition column types unified across a table's files."""
    return lake.partition_types(lake.classify(object_listing(spark, sf_dir), TEMPLATE))


@register("lake_newest_partition", f"""WITH {LISTING_SQL},
v AS (SELECT table_path, regexp_extract(path, '/year=([^/]*)/', 1) AS y, regexp_extract(path, '/month=([^/]*)/', 1) AS m FROM ok),
y1 AS (SELECT table_path, CASE WHEN bool_and(regexp_matches(y, '^[+-]?\\d+$')) THEN arg_max(y, TRY_CAST(y AS BIGINT)) ELSE max(y) END AS y
       FROM v GROUP BY table_path),
m1 AS (SELECT v.table_path, CASE WHEN bool_and(regexp_matches(m, '^[+-]?\\d+$')) THEN arg_max(m, TRY_CAST(m AS BIGINT)) ELSE max(m) END AS m
       FROM v JOIN y1 ON v.table_path = y1.table_path AND v.y = y1.y GROUP BY v.table_path)
SELECT y1.table_path, 'year=' || y1.y || '/month=' || m1.m AS newest_partition FROM y1 JOIN m1 USING (table_path)""")
def lake_newest_partition(spark, sf_dir):
    """S-4: newest partition per table (greatest value per level, numbers as numbers)."""
    return lake.newest_partition(lake.classify(object_listing(spark, sf_dir), TEMPLATE), len(TEMPLATE.partitions))


def _dirs(spark, sf_dir):
    f = object_listing(spark, sf_dir)
    parts = F.split("path", "/")
    return f.select(F.explode(F.transform(F.sequence(F.lit(3), F.size(parts) - 1),
                                          lambda k: F.array_join(F.slice(parts, 1, k), "/"))).alias("dir")).distinct()


@register("lake_dir_match", f"""WITH {LISTING_SQL},
dirs AS (SELECT DISTINCT array_to_string(string_split(path, '/')[1:k], '/') AS dir
         FROM (SELECT path, unnest(range(3, len(string_split(path, '/')))) AS k FROM files)),
d AS (SELECT dir, length(dir) - length(replace(dir, '/', '')) AS slashes FROM dirs)
SELECT dir,
  (CASE slashes WHEN 2 THEN dir GLOB 's3://lake' WHEN 3 THEN dir GLOB 's3://lake/warehouse'
                WHEN 4 THEN dir GLOB 's3://lake/warehouse/*' WHEN 5 THEN dir GLOB 's3://lake/warehouse/*/*'
                ELSE FALSE END)
  AND NOT regexp_matches(dir, '^s3://lake/warehouse/d1/t3(/.*)?$')
  AND NOT regexp_matches(dir, '^s3://lake/warehouse/[^/]*/t5/year=1998(/.*)?$') AS accepted
FROM d""")
def lake_dir_match(spark, sf_dir):
    """S-3: directories accepted at their depth (partition levels never are),
    with excludes covering descendants but not ancestors."""
    return _dirs(spark, sf_dir).select("dir", lake.allow_dir(TEMPLATE, F.col("dir")).alias("accepted"))


@register("lake_folders", f"""WITH {LISTING_SQL}
SELECT DISTINCT array_to_string(string_split(path, '/')[1:5], '/') AS folder FROM files""")
def lake_folders(spark, sf_dir):
    """S-5: wildcard folders below the prefix, expanded from the listing."""
    return lake.folder_prefixes(object_listing(spark, sf_dir), 5)


@register("lake_file_schemas", """SELECT table_name, column_name, CAST(ordinal_position AS INTEGER) AS ordinal_position, data_type
FROM information_schema.columns
WHERE table_name IN ('region', 'nation', 'customer', 'supplier', 'part', 'orders', 'lineitem', 'events', 'documents',
                     'embeddings', 'pages', 'benchmark', 'labels', 'conversations')""")
def lake_file_schemas(spark, sf_dir):
    """S-1 + S-8: list the real table folder (binaryFile, content pruned) and
    read each parquet footer inside the tasks."""
    files = lake.listing(spark, sf_dir).filter(F.col("path").endswith(".parquet"))
    s = lake.file_schemas(files)
    return s.select(F.regexp_extract("path", r"([^/]+)\.parquet$", 1).alias("table_name"),
                    "column_name", "ordinal_position", "data_type")
