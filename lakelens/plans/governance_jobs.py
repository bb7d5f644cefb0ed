"""Governance jobs: filters (P-1 .. P-5), tags (M-1, W-7, G-9), assignments (M-2)."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakelens.operators import filters, tags
from lakelens.plans.naming import CATALOG_SQL, supplier_catalog
from lakelens.plans.registry import register
from lakelens.sources.tables import read_table

TABLE_FILTER = filters.DatasetFilter.of(
    includes={
        "a*": None,
        "europe": {"nation_1?": None, "nation_2*": {"supplier#00000001*", "supplier#0000000?5"}},
    },
    excludes={"america": {"nation_1": None}},
)


@register("filter_tables", f"""WITH {CATALOG_SQL}
SELECT s_suppkey, db, schema, tbl FROM cat
WHERE (lower(db) GLOB 'a*'
       OR (lower(db) = 'europe' AND (lower(schema) GLOB 'nation_1?'
           OR (lower(schema) GLOB 'nation_2*' AND (lower(tbl) GLOB 'supplier#00000001*' OR lower(tbl) GLOB 'supplier#0000000?5')))))
  AND NOT (lower(db) = 'america' AND lower(schema) = 'nation_1')""")
def filter_tables(spark, sf_dir):
    """P-1: three-level include / exclude globs on a table listing."""
    c = supplier_catalog(spark, sf_dir).select("s_suppkey", "db", "schema", "tbl")
    return c.filter(filters.include_table(TABLE_FILTER, "db", "schema", "tbl"))


def catalog_rules(spark, sf_dir):
    """A rule table with a rule or two per supplier: globs of every shape."""
    c = supplier_catalog(spark, sf_dir)
    k, none = F.col("s_suppkey"), F.lit(None).cast("string")
    key = F.col("s_suppkey").cast("string")
    exclude = c.filter(k % 3 == 0).select(
        F.lit("exclude").alias("side"), F.when(k % 2 == 0, F.col("db")).otherwise("*").alias("db"),
        F.when(k % 4 < 2, F.lower("schema")).otherwise("*").alias("schema"),
        F.when((k % 5 == 0) & (k % 4 == 0), none).when(k % 5 == 1, F.concat(F.lit("*"), key)).when(k % 5 == 2, F.col("tbl"))
        .when(k % 5 == 3, F.concat(F.left("tbl", F.lit(16)), F.lit("?[0-4]*"))).otherwise(F.concat(F.lit("zz"), key)).alias("table"))
    include = c.filter(k % 7 == 0).select(
        F.lit("include").alias("side"), F.concat(F.left("db", F.lit(1)), F.lit("*")).alias("db"),
        F.when(k % 2 == 0, none).otherwise(F.col("schema")).alias("schema"),
        F.when((k % 2 == 1) & (k % 3 > 0), F.concat(F.lit("*["), F.right(key, F.lit(1)), F.lit("-9]"))).alias("table"))
    return exclude.unionByName(include)


# A rule goes where another one of its side goes on from it, as in the merge of filters.
_RULES = f"""{CATALOG_SQL}, given AS (
  SELECT 'exclude' AS side, CASE WHEN s_suppkey % 2 = 0 THEN db ELSE '*' END AS db,
    CASE WHEN s_suppkey % 4 < 2 THEN lower(schema) ELSE '*' END AS schema,
    CASE WHEN s_suppkey % 20 = 0 THEN NULL WHEN s_suppkey % 5 = 1 THEN '*' || CAST(s_suppkey AS VARCHAR) WHEN s_suppkey % 5 = 2 THEN tbl
      WHEN s_suppkey % 5 = 3 THEN left(tbl, 16) || '?[0-4]*' ELSE 'zz' || CAST(s_suppkey AS VARCHAR) END AS tab FROM cat WHERE s_suppkey % 3 = 0
  UNION ALL SELECT 'include', left(db, 1) || '*', CASE WHEN s_suppkey % 2 = 0 THEN NULL ELSE schema END,
    CASE WHEN s_suppkey % 2 = 1 AND s_suppkey % 3 > 0 THEN '*[' || right(CAST(s_suppkey AS VARCHAR), 1) || '-9]' END
  FROM cat WHERE s_suppkey % 7 = 0),
low AS (SELECT DISTINCT side, lower(db) AS db, lower(schema) AS schema, lower(tab) AS tab FROM given),
rules AS (SELECT * FROM low a WHERE NOT EXISTS (SELECT 1 FROM low b WHERE b.side = a.side AND b.db = a.db
  AND ((a.schema IS NULL AND b.schema IS NOT NULL) OR (a.tab IS NULL AND a.schema = b.schema AND b.tab IS NOT NULL))))"""


@register("filter_tables_many_rules", f"""WITH {_RULES},
fits AS (SELECT DISTINCT s_suppkey, side FROM cat c JOIN rules r ON lower(c.db) GLOB r.db
  AND (r.schema IS NULL OR lower(c.schema) GLOB r.schema) AND (r.tab IS NULL OR lower(c.tbl) GLOB r.tab))
SELECT s_suppkey, db, schema, tbl FROM cat c
WHERE EXISTS (SELECT 1 FROM fits f WHERE f.s_suppkey = c.s_suppkey AND side = 'include')
  AND NOT EXISTS (SELECT 1 FROM fits f WHERE f.s_suppkey = c.s_suppkey AND side = 'exclude')""")
def filter_tables_many_rules(spark, sf_dir):
    """P-1 with a rule table that grows with the catalog: rules filed under literals."""
    c = supplier_catalog(spark, sf_dir).select("s_suppkey", "db", "schema", "tbl")
    return filters.filter_by_rules(c, catalog_rules(spark, sf_dir), "db", "schema", "tbl")


@register("filter_rules_merged", f"""WITH {_RULES} SELECT side, db, schema, tab AS "table" FROM rules""")
def filter_rules_merged(spark, sf_dir):
    """P-6: two rule tables (one per side and parity) normalised and merged."""
    rules = catalog_rules(spark, sf_dir)
    wide = F.col("table").isNull()
    return filters.merge_rules(rules.filter(wide), rules.filter(~wide)).select("side", "db", "schema", "table")


TWO_LEVEL_FILTER = filters.DatasetFilter.two_level(
    includes={"NATION_1*": None, "nation_2": {"*5", "supplier#00000000?"}}, excludes={"*4": {"*[13579]"}}).normalized()


@register("filter_two_level", f"""WITH {CATALOG_SQL} SELECT s_suppkey, schema, tbl FROM cat
WHERE (lower(schema) GLOB 'nation_1*' OR (lower(schema) = 'nation_2' AND (lower(tbl) GLOB '*5' OR lower(tbl) GLOB 'supplier#00000000?')))
  AND NOT (lower(schema) GLOB '*4' AND lower(tbl) GLOB '*[13579]')""")
def filter_two_level(spark, sf_dir):
    """P-4: schema and table globs for sources without databases."""
    c = supplier_catalog(spark, sf_dir).select("s_suppkey", "schema", "tbl")
    return c.filter(filters.include_table_two_level(TWO_LEVEL_FILTER, "schema", "tbl"))


OWN_EXCLUDES = filters.DatasetFilter.of(excludes={"AFRICA": None, "*": {"INFORMATION_SCHEMA": {"tables"}, "pg_internal": {"*7"}}})


@register("filter_default_excludes", f"""WITH {CATALOG_SQL}, t AS (SELECT s_suppkey, db,
  CASE s_suppkey % 4 WHEN 0 THEN 'INFORMATION_SCHEMA' WHEN 1 THEN 'Pg_Catalog' WHEN 2 THEN 'pg_internal' ELSE schema END AS schema, tbl FROM cat)
SELECT s_suppkey, db, schema, tbl FROM t WHERE NOT (lower(db) = 'africa' OR lower(schema) = 'pg_catalog'
  OR (lower(schema) = 'information_schema' AND lower(tbl) = 'tables') OR (lower(schema) = 'pg_internal' AND lower(tbl) GLOB '*7'))""")
def filter_default_excludes(spark, sf_dir):
    """P-7: a source family's system excludes merged with configured ones."""
    c = supplier_catalog(spark, sf_dir)
    k = F.col("s_suppkey") % 4
    schema = F.when(k == 0, "INFORMATION_SCHEMA").when(k == 1, "Pg_Catalog").when(k == 2, "pg_internal").otherwise(F.col("schema"))
    t = c.select("s_suppkey", "db", schema.alias("schema"), "tbl")
    return t.filter(filters.include_table(filters.with_default_excludes(OWN_EXCLUDES, "redshift"), "db", "schema", "tbl"))


SCHEMA_FILTER = filters.DatasetFilter.of(
    includes={"africa": {"nation_1*": {"x"}}, "a*": None, "europe": {"nation_2*": None}},
    excludes={"asia": {"nation_*": None}, "america": {"nation_1": {"t1"}}},
)


@register("filter_schemas", """SELECT r.r_name AS db, n.n_name AS schema FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey
WHERE (CASE WHEN lower(r.r_name) = 'africa' AND lower(n.n_name) GLOB 'nation_1*' THEN TRUE
            WHEN lower(r.r_name) GLOB 'a*' THEN TRUE
            WHEN lower(r.r_name) = 'europe' AND lower(n.n_name) GLOB 'nation_2*' THEN TRUE
            ELSE FALSE END)
  AND NOT (CASE WHEN lower(r.r_name) = 'asia' AND lower(n.n_name) GLOB 'nation_*' THEN TRUE
                WHEN lower(r.r_name) = 'america' AND lower(n.n_name) = 'nation_1' THEN FALSE
                ELSE FALSE END)""")
def filter_schemas(spark, sf_dir):
    """P-2: schema include with partial cover (first matching rule decides)."""
    n = read_table(spark, sf_dir, "nation")
    r = read_table(spark, sf_dir, "region")
    s = n.join(r, n.n_regionkey == r.r_regionkey).select(F.col("r_name").alias("db"), F.col("n_name").alias("schema"))
    return s.filter(filters.include_schema(SCHEMA_FILTER, "db", "schema"))


DB_FILTER = filters.DatasetFilter.of(includes={"a*": None, "europe": None},
                                  excludes={"asia": None, "africa": {"nation_1": None}})


@register("filter_databases", """SELECT r_name AS db FROM region
WHERE NOT lower(r_name) = 'asia' AND (lower(r_name) GLOB 'a*' OR lower(r_name) = 'europe')""")
def filter_databases(spark, sf_dir):
    """P-3: only whole-database excludes remove a database."""
    r = read_table(spark, sf_dir, "region").select(F.col("r_name").alias("db"))
    return r.filter(filters.include_database(DB_FILTER, "db"))


TOPIC_FILTER = filters.TopicFilter(includes={"economy.*", "STANDARD.red*"}, excludes={"*.small_*"})


@register("filter_topics", """WITH t AS (SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN upper(p_type) ELSE lower(p_type) END
  || '.' || replace(p_name, ' ', '_') AS topic FROM part)
SELECT p_partkey, topic FROM t
WHERE (lower(topic) GLOB 'economy.*' OR lower(topic) GLOB 'standard.red*') AND NOT lower(topic) GLOB '*.small_*'""")
def filter_topics(spark, sf_dir):
    """P-5: topic globs (topic and patterns lower-cased)."""
    p = read_table(spark, sf_dir, "part")
    topic = F.concat(F.when(F.col("p_partkey") % 2 == 0, F.upper("p_type")).otherwise(F.lower("p_type")),
                     F.lit("."), F.replace(F.col("p_name"), F.lit(" "), F.lit("_")))
    return p.select("p_partkey", topic.alias("topic")).filter(filters.include_topic(TOPIC_FILTER, "topic"))


MATCHERS = [
    tags.TagMatcher("*ring*", ("ring", "jewelry")),
    tags.TagMatcher("red *", ("red",)),
    tags.TagMatcher("SMALL*", ("small", "ring")),
    tags.TagMatcher("*[wx]idget", ("widget", "red")),
]
_RULES_SQL = """rules(rule_no, tag_no, pattern, tag) AS (VALUES
  (0, 0, '*ring*', 'ring'), (0, 1, '*ring*', 'jewelry'), (1, 0, 'red *', 'red'),
  (2, 0, 'small*', 'small'), (2, 1, 'small*', 'ring'), (3, 0, '*[wx]idget', 'widget'), (3, 1, '*[wx]idget', 'red'))"""


@register("tag_match", f"""WITH {_RULES_SQL},
hits AS (SELECT p.p_partkey, r.tag, min(r.rule_no * 100 + r.tag_no) AS pos
         FROM part p JOIN rules r ON p.p_name GLOB r.pattern GROUP BY p.p_partkey, r.tag)
SELECT p.p_partkey, p.p_name, (SELECT string_agg(h.tag, ',' ORDER BY h.pos) FROM hits h WHERE h.p_partkey = p.p_partkey) AS tag_names
FROM part p""")
def tag_match(spark, sf_dir):
    """M-1: glob matchers on dataset names -> ordered, de-duplicated tags."""
    p = read_table(spark, sf_dir, "part").select("p_partkey", "p_name")
    out = tags.tag_datasets(p, "p_name", MATCHERS)
    return out.select("p_partkey", "p_name", F.array_join("tag_names", ",").alias("tag_names"))


@register("tag_match_rules", """WITH rules AS (
  SELECT s_suppkey AS rule_no, 0 AS tag_no, CASE s_suppkey % 4 WHEN 0 THEN '*' || CAST(s_suppkey AS VARCHAR) WHEN 1 THEN 'small *'
    WHEN 2 THEN '*widget ' || CAST(s_suppkey * 3 AS VARCHAR) ELSE '?' || CAST(s_suppkey AS VARCHAR) || '*' END AS pattern,
    'tag' || CAST(s_suppkey % 6 AS VARCHAR) AS tag FROM supplier
  UNION ALL SELECT s_suppkey, 1, '*' || CAST(s_suppkey AS VARCHAR), 'end' FROM supplier WHERE s_suppkey % 4 = 0),
hits AS (SELECT p_name, tag, min(CAST(rule_no AS BIGINT) * 10 + tag_no) AS pos FROM (SELECT DISTINCT p_name FROM part) JOIN rules ON p_name GLOB pattern
  GROUP BY p_name, tag),
lists AS (SELECT p_name, string_agg(tag, ',' ORDER BY pos) AS tag_names FROM hits GROUP BY p_name)
SELECT p_partkey, p.p_name, tag_names FROM part p LEFT JOIN lists USING (p_name)""")
def tag_match_rules(spark, sf_dir):
    """M-1 with a rule table of a rule or two per supplier."""
    p = read_table(spark, sf_dir, "part").select("p_partkey", "p_name")
    s = read_table(spark, sf_dir, "supplier")
    k, key = F.col("s_suppkey") % 4, F.col("s_suppkey").cast("string")
    ends = F.concat(F.lit("*"), key)
    pattern = F.when(k == 0, ends).when(k == 1, "SMALL *").when(k == 2, F.concat(F.lit("*Widget "), (F.col("s_suppkey") * 3).cast("string"))) \
        .otherwise(F.concat(F.lit("?"), key, F.lit("*")))
    rules = s.select(F.col("s_suppkey").alias("rule_no"), F.lit(0).alias("tag_no"), pattern.alias("pattern"),
                     F.concat(F.lit("tag"), (F.col("s_suppkey") % 6).cast("string")).alias("tag"))
    rules = rules.unionByName(s.filter(k == 0).select(F.col("s_suppkey").alias("rule_no"), F.lit(1).alias("tag_no"), ends.alias("pattern"), F.lit("end").alias("tag")))
    return tags.tag_by_rules(p, "p_name", rules).select("p_partkey", "p_name", F.array_join("tag_names", ",").alias("tag_names"))


def _tag_levels(spark, sf_dir):
    """Tag assignments at three levels keyed down to tables (suppliers)."""
    c = supplier_catalog(spark, sf_dir)
    region_tags = c.select("s_suppkey", F.lit(0).alias("level"), F.lit("tier").alias("tag_key"),
                           F.concat(F.lit("r"), F.col("r_regionkey").cast("string")).alias("tag_value"))
    region_owner = c.select("s_suppkey", F.lit(0).alias("level"), F.lit("owner").alias("tag_key"),
                            F.lower("db").alias("tag_value"))
    nation_tags = c.filter(F.col("n_nationkey") % 3 == 0).select(
        "s_suppkey", F.lit(1).alias("level"), F.lit("tier").alias("tag_key"),
        F.concat(F.lit("n"), F.col("n_nationkey").cast("string")).alias("tag_value"))
    table_tags = c.filter(F.col("s_suppkey") % 7 == 0).select(
        "s_suppkey", F.lit(2).alias("level"), F.lit("tier").alias("tag_key"), F.lit("gold").alias("tag_value"))
    pii = c.filter(F.col("s_suppkey") % 2 == 0).select(
        "s_suppkey", F.lit(2).alias("level"), F.lit("pii").alias("tag_key"), F.lit("yes").alias("tag_value"))
    return region_tags.unionByName(region_owner).unionByName(nation_tags).unionByName(table_tags).unionByName(pii)


_LEVELS_SQL = f"""{CATALOG_SQL}, lv AS (
  SELECT s_suppkey, 0 AS level, 'tier' AS tag_key, 'r' || CAST(r_regionkey AS VARCHAR) AS tag_value FROM cat
  UNION ALL SELECT s_suppkey, 0, 'owner', lower(db) FROM cat
  UNION ALL SELECT s_suppkey, 1, 'tier', 'n' || CAST(n_nationkey AS VARCHAR) FROM cat WHERE n_nationkey % 3 = 0
  UNION ALL SELECT s_suppkey, 2, 'tier', 'gold' FROM cat WHERE s_suppkey % 7 = 0
  UNION ALL SELECT s_suppkey, 2, 'pii', 'yes' FROM cat WHERE s_suppkey % 2 = 0)"""


@register("tag_override", f"""WITH {_LEVELS_SQL}
SELECT s_suppkey, tag_key, arg_max(tag_value, level) AS tag_value FROM lv GROUP BY s_suppkey, tag_key""")
def tag_override(spark, sf_dir):
    """W-7 / G-10: last write wins by level (database < schema < table)."""
    return tags.override_by_level(_tag_levels(spark, sf_dir), ["s_suppkey"])


@register("tag_propagate", f"""WITH {_LEVELS_SQL}
SELECT s_suppkey, string_agg(tag_key || '=' || tag_value, ',' ORDER BY level, tag_key, tag_value) AS tags FROM lv GROUP BY s_suppkey""")
def tag_propagate(spark, sf_dir):
    """G-9: catalog, schema and table tags concatenated in level order."""
    lv = _tag_levels(spark, sf_dir).select(
        "s_suppkey", F.struct("level", "tag_key", "tag_value").alias("seq"),
        F.concat_ws("=", "tag_key", "tag_value").alias("tag"))
    out = tags.propagate_concat([lv], ["s_suppkey"])
    return out.select("s_suppkey", F.array_join("tags", ",").alias("tags"))
