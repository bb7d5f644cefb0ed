"""URL filter lists (operator 10, native).

Every url is expanded into host-suffix + path-prefix expressions, the
expressions meet the rules by an equi-join on a short prefix of their digest,
full digests confirm the match, and the longest matching rule wins.

Expansions cover exactly the label counts and path lengths that occur in the
rules (at most one expression for each pair of those), so every rule that can
fit is tried and none else.

Defined cases: a null url, or one without ``://``, has an empty host and path;
an empty path fits no rule whose path is longer; equal rules that disagree
resolve to block; repeated pages each get a row; no rule at all gives the
default verdict everywhere; other columns of the input are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakelens.llm.common import ascii_lower, table

PREFIX_HEX = 8  # four digest bytes
#: Rule lists up to this size are broadcast; longer ones join by shuffle.
BROADCAST_RULES = 100_000
#: (host, path, verdict); fixed by the task.
RULES = (
    ("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"), ("com", "/de/", "block"),
)


def split_url(url) -> tuple:
    """(host, path) columns of a url column."""
    start = F.instr(url, "://")
    rest = F.when(start > 0, F.substr(url, start + 3)).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    pattern = r"^([^/?#]*)([^?#]*)"
    return ascii_lower(F.regexp_extract(rest, pattern, 1)), F.regexp_extract(rest, pattern, 2)


def url_verdicts(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url",
                 default: str = "allow") -> DataFrame:
    """(page_id, host, path, rule, verdict) for every row of ``pages``.

    ``rules`` has host, path and verdict (allow or block). The label counts and
    path lengths read to the driver are bounded by the longest single rule."""
    host, path = split_url(F.col(url_col))
    base = pages.select(F.monotonically_increasing_id().alias("rid"), F.col(id_col).alias("page_id"),
                        host.alias("host"), path.alias("path"))
    rules = rules.select(F.concat("host", "path").alias("rule"), F.char_length("host").alias("host_len"), "verdict",
                         F.size(F.split("host", r"\.", -1)).alias("labels"), F.char_length("path").alias("path_len"))
    rules = rules.filter("rule IS NOT NULL AND verdict IS NOT NULL")
    size = rules.agg(F.count("*"), F.collect_set("labels"), F.collect_set("path_len")).first()
    expressions = [
        F.when((F.size(F.split("host", r"\.", -1)) >= k) & (F.char_length("path") >= m),
               F.concat(F.substring_index("host", ".", -k), F.substring("path", 1, m)))
        for k in sorted(size[1]) for m in sorted(size[2])]
    if not expressions:
        return base.select("page_id", "host", "path", F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"))
    tried = base.select("*", F.explode(F.array_distinct(F.array(*expressions))).alias("expr"))
    tried = tried.withColumn("digest", F.sha2("expr", 256)).withColumn("prefix", F.substring("digest", 1, PREFIX_HEX))
    lookup = rules.select("rule", "host_len", F.col("verdict").alias("rule_verdict"), F.sha2("rule", 256).alias("rule_digest"))
    lookup = lookup.withColumn("prefix", F.substring("rule_digest", 1, PREFIX_HEX))
    lookup = F.broadcast(lookup) if size[0] <= BROADCAST_RULES else lookup
    met = tried.join(lookup, "prefix", "left")
    fits = F.col("digest") == F.col("rule_digest")
    rank = F.when(fits, F.struct(F.char_length("rule").alias("l"), "host_len", (F.col("rule_verdict") == "block").alias("b"),
                                 "rule", "rule_verdict"))
    best = met.groupBy("rid", "page_id", "host", "path").agg(F.max(rank).alias("best"))
    return best.select("page_id", "host", "path", F.col("best.rule").alias("rule"),
                       F.coalesce("best.rule_verdict", F.lit(default)).alias("verdict"))


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(list(RULES), "host string, path string, verdict string")
    return url_verdicts(table(spark, sf_dir, "pages"), rules)


OP10_SQL = """
WITH r(rhost, rpath, v) AS (VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
                                   ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
u AS (SELECT row_number() OVER () AS rid, page_id,
        CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (SELECT rid, page_id,
        translate(regexp_extract(rest, '^([^/?#]*)([^?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract(rest, '^([^/?#]*)([^?#]*)', 2) AS path FROM u),
m AS (SELECT rid, arg_max(rhost || rpath, length(rhost || rpath)) AS rule, arg_max(v, length(rhost || rpath)) AS v
      FROM h JOIN r ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath) GROUP BY rid)
SELECT page_id, host, path, rule, coalesce(v, 'allow') AS verdict FROM h LEFT JOIN m USING (rid)
"""
