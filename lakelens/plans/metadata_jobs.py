"""Metadata jobs: owners and tags from meta (N-8), excluding properties (G-7),
activity lineage (J-19), open alerts (M-4), sentence windows (D-7)."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakelens.operators import documents, governance, lineage, metadata, tags
from lakelens.plans.registry import register
from lakelens.sources.tables import read_table, spread


def meta_nodes(spark, sf_dir):
    """A node per part with a free-form meta object."""
    p = read_table(spark, sf_dir, "part")
    k, key = F.col("p_partkey") % 5, F.col("p_partkey").cast("string")
    text = (F.when(k == 0, F.concat(F.lit('{"owner":"alice'), key, F.lit('","tags":["x","y'), key, F.lit('"],"tier":1}')))
            .when(k == 1, F.concat(F.lit('{"owner":["bob'), key, F.lit('@corp.com","carol'), key, F.lit('"," bad one",7],"tier":"2"}')))
            .when(k == 2, F.concat(F.lit('{"steward":"dave'), key, F.lit('","tags":"solo","pii":true}')))
            .when(k == 3, F.concat(F.lit('{"owner":5,"steward":["erin'), key, F.lit('@a.b.co"],"tier":12,"tags":[{"t":1}]}')))
            .otherwise("{}"))
    return p.select(F.col("p_partkey").alias("id"), F.try_parse_json(text).alias("meta"))


@register("meta_owners", """WITH p AS (SELECT p_partkey AS id, p_partkey % 5 AS k, CAST(p_partkey AS VARCHAR) AS key FROM part),
o AS (SELECT id, 'Owner' AS designation, 'alice' || key || '@example.com' AS email FROM p WHERE k = 0
  UNION ALL SELECT id, 'Owner', 'bob' || key || '@corp.com' FROM p WHERE k = 1
  UNION ALL SELECT id, 'Owner', 'carol' || key || '@example.com' FROM p WHERE k = 1),
t AS (SELECT id, unnest(['dbt_model', 'materialized_table']) AS target, designation, email FROM o
  UNION ALL SELECT id, 'dbt_model', 'Steward', 'erin' || key || '@a.b.co' FROM p WHERE k = 3)
SELECT id, target, designation, email, 'PERSON~' || upper(md5('{"email":' || to_json(email) || '}')) AS person FROM t""")
def meta_owners(spark, sf_dir):
    """N-8: owners from free-form meta by rules; names get the rule's domain, what is
    no address is dropped."""
    rules = spark.createDataFrame([("owner", "Owner", "example.com", "both"), ("steward", "Steward", None, "dbt_model"), ("none", "X", None, "both")],
                                  "meta_key string, designation string, email_domain string, target string")
    return metadata.meta_owners(meta_nodes(spark, sf_dir), rules)


@register("meta_tags", """WITH p AS (SELECT p_partkey AS id, p_partkey % 5 AS k, CAST(p_partkey AS VARCHAR) AS key FROM part)
SELECT id, 'core' AS tag FROM p WHERE k IN (0, 1) UNION ALL SELECT id, 'pii' FROM p WHERE k = 2
UNION ALL SELECT id, 'x' FROM p WHERE k = 0 UNION ALL SELECT id, 'y' || key FROM p WHERE k = 0 UNION ALL SELECT id, 'solo' FROM p WHERE k = 2""")
def meta_tags(spark, sf_dir):
    """N-8: tags of meta values that match a rule as a whole, and tags listed in meta."""
    rules = spark.createDataFrame([("tier", "1|2", "core"), ("pii", "true", "pii"), ("owner", "never", "x")], "meta_key string, matcher string, tag string")
    nodes = meta_nodes(spark, sf_dir)
    return metadata.meta_tags(nodes, rules).unionByName(metadata.listed_tags(nodes, "tags"))


@register("extends_excluding", """WITH RECURSIVE v AS (SELECT 'v' || CAST(p_partkey AS VARCHAR) AS view,
    CASE WHEN p_partkey > 0 THEN 'v' || CAST(p_partkey // 3 AS VARCHAR) END AS parent FROM part),
props AS (SELECT 'v' || CAST(p_partkey AS VARCHAR) AS view, 'sql_table_name' AS key, 'tbl' || CAST(p_partkey AS VARCHAR) AS value, 'source' AS grp FROM part WHERE p_partkey % 4 = 0
  UNION ALL SELECT 'v' || CAST(p_partkey AS VARCHAR), 'derived_table', 'sql' || CAST(p_partkey AS VARCHAR), 'source' FROM part WHERE p_partkey % 6 = 2
  UNION ALL SELECT 'v' || CAST(p_partkey AS VARCHAR), 'label', 'L' || CAST(p_partkey AS VARCHAR), 'label' FROM part WHERE p_partkey % 5 = 0),
walk(node, anc, dist, nxt) AS (SELECT view, view, 0, parent FROM v
  UNION ALL SELECT w.node, v.view, w.dist + 1, v.parent FROM walk w JOIN v ON v.view = w.nxt),
x AS (SELECT w.node, p.key, p.value, w.dist, min(w.dist) OVER (PARTITION BY w.node, p.grp) AS nearest FROM walk w JOIN props p ON p.view = w.anc)
SELECT node AS view, key, value FROM x WHERE dist = nearest""")
def extends_excluding(spark, sf_dir):
    """G-7: of a table name and a derived table only the nearest view's are inherited."""
    p = read_table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    view = F.concat(F.lit("v"), k.cast("string"))
    views = p.select(view.alias("view"), F.when(k > 0, F.concat(F.lit("v"), F.floor(k / 3).cast("string"))).alias("extends"))
    prop = lambda rule, key, start: p.filter(rule).select(view.alias("view"), F.lit(key).alias("key"), F.concat(F.lit(start), k.cast("string")).alias("value"))
    props = prop(k % 4 == 0, "sql_table_name", "tbl").unionByName(prop(k % 6 == 2, "derived_table", "sql")).unionByName(prop(k % 5 == 0, "label", "L"))
    return governance.extends_chain(views, props)


@register("activity_lineage", """WITH a AS (SELECT 'p' || CAST(s_suppkey % 10 AS VARCHAR) AS pipeline, 'a' || CAST(s_suppkey AS VARCHAR) AS activity, s_suppkey AS k FROM supplier),
copies AS (SELECT pipeline, activity, unnest([k, k + 1, k + 2]) AS i, k FROM a WHERE k % 3 > 0),
edges AS (SELECT pipeline, activity, i, unnest([2 * k, 2 * k + 1]) AS o FROM copies
  UNION ALL SELECT pipeline, activity, unnest([k, k + 1, k + 2]), unnest([2 * k, 2 * k + 1, NULL]) FROM a WHERE k % 3 = 0)
SELECT DISTINCT pipeline, activity, 'E' || CAST(i AS VARCHAR) AS source, 'E' || CAST(o AS VARCHAR) AS sink FROM edges
WHERE i IN (SELECT s_suppkey FROM supplier) AND o IN (SELECT s_suppkey FROM supplier)""")
def activity_lineage(spark, sf_dir):
    """J-19: copy activities read all inputs into all outputs, data flows by position."""
    s = read_table(spark, sf_dir, "supplier")
    k = F.col("s_suppkey")
    named = lambda *ks: F.array(*[F.concat(F.lit("d"), x.cast("string")) for x in ks])
    activities = s.select(F.concat(F.lit("p"), (k % 10).cast("string")).alias("pipeline"), F.concat(F.lit("a"), k.cast("string")).alias("activity"),
                          F.when(k % 3 == 0, "flow").otherwise("copy").alias("kind"), named(k, k + 1, k + 2).alias("inputs"), named(2 * k, 2 * k + 1).alias("outputs"))
    datasets = s.select(F.concat(F.lit("d"), k.cast("string")).alias("name"), F.concat(F.lit("E"), k.cast("string")).alias("entity_id"))
    return lineage.activity_lineage(activities, datasets, block=2)


@register("open_alerts", """SELECT event_id, ts FROM events WHERE event_type NOT IN ('click', 'view') AND ts >= TIMESTAMP '2024-01-20' - INTERVAL 7 DAY""")
def open_alerts(spark, sf_dir):
    """M-4: alerts without a handling status, inside the look-back."""
    e = read_table(spark, sf_dir, "events")
    handled = F.when(F.col("event_type") == "click", "FIXED").when(F.col("event_type") == "view", "NO_ACTION")
    alerts = e.select("event_id", "ts", handled.alias("handled_status"))
    return governance.open_alerts(alerts, "ts", F.lit("2024-01-20").cast("timestamp_ntz"), 7).select("event_id", "ts")


_SENTENCES = r"""clean AS (SELECT doc_id, string_split(trim(regexp_replace(translate(text, chr(10) || chr(9) || chr(13), '   '), ' +', ' ', 'g'), ' '), ' ') AS w
  FROM documents WHERE trim(regexp_replace(translate(text, chr(10) || chr(9) || chr(13), '   '), ' +', ' ', 'g'), ' ') <> ''),
words AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS k FROM clean),
said AS (SELECT doc_id, k, coalesce(sum(CASE WHEN regexp_matches(word, '[.!?]["'')\]]*$') THEN 1 ELSE 0 END)
  OVER (PARTITION BY doc_id ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS sentence FROM words),
parts AS (SELECT doc_id, k, sentence, (row_number() OVER (PARTITION BY doc_id, sentence ORDER BY k) - 1) // 512 AS part FROM said),
pieces AS (SELECT doc_id, min(k) - 1 AS start, max(k) AS stop FROM parts GROUP BY doc_id, sentence, part),
p AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY start) - 1 AS i, lead(stop, 1, -1) OVER (PARTITION BY doc_id ORDER BY start) AS next_stop FROM pieces)"""


@register("doc_sentence_chunks", f"""WITH RECURSIVE {_SENTENCES},
c(doc_id, chunk_no, first, start, stop, next_stop) AS (
  SELECT doc_id, 0, CAST(0 AS BIGINT), CAST(0 AS BIGINT), max(stop), arg_max(next_stop, i) FROM p WHERE stop <= 512 GROUP BY doc_id
  UNION ALL
  SELECT c.doc_id, c.chunk_no + 1, n.i, n.start, e.stop, e.next_stop FROM c,
    LATERAL (SELECT min(x.i) AS i, min(x.start) AS start FROM p x WHERE x.doc_id = c.doc_id AND x.i > c.first AND x.start >= c.stop - 50 AND x.start >= c.next_stop - 512) n,
    LATERAL (SELECT max(y.stop) AS stop, arg_max(y.next_stop, y.i) AS next_stop FROM p y WHERE y.doc_id = c.doc_id AND y.stop <= n.start + 512) e
  WHERE c.next_stop > 0)
SELECT doc_id, CAST(chunk_no AS INTEGER) AS chunk_no, CAST(stop - start AS INTEGER) AS n_words, md5(array_to_string(w[start + 1 : stop], ' ')) AS chunk_md5
FROM c JOIN clean USING (doc_id)""")
def doc_sentence_chunks(spark, sf_dir):
    """D-7: whole documents in windows of whole sentences, at most 512 words, overlapping
    by whole sentences of at most 50."""
    d = spread(read_table(spark, sf_dir, "documents")).select("doc_id", "text")
    return documents.chunk_sentences(d, "text").select("doc_id", "chunk_no", "n_words", F.md5("text").alias("chunk_md5"))


@register("supported_dependencies", """SELECT o_orderkey FROM orders WHERE o_orderkey % 4 < 3 AND o_custkey % 3 < 2""")
def supported_dependencies(spark, sf_dir):
    """J-23: dependency rows whose both ends are of a supported domain."""
    o = read_table(spark, sf_dir, "orders")
    kind = lambda c, n: F.element_at(F.array(*[F.lit(x) for x in ("Table", "view", "MATERIALIZED VIEW", "Stage")][:n]), (F.col(c) % n + 1).cast("int"))
    deps = o.select("o_orderkey", kind("o_orderkey", 4).alias("src"), F.when(F.col("o_custkey") % 3 == 2, "Function").otherwise(kind("o_custkey", 2)).alias("dst"))
    return lineage.supported_dependencies(deps, ["table", "view", "materialized view"], "src", "dst").select("o_orderkey")


@register("merged_tags", """SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN coalesce(a, '') WHEN a IS NULL THEN 'b,c' WHEN p_partkey % 2 = 0 THEN 'a,b,c' ELSE 'c,b' END AS tags
FROM (SELECT p_partkey, CASE WHEN p_partkey % 5 = 0 THEN NULL WHEN p_partkey % 2 = 0 THEN 'a,b' ELSE 'c,b' END AS a FROM part)""")
def merged_tags(spark, sf_dir):
    """M-9 / U-4: two tag lists united, each tag once, in first-seen order."""
    p = read_table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    own = F.when(k % 5 == 0, None).when(k % 2 == 0, F.array(F.lit("a"), F.lit("b"), F.lit("a"))).otherwise(F.array(F.lit("c"), F.lit("b")))
    given = F.when(k % 3 != 0, F.array(F.lit("b"), F.lit("c"), F.lit("b")))
    return p.select("p_partkey", F.array_join(tags.merge_lists(own, given), ",").alias("tags"))
