"""Document jobs (D-1 .. D-9, N-10) on ``pages``, ``documents``, ``embeddings``
and ``conversations``."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakelens.functions.scalars import sanitize_text
from lakelens.operators import documents, graph
from lakelens.plans.common import r6
from lakelens.plans.registry import register
from lakelens.sources.tables import read_table, spread

_SANITIZE = "trim(regexp_replace(translate({x}, chr(10) || chr(9) || chr(13), '   '), ' +', ' ', 'g'), ' ')"
_STRIP = r"""replace(replace(replace(replace(replace(replace(replace(replace(replace(replace(replace(replace(replace(replace(replace(replace(replace(
  regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(html,
    '(?s)<!--.*?-->', ' ', 'g'), '(?is)<script\b[^>]*>.*?</script\s*>', ' ', 'g'), '(?is)<style\b[^>]*>.*?</style\s*>', ' ', 'g'),
    '(?is)<head\b[^>]*>.*?</head\s*>', ' ', 'g'), '(?is)<title\b[^>]*>.*?</title\s*>', ' ', 'g'), '(?s)<[^>]*>', ' ', 'g'),
  '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&apos;', ''''), '&nbsp;', chr(160)), '&copy;', '©'), '&reg;', '®'), '&trade;', '™'),
  '&middot;', '·'), '&hellip;', '…'), '&mdash;', '—'), '&ndash;', '–'), '&laquo;', '«'), '&raquo;', '»'), '&euro;', '€'), '&deg;', '°'),
  '&amp;', '&')"""
_TITLE = r"""replace(replace(replace(replace(replace(replace(replace(replace(replace(replace(replace(replace(replace(replace(replace(replace(replace(
  regexp_extract(html, '(?is)<title\b[^>]*>(.*?)</title\s*>', 1),
  '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&apos;', ''''), '&nbsp;', chr(160)), '&copy;', '©'), '&reg;', '®'), '&trade;', '™'),
  '&middot;', '·'), '&hellip;', '…'), '&mdash;', '—'), '&ndash;', '–'), '&laquo;', '«'), '&raquo;', '»'), '&euro;', '€'), '&deg;', '°'),
  '&amp;', '&')"""
PAGE_TEXT_SQL = _SANITIZE.format(x=_STRIP)


@register("page_text", f"""SELECT page_id, {PAGE_TEXT_SQL} AS text, CAST(length({PAGE_TEXT_SQL}) AS BIGINT) AS n_chars FROM pages""")
def page_text(spark, sf_dir):
    """D-1 + D-4: visible text of every page, sanitised."""
    p = spread(read_table(spark, sf_dir, "pages"))
    t = documents.text_from_html(F.col("html"))
    return p.select("page_id", t.alias("text")).withColumn("n_chars", F.length("text").cast("long"))


@register("page_title", f"""SELECT page_id, {_TITLE} AS title FROM pages""")
def page_title(spark, sf_dir):
    """D-2: page titles ('' when absent)."""
    p = spread(read_table(spark, sf_dir, "pages"))
    return p.select("page_id", documents.title_from_html(F.col("html")).alias("title"))


LINKS_SQL = r"""hr AS (
  SELECT page_id, url, unnest(h) AS href, unnest(generate_series(1, len(h))) AS i
  FROM (SELECT page_id, url, regexp_extract_all(html, '(?is)<a\b[^>]*?\bhref\s*=\s*"([^"]*)"', 1) AS h FROM pages)),
parts AS (SELECT *, regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*)://([^/?#]*)([^?#]*)', 1) AS scheme,
                 regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*)://([^/?#]*)([^?#]*)', 2) AS netloc,
                 regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*)://([^/?#]*)([^?#]*)', 3) AS path FROM hr),
full_urls AS (SELECT page_id, url, i, netloc,
  CASE WHEN regexp_matches(href, '^[A-Za-z][A-Za-z0-9+.-]*:') THEN href
       WHEN starts_with(href, '//') THEN scheme || ':' || href
       WHEN starts_with(href, '/') THEN scheme || '://' || netloc || href
       WHEN href = '' THEN regexp_replace(url, '#.*$', '')
       WHEN starts_with(href, '#') THEN regexp_replace(url, '#.*$', '') || href
       WHEN starts_with(href, '?') THEN regexp_replace(regexp_replace(url, '#.*$', ''), '\?.*$', '') || href
       ELSE scheme || '://' || netloc || CASE WHEN regexp_replace(path, '[^/]*$', '') = '' THEN '/' ELSE regexp_replace(path, '[^/]*$', '') END || href
  END AS f FROM parts),
same AS (SELECT page_id, url, i, regexp_extract(f, '^([^?#]*)', 1) AS link FROM full_urls
         WHERE regexp_extract(f, '^([A-Za-z][A-Za-z0-9+.-]*)://([^/?#]*)([^?#]*)', 2) = netloc),
firsts AS (SELECT page_id, url, link, min(i) AS first FROM same WHERE link <> url GROUP BY ALL
           UNION ALL SELECT page_id, url, url, -1 FROM pages),
links AS (SELECT page_id, url, link, row_number() OVER (PARTITION BY page_id, url ORDER BY first) - 1 AS pos FROM firsts)"""


@register("page_links", f"""WITH {LINKS_SQL} SELECT page_id, url, link, CAST(pos AS INTEGER) AS pos FROM links""")
def page_links(spark, sf_dir):
    """D-3: same-site links per page, page itself first, query/fragment removed, distinct."""
    p = spread(read_table(spark, sf_dir, "pages")).select("page_id", "url", "html")
    return documents.page_links(p).select("page_id", "url", "link", F.col("pos").cast("int").alias("pos"))


@register("page_documents", f"""SELECT url, md5(url) AS doc_page_id,
  regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*)://([^/?#]*)([^?#]*)', 2) AS platform,
  {_TITLE} AS title, md5({PAGE_TEXT_SQL}) AS text_md5 FROM pages""")
def page_documents(spark, sf_dir):
    """D-6: page documents (title, platform, link, md5 page id)."""
    d = documents.page_document(spread(read_table(spark, sf_dir, "pages")))
    return d.select("url", "doc_page_id", "platform", "title", F.md5("text").alias("text_md5"))


@register("page_walk", f"""WITH RECURSIVE {LINKS_SQL},
e AS (SELECT DISTINCT url AS src, link AS dst FROM links WHERE pos > 0),
roots AS (SELECT min(url) AS url FROM pages GROUP BY regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*)://([^/?#]*)([^?#]*)', 2)),
walk(node, hop) AS (SELECT url, 0 FROM roots
  UNION SELECT e.dst, walk.hop + 1 FROM walk JOIN e ON e.src = walk.node WHERE walk.hop < 1000),
best AS (SELECT node, min(hop) AS hop FROM walk GROUP BY node)
SELECT p.page_id, p.url, CAST(b.hop AS INTEGER) AS hop FROM best b JOIN pages p ON p.url = b.node""")
def page_walk(spark, sf_dir):
    """D-5: breadth-first site walks along page links, from the first url of every
    site until nothing new is found; no fetching."""
    p = spread(read_table(spark, sf_dir, "pages")).select("page_id", "url", "html")
    links = documents.page_links(p).filter(F.col("pos") > 0).select(F.col("url").alias("src"), F.col("link").alias("dst"))
    roots = p.groupBy(documents.url_netloc("url").alias("site")).agg(F.min("url").alias("url")).select("url")
    walked = graph.reachable(roots, links)
    return walked.join(p.select("page_id", F.col("url").alias("node")), "node").select(
        "page_id", F.col("node").alias("url"), F.col("hop").cast("int").alias("hop"))


@register("doc_sanitize", """SELECT doc_id, md5(trim(regexp_replace(translate(text, chr(10) || chr(9) || chr(13), '   '), ' +', ' ', 'g'), ' ')) AS text_md5,
  CAST(length(trim(regexp_replace(translate(text, chr(10) || chr(9) || chr(13), '   '), ' +', ' ', 'g'), ' ')) AS BIGINT) AS n_chars FROM documents""")
def doc_sanitize(spark, sf_dir):
    """D-4: whole documents sanitised (newlines/tabs/CR to spaces, runs collapsed, trimmed)."""
    d = spread(read_table(spark, sf_dir, "documents")).select("doc_id", sanitize_text(F.col("text")).alias("t"))
    return d.select("doc_id", F.md5("t").alias("text_md5"), F.length("t").cast("long").alias("n_chars"))


_CHUNKS_SQL = """clean AS (SELECT doc_id, source, string_split(trim(regexp_replace(translate(text, chr(10) || chr(9) || chr(13), '   '), ' +', ' ', 'g'), ' '), ' ') AS w
          FROM documents WHERE trim(regexp_replace(translate(text, chr(10) || chr(9) || chr(13), '   '), ' +', ' ', 'g'), ' ') <> ''),
ks AS (SELECT doc_id, source, w, unnest(range(0, CASE WHEN len(w) <= 512 THEN 1 ELSE 1 + CAST(ceil((len(w) - 512) / 462.0) AS BIGINT) END)) AS k FROM clean),
chunks AS (SELECT doc_id, source, CAST(k AS INTEGER) AS chunk_no, w[k * 462 + 1 : k * 462 + 512] AS cw FROM ks)"""


@register("doc_chunks", f"""WITH {_CHUNKS_SQL}
SELECT doc_id, chunk_no, CAST(len(cw) AS INTEGER) AS n_words, md5(array_to_string(cw, ' ')) AS chunk_md5 FROM chunks""")
def doc_chunks(spark, sf_dir):
    """D-7: whole documents cut into 512-word windows overlapping by 50."""
    d = spread(read_table(spark, sf_dir, "documents")).select("doc_id", "text")
    c = documents.chunk_documents(d, "text")
    return c.select("doc_id", "chunk_no", "n_words", F.md5("text").alias("chunk_md5"))


@register("chunk_vectors", f"""WITH {_CHUNKS_SQL}
SELECT 'EXTERNAL_DOCUMENT~' || upper(md5(CAST(c.doc_id AS VARCHAR) || ':' || CAST(c.chunk_no AS VARCHAR))) AS entity_id,
  c.doc_id, c.chunk_no, e.vec_id, e.label, CAST(len(e.embedding) AS INTEGER) AS dim,
  round(round(sqrt(list_sum(list_transform(e.embedding, lambda x: CAST(x AS DOUBLE) * CAST(x AS DOUBLE)))), 10), 6) AS norm,
  md5('Title: ' || c.source || chr(10) || array_to_string(c.cw, ' ')) AS embedded_md5
FROM chunks c JOIN embeddings e ON e.vec_id = c.doc_id + c.chunk_no""")
def chunk_vectors(spark, sf_dir, how="inner"):
    """D-8: chunks joined with their vectors into search documents (id, vector
    size and norm, digest of the 'Title: ...' embedded string); texts are hashed
    before the join."""
    d = spread(read_table(spark, sf_dir, "documents")).select("doc_id", "source", "text")
    c = documents.chunk_documents(d, "text").select(
        "doc_id", "chunk_no", (F.col("doc_id") + F.col("chunk_no")).alias("vec_key"),
        F.md5(documents.embedded_string(F.col("source"), F.col("text"))).alias("embedded_md5"))
    e = read_table(spark, sf_dir, "embeddings")
    j = c.join(e, c.vec_key == e.vec_id, how)
    sq = F.aggregate("embedding", F.lit(0.0).cast("double"), lambda acc, x: acc + x.cast("double") * x.cast("double"))
    return j.select(
        documents.search_document_id("doc_id", "chunk_no").alias("entity_id"),
        "doc_id", "chunk_no", "vec_id", "label", F.size("embedding").alias("dim"),
        r6(F.sqrt(sq)).alias("norm"),
        "embedded_md5",
    )


@register("chunk_vectors_all", f"""WITH {_CHUNKS_SQL}
SELECT 'EXTERNAL_DOCUMENT~' || upper(md5(CAST(c.doc_id AS VARCHAR) || ':' || CAST(c.chunk_no AS VARCHAR))) AS entity_id,
  c.doc_id, c.chunk_no, e.vec_id, e.label, CAST(len(e.embedding) AS INTEGER) AS dim,
  round(round(sqrt(list_sum(list_transform(e.embedding, lambda x: CAST(x AS DOUBLE) * CAST(x AS DOUBLE)))), 10), 6) AS norm,
  md5('Title: ' || c.source || chr(10) || array_to_string(c.cw, ' ')) AS embedded_md5
FROM chunks c LEFT JOIN embeddings e ON e.vec_id = c.doc_id + c.chunk_no""")
def chunk_vectors_all(spark, sf_dir):
    """D-8 for every chunk; vector columns are null where no vector has its key."""
    return chunk_vectors(spark, sf_dir, "left")


@register("item_documents", """SELECT conv_id, CAST(count(*) AS BIGINT) AS n_lines,
  md5('Conversation: ' || CAST(conv_id AS VARCHAR) || chr(10) ||
      string_agg(role || ': ' || trim(regexp_replace(translate(text, chr(10) || chr(9) || chr(13), '   '), ' +', ' ', 'g'), ' ') || chr(10), '' ORDER BY turn)) AS document_md5
FROM conversations GROUP BY conv_id""")
def item_documents(spark, sf_dir):
    """N-10 / D-9: one document per item from its labelled values in order."""
    c = read_table(spark, sf_dir, "conversations")
    header = F.concat(F.lit("Conversation: "), F.col("conv_id").cast("string"), F.lit("\n"))
    d = documents.item_document(c, ["conv_id"], "turn", "role", "text", header)
    return d.select("conv_id", "n_lines", F.md5("document").alias("document_md5"))
