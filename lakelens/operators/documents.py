"""Documents (D-1 .. D-9, N-10): HTML to text, titles, links, site walks,
sanitising, chunking, and joining chunks with vectors.

HTML is handled with a fixed chain of regular expressions (no DOM): comments
and script / style / head / title blocks are removed, remaining tags become
spaces, entities are decoded, then the text is sanitised. On well-formed pages
this equals "visible text nodes, stripped, joined by newlines, sanitised"; on
broken markup it may differ (no parser repairs the tree).
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakelens.functions.scalars import col_of, sanitize_text

# Named entities decoded (name -> character).
NAMED_ENTITIES = {
    "lt": "<", "gt": ">", "quot": '"', "apos": "'", "nbsp": " ", "copy": "©", "reg": "®",
    "trade": "™", "middot": "·", "hellip": "…", "mdash": "—", "ndash": "–",
    "laquo": "«", "raquo": "»", "euro": "€", "deg": "°",
}
HIDDEN_BLOCKS = ("script", "style", "head", "title")


def unescape_entities(c) -> Column:
    """Decode the named entities above, decimal and hex numeric entities, and
    finally '&amp;' (last, so '&amp;lt;' stays '&lt;')."""
    x = col_of(c)
    for name, ch in NAMED_ENTITIES.items():
        x = F.replace(x, F.lit(f"&{name};"), F.lit(ch))
    # Numeric entities: decode each distinct code point through UTF-32.
    dec = F.array_distinct(F.regexp_extract_all(x, F.lit(r"&#([0-9]{1,7});"), 1))
    x = F.aggregate(dec, x, lambda acc, d: F.replace(
        acc, F.concat(F.lit("&#"), d, F.lit(";")),
        F.decode(F.unhex(F.lpad(F.hex(d.cast("long")), 8, "0")), "UTF-32")))
    hexes = F.array_distinct(F.regexp_extract_all(x, F.lit(r"&#[xX]([0-9a-fA-F]{1,6});"), 1))
    x = F.aggregate(hexes, x, lambda acc, h: F.regexp_replace(
        acc, F.concat(F.lit("&#[xX]"), h, F.lit(";")), F.decode(F.unhex(F.lpad(h, 8, "0")), "UTF-32")))
    return F.replace(x, F.lit("&amp;"), F.lit("&"))


def strip_html(c) -> Column:
    """Raw visible text (before sanitising): comments and hidden blocks
    removed, every tag replaced by a space, entities decoded."""
    x = F.regexp_replace(col_of(c), r"(?s)<!--.*?-->", " ")
    for tag in HIDDEN_BLOCKS:
        x = F.regexp_replace(x, rf"(?is)<{tag}\b[^>]*>.*?</{tag}\s*>", " ")
    x = F.regexp_replace(x, r"(?s)<[^>]*>", " ")
    return unescape_entities(x)


def text_from_html(c) -> Column:
    """D-1 + D-4: visible text, sanitised."""
    return sanitize_text(strip_html(c))


def title_from_html(c) -> Column:
    """D-2: text of the first <title> element, entities decoded; '' if none."""
    return unescape_entities(F.regexp_extract(col_of(c), r"(?is)<title\b[^>]*>(.*?)</title\s*>", 1))


URL_RE = r"^([A-Za-z][A-Za-z0-9+.-]*)://([^/?#]*)([^?#]*)"


def url_netloc(c) -> Column:
    return F.regexp_extract(col_of(c), URL_RE, 2)


def resolve_href(base, href) -> Column:
    """urljoin for the common forms: absolute, scheme-relative, root-relative,
    query/fragment-only and path-relative; dot segments are resolved."""
    b, h = col_of(base), col_of(href)
    scheme = F.regexp_extract(b, URL_RE, 1)
    netloc = F.regexp_extract(b, URL_RE, 2)
    path = F.regexp_extract(b, URL_RE, 3)
    no_frag = F.regexp_replace(b, "#.*$", "")
    no_query = F.regexp_replace(no_frag, r"\?.*$", "")
    directory = F.regexp_replace(path, "[^/]*$", "")
    joined = (F.when(h.startswith("//"), F.concat(scheme, F.lit(":"), h)).when(h.startswith("/"), F.concat(scheme, F.lit("://"), netloc, h))
              .otherwise(F.concat(scheme, F.lit("://"), netloc, F.when(directory == "", F.lit("/")).otherwise(directory), h)))
    return (
        F.when(h.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), h)
        .when(h == "", no_frag)
        .when(h.startswith("#"), F.concat(no_frag, h))
        .when(h.startswith("?"), F.concat(no_query, h))
        .when(joined.rlike(r"/\.{1,2}(/|$|[?#])"), without_dots(joined))
        .otherwise(joined)
    )


def without_dots(url) -> Column:
    """A url whose path has no ``.`` and ``..`` segments: each ``..`` takes the segment
    before it along, at the root it goes alone."""
    u = col_of(url)
    tail = F.regexp_extract(u, r"^[^?#]*(.*)$", 1)
    segments = F.split(F.regexp_replace(F.regexp_extract(u, URL_RE, 3), "^/", ""), "/")
    last = F.element_at(segments, -1)
    empty = F.array().cast("array<string>")
    kept = F.aggregate(segments, empty, lambda out, x: F.when(x == ".", out)
                       .when(x == "..", F.slice(out, 1, F.greatest(F.size(out) - 1, F.lit(0)))).otherwise(F.array_append(out, x)))
    # A path that ends in a dot segment names a folder.
    path = F.concat(F.lit("/"), F.array_join(kept, "/"), F.when(last.isin(".", "..") & (F.size(kept) > 0), F.lit("/")).otherwise(""))
    return F.concat(F.regexp_extract(u, URL_RE, 1), F.lit("://"), url_netloc(u), path, tail)


def page_links(pages: DataFrame, url: str = "url", html: str = "html", root_url: str | None = None) -> DataFrame:
    """D-3: (page, link, pos): the page itself at pos 0, then same-site links
    (netloc equal to the root page's), query and fragment removed, distinct,
    numbered by first occurrence."""
    root = col_of(root_url) if root_url else F.col(url)
    hrefs = F.regexp_extract_all(F.col(html), F.lit(r"""(?is)<a\b[^>]*?\bhref\s*=\s*("[^"]*"|'[^']*'|[^\s"'>][^\s>]*)"""), 1)
    x = pages.select("*", root.alias("__root"), F.posexplode(hrefs).alias("__i", "__href"))
    x = x.withColumn("__href", F.regexp_replace("__href", r"""(?s)^(["'])(.*)\1$""", "$2"))
    full = resolve_href(F.col(url), F.col("__href"))
    x = x.withColumn("__full", full).filter(url_netloc("__full") == url_netloc("__root"))
    stripped = F.regexp_extract(F.col("__full"), r"^([^?#]*)", 1)
    x = x.select(*[c for c in pages.columns if c != html], stripped.alias("link"), "__i")
    x = x.filter(F.col("link") != F.col(url))
    firsts = x.groupBy(*[c for c in pages.columns if c != html], "link").agg(F.min("__i").alias("__first"))
    selfs = pages.select(*[c for c in pages.columns if c != html], F.col(url).alias("link"), F.lit(-1).alias("__first"))
    both = firsts.unionByName(selfs)
    from pyspark.sql import Window
    w = Window.partitionBy(*[c for c in pages.columns if c != html]).orderBy("__first")
    return both.withColumn("pos", F.row_number().over(w) - 1).drop("__first")


def page_document(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """D-6: text, title, platform (network location), link and page id (md5 of the url)."""
    return pages.select(
        "*",
        text_from_html(F.col(html)).alias("text"),
        title_from_html(F.col(html)).alias("title"),
        url_netloc(F.col(url)).alias("platform"),
        F.col(url).alias("link"),
        F.md5(F.col(url)).alias("doc_page_id"),
    ).drop(html)


def word_chunks(text, size: int = 512, overlap: int = 50) -> Column:
    """D-7 (fixed mode): whitespace words in windows of ``size`` that start
    every ``size - overlap`` words; the whole text is covered, the last window
    may be shorter. Returns array<struct<chunk_no, n_words, text>>."""
    words = F.split(col_of(text), " ")
    step = size - overlap
    n = F.size(words)
    count = F.when(n <= size, F.lit(1)).otherwise(F.lit(1) + F.ceil((n - size) / step).cast("int"))
    return F.transform(F.sequence(F.lit(0), count - 1), lambda k: F.struct(
        k.alias("chunk_no"),
        F.size(F.slice(words, k * step + 1, size)).alias("n_words"),
        F.array_join(F.slice(words, k * step + 1, size), " ").alias("text"),
    ))


def chunk_documents(docs: DataFrame, text: str, size: int = 512, overlap: int = 50) -> DataFrame:
    """D-4 + D-7: sanitise, drop empty texts, one row per fixed word window
    (same windows as ``word_chunks``). The window numbers are exploded first
    and each row slices its own words with plain expressions, so the work
    stays in generated code (a lambda over the windows would run interpreted)."""
    keep = [c for c in docs.columns if c != text]
    step = size - overlap
    s = docs.select(*keep, F.split(sanitize_text(F.col(text)), " ").alias("__w"))
    s = s.filter(~((F.size("__w") == 1) & (F.get(F.col("__w"), 0) == "")))
    n = F.size("__w")
    count = F.when(n <= size, F.lit(1)).otherwise(F.lit(1) + F.ceil((n - size) / step).cast("int"))
    x = s.select(*keep, "__w", F.explode(F.sequence(F.lit(0), count - 1)).alias("chunk_no"))
    piece = F.slice("__w", F.col("chunk_no") * step + 1, size)
    return x.select(*keep, "chunk_no", F.size(piece).alias("n_words"), F.array_join(piece, " ").alias("text"))


SENTENCE_END = re.compile(r"[.!?][\"')\]]*$")


def sentence_spans(words: list[str], size: int) -> np.ndarray:
    """Ends (in words) of the sentences; longer ones end every ``size`` words too."""
    ends = [i + 1 for i, w in enumerate(words) if SENTENCE_END.search(w)]
    if not ends or ends[-1] < len(words):
        ends.append(len(words))
    starts = [0, *ends[:-1]]
    return np.array([cut for a, b in zip(starts, ends) for cut in (*range(a + size, b, size), b)])


def sentence_windows(words: list[str], size: int = 512, overlap: int = 50) -> list[tuple[int, int]]:
    """D-7: windows (start, end in words) of whole sentences. A window takes sentences
    while it has at most ``size`` words. The next one begins with the last sentences
    of it that have at most ``overlap`` words and leave room for a further one."""
    ends = sentence_spans(words, size)
    starts = np.concatenate([[0], ends[:-1]])
    out, first = [], 0
    while True:
        last = int(np.searchsorted(ends, starts[first] + size, side="right")) - 1
        out.append((int(starts[first]), int(ends[last])))
        if last == len(ends) - 1:
            return out
        least = max(ends[last] - overlap, ends[last + 1] - size)
        first = max(first + 1, int(np.searchsorted(starts, least, side="left")))


def chunk_sentences(docs: DataFrame, text: str, size: int = 512, overlap: int = 50) -> DataFrame:
    """D-4 + D-7: sanitise, drop empty texts, one row per window of whole sentences."""
    keep = [c for c in docs.columns if c != text]
    rows = docs.select(*keep, sanitize_text(F.col(text)).alias("text")).filter("text <> ''")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, no, n, pieces = [], [], [], []
            for i, whole in enumerate(batch.column("text").to_pylist()):
                words = whole.split(" ")
                for k, (a, b) in enumerate(sentence_windows(words, size, overlap)):
                    at.append(i)
                    no.append(k)
                    n.append(b - a)
                    pieces.append(" ".join(words[a:b]))
            same = batch.select(keep).take(pa.array(at, pa.int64()))
            yield pa.RecordBatch.from_arrays([*same.columns, pa.array(no, pa.int32()), pa.array(n, pa.int32()), pa.array(pieces, pa.string())],
                                             names=[*keep, "chunk_no", "n_words", "text"])

    schema = rows.select(*keep, F.lit(0).alias("chunk_no"), F.lit(0).alias("n_words"), "text").schema
    return rows.mapInArrow(cut, schema)


def search_document_id(*parts) -> Column:
    """D-8: EXTERNAL_DOCUMENT~<32 hex> from a deterministic chunk key."""
    return F.concat(F.lit("EXTERNAL_DOCUMENT~"), F.upper(F.md5(F.concat_ws(":", *[col_of(p).cast("string") for p in parts]))))


def embedded_string(title, text, include_title: bool = True) -> Column:
    return F.concat(F.lit("Title: "), col_of(title), F.lit("\n"), col_of(text)) if include_title else col_of(text)


def item_document(items: DataFrame, keys: list[str], order: str, label: str, text: str, header: Column | None = None) -> DataFrame:
    """N-10 / D-9: one document per item: 'label: sanitised text' lines in
    ``order``, each ending with a newline, after an optional header line."""
    line = F.concat(F.col(label), F.lit(": "), sanitize_text(F.col(text)), F.lit("\n"))
    docs = items.groupBy(*keys).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(F.col(order), line.alias("l")))),
                                 lambda s: s["l"]), "").alias("__body"),
        F.count(F.lit(1)).alias("n_lines"))
    return docs.withColumn("document", F.concat(header, F.col("__body")) if header is not None else F.col("__body")) \
        .drop("__body")
