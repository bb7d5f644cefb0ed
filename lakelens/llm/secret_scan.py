"""Secret scans through a trigram index (operator 4, native).

From each rule's regex a Boolean query over trigrams is derived: any match must
contain all trigrams of at least one clause. The index holds, for every trigram
that some query uses, the documents whose lower-cased text contains it; postings
of a clause are intersected by merging bit masks per document, and only the
candidates are verified with the regex. Rules without a mandatory trigram scan
every text.

Match positions come from the gaps between matches (``split``) and the matches
(``regexp_extract_all``): both walk the same leftmost non-overlapping matches, so
running sums of their lengths are code-point offsets.

Defined cases: a null text is empty; a text without secrets has zero counts, an
empty ``spans`` and the digest of an empty string; whole texts of any length are
searched; repeated rows each get a row; other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakelens.llm.common import table

parse = re._parser.parse  # the standard library's regex reader


class Rule(NamedTuple):
    kind: str
    regex: str
    group: int = 0
    least: int = 1  # matches whose ``group`` is shorter are dropped


#: Base kinds, fixed by the task. ``{24,}`` and ``{16,}`` find the same matches as
#: ``+`` with a length filter, because a match always takes its whole run.
BASE = (
    Rule("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", r"[0-9a-f]{24,}"),
)
#: Further kinds that the index makes cheap: well-known public token formats.
MORE = (
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("git_token", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("chat_token", r"xox[abprs]-[0-9A-Za-z-]{10,}"),
    Rule("cloud_key", r"AIza[0-9A-Za-z_-]{35}"),
    Rule("web_token", r"eyJ[0-9A-Za-z_-]{10,}\.[0-9A-Za-z_-]{10,}\.[0-9A-Za-z_-]{10,}"),
)


# A state is (trigrams seen on the way, the last two characters of the open literal).
def _add(states: set, char: str) -> set:
    grown = set()
    for grams, tail in states:
        text = tail + char.lower()
        grown.add((grams | {text} if len(text) == 3 else grams, text[-2:]))
    return grown


def _prune(states: set) -> set:
    """A state is needless if another asks for less and ends alike."""
    return {s for s in states if not any(o != s and o[1] == s[1] and o[0] <= s[0] for o in states)}


def _walk(states: set, items) -> set:
    for op, arg in items:
        name = str(op)
        if name == "LITERAL":
            states = _add(states, chr(arg))
        elif name == "IN" and len(arg) <= 8 and all(str(o) == "LITERAL" for o, _ in arg):
            states = set().union(*(_add(states, chr(c)) for _, c in arg))
        elif name == "SUBPATTERN":
            states = _walk(states, arg[3])
        elif name == "BRANCH":
            states = set().union(*(_walk(states, branch) for branch in arg[1]))
        elif name in ("MAX_REPEAT", "MIN_REPEAT"):
            low, high, body = arg
            if (low, high) == (0, 1):
                states = states | _walk(states, body)
            else:
                for _ in range(min(low, 2)):
                    states = _walk(states, body)
                if int(high) > min(low, 2):
                    states = {(grams, "") for grams, _ in states}
        elif name != "AT":
            states = {(grams, "") for grams, _ in states}
        states = _prune(states)
    return states


RUN = 512  # hits whose offsets are summed in one fold


def trigram_clauses(regex: str) -> list[frozenset] | None:
    """Clauses of which one must be present in full, or None: scan every text."""
    clauses = {(grams, "") for grams, _ in _walk({(frozenset(), "")}, parse(regex))}
    clauses = [grams for grams, _ in _prune(clauses)]
    return None if frozenset() in clauses else sorted(clauses, key=sorted)


def candidates(docs: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """(key, kinds): the indexed rules that a document may match; ``docs`` has key, text."""
    spark = docs.sparkSession
    rows = [(gram, rule.kind, n, 1 << i, (1 << len(clause)) - 1)
            for rule in rules for n, clause in enumerate(trigram_clauses(rule.regex) or ())
            for i, gram in enumerate(sorted(clause))]
    queries = spark.createDataFrame(rows, "gram string, kind string, clause int, bit long, full long")
    grams = sorted({row[0] for row in rows})
    low = docs.select("key", F.lower("text").alias("low"))
    hit = [F.when(F.contains("low", F.lit(g)), F.lit(g)) for g in grams]
    index = low.select("key", F.explode_outer(F.array(*hit)).alias("gram")).filter("gram IS NOT NULL")
    merged = index.join(F.broadcast(queries), "gram").groupBy("key", "kind", "clause", "full").agg(F.bit_or("bit").alias("mask"))
    return merged.filter("mask = full").groupBy("key").agg(F.collect_set("kind").alias("kinds"))


def _spans(text: Column, order: int, rule: Rule) -> Column:
    """array<(start, order, end)> of a rule's matches, end exclusive.

    Offsets are running sums over the gaps and hits of a text. They are taken in runs of
    ``RUN`` hits, each from the sum of the runs before it, so that a text with very many
    hits does not copy its spans at every hit."""
    regex = F.lit(rule.regex)
    found = F.regexp_extract_all(text, regex, F.lit(0))
    steps = F.arrays_zip(F.split(text, rule.regex, -1).alias("gap"), found.alias("hit"), F.regexp_extract_all(text, regex, F.lit(rule.group)).alias("part"))
    kind = "array<struct<start:int,kind:int,end:int>>"
    length = lambda m: F.char_length(m["gap"]) + F.coalesce(F.char_length(m["hit"]), F.lit(0))
    start = lambda s, m: s["at"] + F.char_length(m["gap"])

    def run(steps: Column, at: Column) -> Column:
        return F.aggregate(
            steps, F.struct(at.alias("at"), F.array().cast(kind).alias("out")),
            lambda s, m: F.struct(
                (s["at"] + length(m)).alias("at"),
                F.when(F.char_length(m["part"]) >= rule.least, F.array_append(s["out"], F.struct(
                    start(s, m).alias("start"), F.lit(order).alias("kind"), (s["at"] + length(m)).alias("end")))).otherwise(s["out"]).alias("out")),
            lambda s: s["out"])

    def walked(steps: Column) -> Column:
        runs = F.transform(F.sequence(F.lit(0), F.floor((F.size(steps) - 1) / RUN).cast("int")), lambda i: F.slice(steps, i * RUN + 1, RUN))
        return let(runs, lambda runs: F.flatten(F.zip_with(runs, before(runs), run)))

    def before(runs: Column) -> Column:
        sums = F.transform(runs, lambda r: F.aggregate(r, F.lit(0), lambda t, m: t + length(m)))
        return F.aggregate(sums, F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out")),
                           lambda s, x: F.struct((s["at"] + x).alias("at"), F.array_append(s["out"], s["at"]).alias("out")), lambda s: s["out"])

    return F.when(F.rlike(text, regex), let(steps, walked)).otherwise(F.array().cast(kind))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _joined(spans: Column, rules: tuple[Rule, ...]) -> Column:
    names = F.array(*[F.lit(rule.kind) for rule in rules])
    return F.array_join(F.transform(F.sort_array(spans), lambda s: F.concat_ws(":", names[s["kind"]], s["start"].cast("string"), s["end"].cast("string"))), ",")


def secret_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", more: tuple[Rule, ...] = MORE,
                keep: bool = False) -> DataFrame:
    """(doc_id, n_<kind> of the base kinds, base_spans, spans) for every row.

    The last two are ``kind:start:end`` by start, then kind as listed. ``keep``
    adds the row as ``record``."""
    rules = BASE + more
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"), F.xxhash64(id_col, text).alias("key"),
                       *([F.struct("*").alias("record")] if keep else []))
    extra = ["record"] if keep else []
    # Equal keys of different rows only make a document a candidate needlessly.
    marked = rows.join(candidates(rows.select("key", "text"), rules), "key", "left")
    scanned = {rule.kind for rule in rules if trigram_clauses(rule.regex) is None}
    none = F.array().cast("array<struct<start:int,kind:int,end:int>>")
    found = marked.select("doc_id", *extra, *[
        (spans if rule.kind in scanned else F.when(F.array_contains("kinds", rule.kind), spans).otherwise(none)).alias(rule.kind)
        for n, rule in enumerate(rules) for spans in [_spans(F.col("text"), n, rule)]])
    # Materialised behind a generator, so that no span is computed twice.
    found = found.select("doc_id", *extra, F.explode(F.array(F.struct(*[r.kind for r in rules]))).alias("s"))
    base = [F.col(f"s.{rule.kind}") for rule in BASE]
    return found.select(
        "doc_id", *extra, *[F.size(c).cast("long").alias(f"n_{r.kind}") for r, c in zip(BASE, base, strict=True)],
        _joined(F.concat(*base), rules).alias("base_spans"),
        _joined(F.concat(*[F.col(f"s.{rule.kind}") for rule in rules]), rules).alias("spans"))


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2("base_spans", 256).alias("base_sha256"), "spans")


def _sql_regex(regex: str) -> str:
    """RE2 folds some non-ASCII letters under (?i), so both cases are spelled out."""
    body = re.sub(r"\(\?i:(\(.*?\))\)", lambda m: re.sub("[a-z]", lambda c: f"[{c[0].upper()}{c[0]}]", m[1]), regex)
    return body.replace("'", "''")


def _sql() -> str:
    found = "\nUNION ALL ".join(
        f"""SELECT rid, {n} AS k, '{rule.kind}' AS kind, unnest(range(1, len(m) + 1)) AS i, m, p, g, {rule.least} AS least FROM (
        SELECT rid, regexp_extract_all(text, '{rx}') AS m, regexp_extract_all(text, '{rx}', {rule.group}) AS p,
               string_split_regex(text, '{rx}') AS g FROM t)"""
        for n, rule in enumerate(BASE + MORE) for rx in [_sql_regex(rule.regex)])
    return f"""
WITH t AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
f AS ({found}),
s AS (SELECT rid, k, kind, (list_sum([length(x) FOR x IN g[1:i]]) + coalesce(list_sum([length(x) FOR x IN m[1:i-1]]), 0))::BIGINT AS b,
             length(m[i]) AS n FROM f WHERE length(p[i]) >= least),
a AS (SELECT rid, count(*) FILTER (k = 0) AS n_assign, count(*) FILTER (k = 1) AS n_access, count(*) FILTER (k = 2) AS n_hex,
             coalesce(string_agg(kind || ':' || b || ':' || (b + n), ',' ORDER BY b, k) FILTER (k < {len(BASE)}), '') AS base,
             string_agg(kind || ':' || b || ':' || (b + n), ',' ORDER BY b, k) AS spans FROM s GROUP BY rid)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM t LEFT JOIN a USING (rid)
"""


OP4_SQL = _sql()
