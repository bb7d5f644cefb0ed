"""SQL-text operators over query-log tables (Q-1 .. Q-4, Q-6, Q-9, Q-10). No parser.

A query text is cut into tokens with one regular expression on the JVM
(``regexp_extract_all``): comments, quoted strings, (qualified) identifiers,
numbers, whitespace and single characters. The tokens cover the whole text, so
joining them gives it back, which is how literals are redacted in place. Table
lineage (Q-5) is in ``sqlscope``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from lakelens.functions.scalars import col_of

_IDENT = r'(?:"(?:[^"]|"")*"|`[^`]*`|\[[^\]]*\]|[A-Za-z_@#$][\w$@#]*)'
TOKEN_RE = (
    r"(?s)--[^\n]*|/\*.*?\*/|'(?:[^']|'')*'"
    + r"|" + _IDENT + r"(?:\s*\.\s*(?:" + _IDENT + r"|\*))*"
    + r"|\d+(?:\.\d*)?(?:[eE][+-]?\d+)?|\.\d+|\s+|."
)

# Reserved words that are never table names.
KEYWORDS = (
    "SELECT FROM WHERE GROUP BY ORDER HAVING LIMIT OFFSET JOIN INNER LEFT RIGHT FULL OUTER CROSS NATURAL ON USING "
    "AS WITH RECURSIVE UNION ALL INTERSECT EXCEPT MINUS DISTINCT INSERT INTO OVERWRITE VALUES UPDATE SET DELETE MERGE "
    "WHEN MATCHED NOT THEN ELSE END CASE AND OR IN IS NULL TRUE FALSE EXISTS BETWEEN LIKE ILIKE CREATE OR REPLACE TABLE "
    "VIEW TEMP TEMPORARY TRANSIENT VOLATILE GLOBAL LOCAL EXTERNAL MATERIALIZED SECURE IF DROP ALTER TRUNCATE COPY "
    "LATERAL UNNEST WINDOW QUALIFY PARTITION OVER ROWS RANGE CLONE TOP FETCH FIRST NEXT ONLY ASC DESC NULLS LAST "
    "INTERVAL CAST DEFAULT PRIMARY KEY REFERENCES CONSTRAINT UNIQUE CHECK FOREIGN GRANT REVOKE"
).split()
REDACTED = "<REDACTED>"


def tokens(sql) -> Column:
    """All tokens of a text, in order; ``array_join(tokens, '')`` gives it back."""
    return F.regexp_extract_all(col_of(sql), F.lit(TOKEN_RE), 0)


def redact_literals(sql, placeholder: str = REDACTED, collapse_space: bool = True) -> Column:
    """Q-1: every string and numeric literal becomes '<placeholder>' (quoted);
    identifiers, comments and keywords stay. Whitespace runs become one space."""
    ph = F.lit(f"'{placeholder}'")

    def conv(t):
        is_str = t.startswith("'")
        is_num = t.rlike(r"^(\d+(\.\d*)?([eE][+-]?\d+)?|\.\d+)$")
        out = F.when(is_str | is_num, ph)
        if collapse_space:
            out = out.when(t.rlike(r"^\s+$"), F.lit(" "))
            # A line comment would swallow the rest of the statement once its
            # newline is gone: write it as a block comment.
            out = out.when(t.startswith("--"), F.concat(F.lit("/* "), F.trim(F.substring(t, F.lit(3), F.length(t))), F.lit(" */")))
        return out.otherwise(t)
    return F.trim(F.array_join(F.transform(tokens(sql), conv), ""))


def first_keyword(sql) -> Column:
    """Upper-cased first word after leading comments, spaces and parentheses
    (null when there is none)."""
    w = F.regexp_extract(col_of(sql), r"(?s)^(?:\s|\(|--[^\n]*(?:\n|$)|/\*.*?\*/)*([A-Za-z_]\w*)", 1)
    return F.when(w != "", F.upper(w))


# Statement kinds that can carry lineage.
LINEAGE_STATEMENTS = ("SELECT", "WITH", "INSERT", "UPDATE", "DELETE", "MERGE", "CREATE", "ALTER", "DROP",
                      "TRUNCATE", "COPY", "REPLACE", "UPSERT")


def is_insert_values(sql) -> Column:
    """INSERT INTO t [(cols)] VALUES ... (no query)."""
    return col_of(sql).rlike(r"(?is)^\s*insert\s+(into\s+)?[^\s(]+\s*(\([^)]*\)\s*)?values\b")


def keep_statement(sql, ignore_insert_values: bool = True, ignore_commands: bool = True) -> Column:
    """Q-2: keep DML / DDL / queries; drop INSERT ... VALUES (optional) and
    commands (SHOW, USE, SET, CALL, GRANT, ...)."""
    kw = first_keyword(sql)
    keep = kw.isin(*LINEAGE_STATEMENTS) if ignore_commands else F.lit(True)
    if ignore_insert_values:
        keep = keep & ~is_insert_values(sql)
    return F.coalesce(keep, F.lit(False))


# Fixed patterns: statements passed through unchanged.
BAD_QUERY_PATTERNS = (r"GET '?@", r"DESCRIBE EXTENDED [^ ]+ [^ ]+")


def is_bad_query(sql) -> Column:
    """Q-3."""
    c = F.lit(False)
    for p in BAD_QUERY_PATTERNS:
        c = c | col_of(sql).rlike(p)
    return c


@dataclass(frozen=True)
class QueryRules:
    """What is done with a query text; nothing unless asked for."""
    redact: bool = False
    placeholder: str = REDACTED
    drop_insert_values: bool = False
    drop_commands: bool = False

    @property
    def any(self) -> bool:
        return self.redact or self.drop_insert_values or self.drop_commands


def process_query(sql, rules: QueryRules = QueryRules()) -> Column:
    """Q-1..Q-4 together: null for statements that ``rules`` drop, the text as it is
    for known-bad patterns and without rules, otherwise the text without load options,
    with literals redacted if asked for."""
    s = col_of(sql)
    if not rules.any:
        return s
    text = drop_copy_into_options(s)
    if rules.redact:
        text = redact_literals(text, rules.placeholder)
    return F.when(is_bad_query(s), s).when(keep_statement(s, rules.drop_insert_values, rules.drop_commands), text)


# Load options of COPY INTO; the first ones hold a list in parentheses.
LIST_OPTIONS = ("FILES", "CREDENTIALS", "ENCRYPTION", "FILE_FORMAT")
VALUE_OPTIONS = ("REGION", "PURGE", "ON_ERROR", "SIZE_LIMIT", "RETURN_FAILED_ONLY", "MATCH_BY_COLUMN_NAME", "INCLUDE_METADATA", "ENFORCE_LENGTH",
                 "TRUNCATECOLUMNS", "FORCE", "LOAD_UNCERTAIN_FILES", "STORAGE_INTEGRATION", "FILE_FORMAT", "MAX_FILE_SIZE")
_STRING = r"'(?:[^']|'')*+'"
_OPTION = (rf"\s*\b(?:(?:{'|'.join(LIST_OPTIONS)})\s*=\s*\((?:[^()']|{_STRING}|\((?:[^()']|{_STRING})*+\))*+\)"
           rf"|(?:{'|'.join(VALUE_OPTIONS)})\s*=\s*(?:{_STRING}|[^\s,>()']++))")


def drop_copy_into_options(sql) -> Column:
    """Q-4: COPY INTO statements without their load options, others unchanged. One
    pass: a string that is no option's value is passed over whole and stays."""
    s = F.trim(col_of(sql))
    return F.when(s.rlike(r"(?i)^\s?copy into"), F.regexp_replace(s, rf"(?is)({_STRING})|{_OPTION}", "$1")).otherwise(s)


def is_truncated_insert_values(sql) -> Column:
    """Q-10: an INSERT ... VALUES text cut off by the log ('...' at the end)."""
    return is_insert_values(sql) & F.rtrim(col_of(sql)).endswith("...")


def fill_defaults(table, default_db, default_schema) -> Column:
    """Q-6: complete 1- and 2-part names with the session database / schema."""
    n = F.size(F.split(col_of(table), r"\."))
    return (F.when(n == 1, F.concat_ws(".", col_of(default_db), col_of(default_schema), col_of(table)))
            .when(n == 2, F.concat_ws(".", col_of(default_db), col_of(table)))
            .otherwise(col_of(table)))


def select_column_mapping(sql) -> Column:
    """Q-9 (simple SELECT lists): array of (target, source) for items of the form
    ``expr [AS] alias``; the source is every column reference of the item."""
    body = F.regexp_extract(col_of(sql), r"(?is)^\s*select\s+(.*?)\s+from\s", 1)
    items = F.split(body, r",(?![^(]*\))")

    def item(x):
        x = F.trim(x)
        alias = F.regexp_extract(x, r"(?i)(?:\bas\s+)?([A-Za-z_][\w]*)$", 1)
        # Column references: whole words not followed by '(' (functions are not columns).
        refs = F.filter(F.regexp_extract_all(x, F.lit(r"\b([A-Za-z_]\w*(?:\.[A-Za-z_]\w*)?)\b(?!\s*\()"), 1),
                        lambda r: ~F.upper(r).isin(*KEYWORDS) & (F.lower(r) != F.lower(alias)))
        return F.struct(F.lower(alias).alias("target"), F.transform(refs, lambda r: F.lower(r)).alias("sources"))
    return F.transform(items, item)
