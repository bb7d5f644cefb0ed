"""Q-5: table lineage of a statement by scope, folded over its tokens.

Everything happens inside the row: one regular expression cuts the text into
tokens, one pass notes what each token is and what stands beside it, and one fold
walks the tokens with a stack of scopes. A scope is a parenthesis level: what opened
it, the clause it is in, the common table expression whose body it is. A common
table expression is visible from the end of its body (with RECURSIVE from its begin)
to the end of the scope that has the WITH, so that it can shadow a table and be
shadowed again. There is no shuffle, and rows never see each other: two rows may
carry the same id.

Not covered: table functions, quoted names that hold dots, statements inside strings.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_PART = r'(?:"(?:[^"]|"")*"|`[^`]*`|\[[^\]]*\]|[A-Za-z_@#$][\w$@#/]*)'
# Comments and white space are skipped before a token; strings and names are one token.
TOKEN = (r"(?s)(?:\s++|--[^\n]*+|/\*.*?\*/)*+('(?:[^']|'')*+'|" + _PART + r"(?:\s*\.\s*(?:" + _PART + r"|\*))*+"
         r"|\d[\w.]*+|\S)")

# Words that are never table names.
RESERVED = (
    "SELECT FROM WHERE GROUP BY ORDER HAVING LIMIT OFFSET JOIN INNER LEFT RIGHT FULL OUTER CROSS NATURAL ON USING "
    "AS WITH RECURSIVE UNION ALL INTERSECT EXCEPT MINUS DISTINCT INSERT INTO OVERWRITE VALUES UPDATE SET DELETE MERGE "
    "WHEN MATCHED NOT THEN ELSE END CASE AND OR IN IS NULL TRUE FALSE EXISTS BETWEEN LIKE ILIKE CREATE REPLACE TABLE "
    "VIEW TEMP TEMPORARY TRANSIENT VOLATILE GLOBAL LOCAL EXTERNAL MATERIALIZED SECURE IF DROP ALTER TRUNCATE COPY "
    "LATERAL UNNEST WINDOW QUALIFY PARTITION OVER ROWS RANGE CLONE TOP FETCH FIRST NEXT ONLY ASC DESC NULLS LAST "
    "INTERVAL CAST DEFAULT PRIMARY KEY REFERENCES CONSTRAINT UNIQUE CHECK FOREIGN GRANT REVOKE RETURNING STDIN DIRECTORY"
).split()
# Words that begin a clause; JOIN, ON and USING belong to the FROM clause they stand in.
CLAUSES = ("SELECT", "FROM", "WHERE", "GROUP", "ORDER", "HAVING", "LIMIT", "SET", "VALUES", "INTO", "UNION", "INTERSECT", "EXCEPT",
           "MINUS", "WINDOW", "QUALIFY", "WHEN", "RETURNING")
VERBS = ("SELECT", "INSERT", "UPDATE", "DELETE", "MERGE", "CREATE", "REPLACE", "ALTER", "COPY", "DROP", "TRUNCATE", "GRANT", "REVOKE")
READING = ("SELECT", "WITH", "INSERT", "UPDATE", "DELETE", "MERGE", "CREATE", "REPLACE", "ALTER", "COPY")
# Words that may stand between CREATE and the name of a table or view.
HEAD = ("CREATE", "OR", "REPLACE", "TEMP", "TEMPORARY", "TRANSIENT", "VOLATILE", "GLOBAL", "LOCAL", "EXTERNAL", "MATERIALIZED", "SECURE",
        "RECURSIVE", "TABLE", "VIEW", "IF", "NOT", "EXISTS")
MORE_HEAD = ("MULTISET", "SET", "UNLOGGED", "DYNAMIC", "HYBRID", "ICEBERG")

FRAME = "struct<opened:string,clause:string,listing:string,pending:string,body:string>"
STATE = (f"struct<stack:array<{FRAME}>,ctes:array<struct<name:string,level:int>>,verb:string,head:boolean,"
         "found:array<struct<role:string,table:string>>>")


def plain_name(name: Column) -> Column:
    """Lower case, without quotes and without space around the dots."""
    return F.lower(F.regexp_replace(F.regexp_replace(name, r"\s*\.\s*", "."), r'["`\[\]]', ""))


# Words after which a name may be a table or the name of a common table expression.
BEFORE_NAMES = ("FROM", "JOIN", ",", "(", "USING", "LIKE", "CLONE", "INTO", "UPDATE", "OVERWRITE", "INSERT", "MERGE", "COPY", "WITH")
STEPS = (*CLAUSES, *VERBS, "WITH", "RECURSIVE", "VIEW", "(", ")", ";")


def _described(words: Column, uppers: Column) -> Column:
    """The tokens that the fold must see, with what stands beside them: brackets, words
    that begin a clause or a statement, and names in places where they may count."""
    near = lambda i, by: F.coalesce(F.get(uppers, i + F.lit(by)), F.lit(""))

    def one(word: Column, i: Column) -> Column:
        upper = F.element_at(uppers, i + 1)
        key = upper.isin(*RESERVED)
        return F.struct(word.alias("word"), upper.alias("u"), near(i, -1).alias("p1"), near(i, -2).alias("p2"), near(i, 1).alias("n1"), near(i, 2).alias("n2"),
                        key.alias("key"), (~key & word.rlike(r'^["`\[A-Za-z_#$@]')).alias("name"), upper.isin(*CLAUSES).alias("clause"))

    places = F.filter(F.transform(words, one), lambda t: t["u"].isin(*STEPS) | (t["name"] & t["p1"].isin(*BEFORE_NAMES, *HEAD, *MORE_HEAD)))
    return places


def _with(row: Column, fields: tuple[str, ...], **changes: Column) -> Column:
    return F.struct(*[changes.get(f, row[f]).alias(f) for f in fields])


_FRAME_FIELDS = ("opened", "clause", "listing", "pending", "body")
_STATE_FIELDS = ("stack", "ctes", "verb", "head", "found")


def _step(state: Column, token: Column) -> Column:
    """The state after one token."""
    stack, top = state["stack"], F.element_at(state["stack"], -1)
    depth = F.size(stack)
    no = F.lit(None).cast("string")
    # Comparisons with what may be null count as false.
    yes = lambda c: F.coalesce(c, F.lit(False))
    is_ = lambda c, *values: yes(c.isin(*values) if len(values) > 1 else c == values[0])
    on_top = lambda **changes: F.concat(F.slice(stack, 1, depth - 1), F.array(_with(top, _FRAME_FIELDS, **changes)))

    # "(": a scope of its own.
    from_list = is_(token["p1"], "FROM", "JOIN") | (is_(token["p1"], "(") & is_(top["opened"], "from")) | (is_(token["p1"], ",") & is_(top["clause"], "FROM"))
    body = F.when(is_(token["p1"], "AS", "MATERIALIZED"), top["pending"])
    frame = F.struct(
        F.when(from_list, "from").when(token["p1"].rlike(r'^["`\[A-Z_#$]') & ~token["p1"].isin(*RESERVED), "call").otherwise("group").alias("opened"),
        F.when(from_list, "FROM").alias("clause"), no.alias("listing"), no.alias("pending"), body.alias("body"))
    own_name = F.array(F.struct(body.alias("name"), depth.alias("level")))
    pushed = _with(state, _STATE_FIELDS, stack=F.concat(stack, F.array(frame)),
                   ctes=F.when(is_(top["listing"], "RECURSIVE") & body.isNotNull(), F.concat(state["ctes"], own_name)).otherwise(state["ctes"]))

    # ")": names of the scope end; a body that ends makes its name visible.
    left = F.when(F.size(state["ctes"]) > 0, F.filter(state["ctes"], lambda c: c["level"] < depth)).otherwise(state["ctes"])
    defined = F.array(F.struct(top["body"].alias("name"), (depth - 1).alias("level")))
    popped = F.when(depth > 1, _with(state, _STATE_FIELDS, stack=F.slice(stack, 1, depth - 1),
                                     ctes=F.when(top["body"].isNotNull(), F.concat(left, defined)).otherwise(left))).otherwise(state)

    # ";" begins another statement.
    fresh = _with(state, _STATE_FIELDS, stack=F.array(_empty_frame()), ctes=F.slice(state["ctes"], 1, 0), verb=no, head=F.lit(True))

    # Reserved words: statement kind, clause, begin of a list of common table expressions.
    verb = F.when(yes(token["u"].isin(*VERBS)) & (state["verb"].isNull() | ((depth == 1) & is_(state["verb"], "WITH"))), token["u"]) \
        .when(is_(token["u"], "WITH") & state["verb"].isNull(), token["u"]).otherwise(state["verb"])
    listing = is_(token["u"], "WITH") & (is_(token["n1"], "RECURSIVE") | is_(token["n2"], "AS", "("))
    listing = listing & ~is_(token["n1"], "(")
    hive_view = is_(token["u"], "VIEW") & is_(token["p1"], "LATERAL")
    opens_query = is_(token["p1"], "(") & is_(token["u"], "SELECT", "WITH", "VALUES")
    frames = F.when(listing, on_top(clause=F.lit("WITH"), listing=F.lit("WITH"), pending=no, opened=F.when(opens_query, "group").otherwise(top["opened"]))) \
        .when(is_(token["u"], "RECURSIVE") & is_(token["p1"], "WITH"), on_top(listing=token["u"])) \
        .when(token["clause"], on_top(clause=token["u"], listing=no, pending=no, opened=F.when(opens_query, "group").otherwise(top["opened"]))) \
        .when(hive_view, on_top(clause=token["u"])).otherwise(stack)
    word = _with(state, _STATE_FIELDS, stack=frames, verb=verb, head=state["head"] & token["u"].isin(*HEAD, *MORE_HEAD))

    # Names: a new common table expression, a table read, a table written.
    lists = top["listing"].isNotNull() & is_(top["clause"], "WITH") & is_(token["p1"], "WITH", "RECURSIVE", ",")
    table = plain_name(token["word"])
    placed = (is_(token["p1"], "FROM", "JOIN") & ~(is_(token["p1"], "FROM") & is_(token["p2"], "DELETE", "DISTINCT"))) \
        | (is_(token["p1"], "(") & is_(top["opened"], "from")) | (is_(token["p1"], ",") & is_(top["clause"], "FROM")) \
        | (is_(token["p1"], "USING") & is_(state["verb"], "MERGE", "DELETE")) \
        | (is_(token["p1"], "LIKE", "CLONE") & is_(state["verb"], "CREATE") & top["clause"].isNull()) \
        | (is_(token["p1"], "COPY") & is_(token["n1"], "TO"))
    hidden = F.exists(state["ctes"], lambda c: c["name"] == table)
    stage = token["word"].startswith("@")
    read = placed & ~is_(top["opened"], "call") & ~is_(token["n1"], "(") & ~stage & yes(state["verb"].isin(*READING)) & ~hidden
    updated = is_(token["p1"], "UPDATE") & ~is_(token["p2"], "FOR")
    written = is_(token["p1"], "INTO", "MERGE") | updated | (is_(token["p1"], "TABLE") & is_(token["p2"], "INTO", "OVERWRITE")) \
        | (is_(token["p1"], "OVERWRITE", "INSERT") & is_(state["verb"], "INSERT")) | (is_(token["p1"], "COPY") & is_(token["n1"], "FROM", "(")) \
        | (is_(token["p1"], "TABLE", "VIEW", "EXISTS") & state["head"] & is_(state["verb"], "CREATE", "REPLACE"))
    written = written & ~stage & ~is_(top["opened"], "call")
    row = lambda role: F.array(F.struct(F.lit(role).alias("role"), table.alias("table")))
    still_head = state["head"] & is_(token["u"], *MORE_HEAD)
    named = F.when(lists, _with(state, _STATE_FIELDS, stack=on_top(pending=table))) \
        .when(written, _with(state, _STATE_FIELDS, head=F.lit(False),
                             found=F.when(updated, F.concat(state["found"], row("target"), row("source"))).otherwise(F.concat(state["found"], row("target"))))) \
        .when(read, _with(state, _STATE_FIELDS, head=F.lit(False), found=F.concat(state["found"], row("source")))) \
        .otherwise(_with(state, _STATE_FIELDS, head=still_head))

    return F.when(token["u"] == "(", pushed).when(token["u"] == ")", popped).when((token["u"] == ";") & (depth == 1), fresh) \
        .when(token["key"], word).when(token["name"], named).otherwise(state)


def _empty_frame() -> Column:
    return F.struct(*[F.lit(None).cast("string").alias(f) for f in _FRAME_FIELDS])


def table_lineage(df: DataFrame, qid: str, sql: str) -> DataFrame:
    """(qid, role, table): the tables a statement reads ('source') and writes
    ('target'), each once per row of ``df``; names in lower case without quotes.

    Read: tables after FROM and JOIN, further ones in a FROM list, MERGE or DELETE ...
    USING, CREATE ... LIKE / CLONE, the table of an UPDATE, COPY ... TO. Written: INSERT
    (also each INTO of a multi-table insert), UPDATE, MERGE, CREATE or REPLACE of tables
    and views, COPY INTO, SELECT ... INTO. Stages (names with @) are neither."""
    # The generators keep the optimizer from computing the token arrays at every use.
    cut = df.select(F.col(qid).alias("qid"), F.explode(F.array(F.regexp_extract_all(F.col(sql), F.lit(TOKEN), 1))).alias("words"))
    cut = cut.select("qid", "words", F.explode(F.array(F.transform("words", F.upper))).alias("uppers"))
    told = cut.select("qid", F.explode(F.array(_described(F.col("words"), F.col("uppers")))).alias("tokens"))
    start = F.struct(F.array(_empty_frame()).alias("stack"), F.array().cast("array<struct<name:string,level:int>>").alias("ctes"),
                     F.lit(None).cast("string").alias("verb"), F.lit(True).alias("head"),
                     F.array().cast("array<struct<role:string,table:string>>").alias("found"))
    found = F.aggregate("tokens", start.cast(STATE), _step, lambda s: F.array_distinct(s["found"]))
    return told.select("qid", F.inline(found))
