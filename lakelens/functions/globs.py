"""Shell-style globs (``*``, ``?``, ``[seq]``, ``[!seq]``) as Java regexes.

``*`` crosses ``/``. The output avoids constructs that RE2 rejects, so the same
pattern text also runs in engines with RE2 syntax.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakelens.functions.scalars import col_of

_SPECIAL = set("\\.^$+{}()|*?[]/")


def _glob_chunks(pattern: str) -> list:
    """Split a glob into regex pieces, with None standing for each '*'."""
    out = []
    i, n = 0, len(pattern)
    while i < n:
        ch = pattern[i]
        i += 1
        if ch == "*":
            if not out or out[-1] is not None:
                out.append(None)
        elif ch == "?":
            out.append(".")
        elif ch == "[":
            j = i
            if j < n and pattern[j] == "!":
                j += 1
            if j < n and pattern[j] == "]":
                j += 1
            while j < n and pattern[j] != "]":
                j += 1
            if j >= n:
                out.append("\\[")
            else:
                body = pattern[i:j]
                i = j + 1
                neg = body.startswith("!")
                if neg:
                    body = body[1:]
                body = body.replace("\\", "\\\\").replace("[", "\\[").replace("]", "\\]").replace("^", "\\^")
                out.append("[" + ("^" if neg else "") + body + "]")
        elif ch in _SPECIAL:
            out.append("\\" + ch)
        else:
            out.append(ch)
    return out


def glob_to_regex(pattern: str, portable: bool = False) -> str:
    """F-24: full-match regex for a glob. The default (Java) form wraps every piece
    between two stars in an atomic lazy group, ``(?>.*?piece)``, so matching is
    linear instead of backtracking over every '*'. ``portable=True`` gives the
    plain form (no atomic groups) for RE2-style engines."""
    pieces = _glob_chunks(pattern)
    if portable:
        return "(?s)^" + "".join(".*" if p is None else p for p in pieces) + "\\z"
    # Group literal runs between stars.
    runs, cur = [], []
    for p in pieces:
        if p is None:
            runs.append("".join(cur))
            cur = []
        else:
            cur.append(p)
    runs.append("".join(cur))
    if len(runs) == 1:
        return "(?s)^" + runs[0] + "\\z"
    head, middle, tail = runs[0], runs[1:-1], runs[-1]
    body = head + "".join(f"(?>.*?{m})" for m in middle) + ".*" + tail
    return "(?s)^" + body + "\\z"


def glob_match(c, pattern: str) -> Column:
    """F-24: true where the column fully matches the glob (null-safe: null -> False)."""
    if pattern == "*":
        return col_of(c).isNotNull()
    if not any(ch in pattern for ch in "*?["):
        return F.coalesce(col_of(c) == F.lit(pattern), F.lit(False))
    return F.coalesce(col_of(c).rlike(glob_to_regex(pattern)), F.lit(False))


def python_glob_match(name: str, pattern: str) -> bool:
    """Driver-side twin used only by tests to cross-check the translator."""
    return re.match(glob_to_regex(pattern)[:-2] + "\\Z", name) is not None


@F.pandas_udf(T.StringType())
def _regexes(globs: pd.Series) -> pd.Series:
    return globs.map(glob_to_regex, na_action="ignore")


def glob_pairs(names: DataFrame, name_cols: Sequence[str], rules: DataFrame, glob_cols: Sequence[str]) -> DataFrame:
    """Rows of ``names`` with the rows of ``rules`` whose globs fit them, column by
    column; a null glob fits every name, no glob fits a null name.

    A rule is filed under that of its literals that fewest names have: the beginning or
    the end of one of its globs. A name brings its beginnings and ends of the lengths
    that occur, so the join is by equality and the regexes only see pairs with that
    literal. Rules without any literal meet every name."""
    filed = []
    for i, glob in enumerate(glob_cols):
        for kind, literal in ((2 * i, F.regexp_extract(glob, r"^[^*?\[]*", 0)), (2 * i + 1, F.regexp_extract(glob, r"[^*?\[\]]*$", 0))):
            literal = F.coalesce(literal, F.lit(""))
            filed.append(F.struct(F.length(literal).alias("n"), F.lit(kind).alias("kind"), literal.alias("literal")))
    patterns = [f"__re{i}" for i in range(len(glob_cols))]
    # Names and rules in few bytes are much work: they stay in as many parts as there are cores.
    parts = rules.sparkSession.sparkContext.defaultParallelism
    names = names.repartition(parts)
    places = F.explode(F.array_distinct(F.array(*filed)))
    wanted = rules.select(*glob_cols).distinct()
    offered = wanted.select("*", places.alias("__at"))

    def bring(found: DataFrame, used: Column) -> DataFrame:
        """``found`` with the pieces of its names, at the kinds and lengths in ``used``."""
        asked = found.select("*", F.explode(used).alias("__use"))
        name = F.element_at(F.array(*[F.col(c) for c in name_cols]), F.floor(F.col("__use.kind") / 2).cast("int") + 1)
        piece = F.when(F.col("__use.n") == 0, "").when(F.col("__use.kind") % 2 == 0, F.left(name, F.col("__use.n"))).otherwise(F.right(name, F.col("__use.n")))
        return asked.withColumn("__literal", piece).filter(F.length("__literal") == F.col("__use.n"))

    # One small row each time: the kinds and lengths in use, at most two for each length of a glob.
    told = bring(names, offered.agg(F.collect_set(F.struct("__at.kind", "__at.n"))).scalar())
    told = told.groupBy(F.col("__use.kind").alias("kind"), F.col("__literal").alias("literal")).agg(F.count(F.lit(1)).alias("__names"))
    weighed = offered.join(told, (F.col("__at.kind") == F.col("kind")) & (F.col("__at.literal") == F.col("literal")), "left") \
        .select(*glob_cols, "__at", F.coalesce("__names", F.lit(0)).alias("__names"))
    best = F.min_by("__at", F.struct("__names", -F.col("__at.n"), "__at.kind"))
    filing = weighed.groupBy(*glob_cols).agg(best.alias("__at")).select(*[F.col(g).alias(f"__own{i}") for i, g in enumerate(glob_cols)], "__at")
    own = [F.col(g).eqNullSafe(F.col(f"__own{i}")) for i, g in enumerate(glob_cols)]
    held = rules.join(filing, own).drop(*[f"__own{i}" for i in range(len(glob_cols))]).repartition(parts) \
        .select("*", *[_regexes(F.col(g)).alias(p) for g, p in zip(glob_cols, patterns)])
    asked = bring(names, held.agg(F.collect_set(F.struct("__at.kind", "__at.n"))).scalar())
    fits = (F.col("__use.kind") == F.col("__at.kind")) & (F.col("__literal") == F.col("__at.literal"))
    for c, p in zip(name_cols, patterns):
        fits = fits & (F.col(p).isNull() | F.regexp(F.col(c), F.col(p)))
    return asked.join(held, fits).drop("__use", "__literal", "__at", *patterns)
