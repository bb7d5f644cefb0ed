"""Tags and governance assignments (M-1, M-2, M-9, M-10, W-7, G-9, G-10).

Tag matchers and governance rules are configuration, or rule tables of any size;
the datasets they apply to are DataFrames of any size.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakelens.functions.globs import glob_match, glob_pairs
from lakelens.functions.scalars import col_of


@dataclass(frozen=True)
class TagMatcher:
    pattern: str
    tags: tuple


def match_tags(name, matchers: Sequence[TagMatcher]) -> Column:
    """M-1: tags of every matcher whose (lower-cased) glob matches ``name``,
    in matcher order, duplicates removed keeping the first."""
    empty = F.array().cast("array<string>")
    parts = [
        F.when(glob_match(col_of(name), m.pattern.lower()), F.array(*[F.lit(t) for t in m.tags])).otherwise(empty)
        for m in matchers
    ]
    if not parts:
        return empty
    return F.array_distinct(F.concat(*parts))


def tag_datasets(df: DataFrame, name: str, matchers: Sequence[TagMatcher], out: str = "tag_names") -> DataFrame:
    """Attach the tags of configured matchers; rows without a match get null."""
    tags = match_tags(name, matchers)
    return df.withColumn(out, F.when(F.size(tags) > 0, tags))


def tag_by_rules(df: DataFrame, name: str, rules: DataFrame, out: str = "tag_names") -> DataFrame:
    """M-1 with a rule table of any size (rule_no, tag_no, pattern, tag): patterns in
    lower case, each distinct name matched once, tags in rule order, each once; rows
    without a match get null."""
    names = df.select(F.col(name).alias("__name")).distinct()
    low = rules.select("rule_no", "tag_no", "tag", F.lower("pattern").alias("pattern"))
    hits = glob_pairs(names, ["__name"], low, ["pattern"]).groupBy("__name", "tag").agg(F.min(F.struct("rule_no", "tag_no")).alias("__pos"))
    tags = hits.groupBy("__name").agg(F.transform(F.array_sort(F.collect_list(F.struct("__pos", "tag"))), lambda s: s["tag"]).alias(out))
    return df.join(tags, df[name] == F.col("__name"), "left").drop("__name")


def override_by_level(assignments: DataFrame, target_cols: Sequence[str], key: str = "tag_key",
                      value: str = "tag_value", level: str = "level") -> DataFrame:
    """W-7 / G-10: per (target, key) the value from the most specific level
    wins (database < schema < table < column). ``max_by`` over the level keeps
    this a single aggregation with map-side partial merge."""
    return assignments.groupBy(*target_cols, key).agg(F.max_by(F.col(value), F.col(level)).alias(value))


def propagate_concat(levels: Sequence[DataFrame], target_cols: Sequence[str], tag: str = "tag") -> DataFrame:
    """G-9: tags of catalog, schema and table concatenated in that order.
    Each input is (target..., seq, tag) already keyed down to the targets."""
    union = levels[0]
    for lv in levels[1:]:
        union = union.unionByName(lv)
    return union.groupBy(*target_cols).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("seq", tag))), lambda s: s[tag]).alias("tags")
    )


def system_tags(tags) -> Column:
    """M-10: (key, value) items -> key/value structs; an empty value moves the
    key into the value (a bare tag)."""
    return F.transform(
        col_of(tags),
        lambda t: F.when((t["value"].isNull()) | (t["value"] == ""), F.struct(F.lit(None).cast("string").alias("key"), t["key"].alias("value")))
        .otherwise(F.struct(t["key"].alias("key"), t["value"].alias("value"))),
    )


def merge_lists(a, b) -> Column:
    """M-9 / U-4: union of two lists keeping first-seen order."""
    return F.array_distinct(F.concat(F.coalesce(col_of(a), F.array()), F.coalesce(col_of(b), F.array())))
