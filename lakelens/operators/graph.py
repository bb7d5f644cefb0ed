"""Graph walks over edge DataFrames (G-1, G-2, G-3, G-4, G-13, D-5).

Parent chains (G-1, G-13, G-7) are followed by doubling: after k rounds every
node knows its 2^k-th ancestor, so a chain of any depth takes log2(depth) rounds
and each closure row is made and written once. A node that still has an
ancestor beyond the number of all nodes is on, or leads into, a cycle. Walks over
general edges (G-2, G-3, D-5) are frontier loops: a round joins only what the
previous round found with the edge table and ends when nothing new is found, so
cycles end by themselves. There is no depth limit.

Rounds are cut from their lineage with a reliable ``checkpoint()`` (written to
``spark.checkpoint.dir``), so a lost executor recomputes one round, not the
whole loop. The only driver actions are counts and emptiness tests.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakelens.session import cut_lineage


PARTS = 16  # rounds kept apart before they are written as one


def _merged(parts: list[DataFrame]) -> list[DataFrame]:
    """``parts``, as one once they are many, so that plans of long walks stay small."""
    if len(parts) < PARTS:
        return parts
    one = reduce(DataFrame.unionByName, parts)
    return [cut_lineage(one.coalesce(one.sparkSession.sparkContext.defaultParallelism))]


def _jumps(nodes: DataFrame, node: str, parent: str) -> tuple[list[DataFrame], DataFrame]:
    """Rounds of (node, jump, lost), where the k-th holds the 2^k-th ancestor or
    null, and (node, broken) for every node. Of rows that repeat an id the
    smallest parent counts; null ids are no nodes."""
    n = cut_lineage(nodes.filter(F.col(node).isNotNull()).groupBy(F.col(node).alias("node")).agg(F.min(parent).alias("parent")))
    known = n.select(F.col("node").alias("jump"))
    rounds = [cut_lineage(n.join(known, n.parent == known.jump, "left").select(
        "node", "jump", (F.col("parent").isNotNull() & F.col("jump").isNull()).alias("lost")))]
    total, span = n.count(), 1
    while span <= total and not rounds[-1].filter("jump IS NOT NULL").isEmpty():
        last = rounds[-1]
        beyond = last.select(F.col("node").alias("jump"), F.col("jump").alias("next"), F.col("lost").alias("later"))
        moved = last.filter("jump IS NOT NULL").join(beyond, "jump").select("node", F.col("next").alias("jump"), F.col("later").alias("lost"))
        rounds.append(cut_lineage(moved.unionByName(last.filter("jump IS NULL"))))
        span *= 2
    return rounds, rounds[-1].select("node", (F.col("lost") | F.col("jump").isNotNull()).alias("broken"))


def ancestor_rows(nodes: DataFrame, node: str = "id", parent: str = "parent_id") -> DataFrame:
    """All (node, anc, dist) rows, dist 0 = the node itself, plus a ``broken`` flag
    per node whose chain reaches an unknown id or a cycle; of the latter only the
    rows of dist 0 are given."""
    rounds, flags = _jumps(nodes, node, parent)
    endless = rounds[-1].filter("jump IS NOT NULL").select("node")
    parts = [rounds[0].select("node", F.col("node").alias("anc"), F.lit(0).alias("dist"))]
    for k, jumps in enumerate(rounds[:-1]):
        live = jumps.filter("jump IS NOT NULL").join(endless, "node", "left_anti").select(F.col("node").alias("from"), "jump")
        so_far = reduce(DataFrame.unionByName, parts)
        parts.append(cut_lineage(live.join(so_far, live.jump == so_far.node).select(
            F.col("from").alias("node"), "anc", (F.col("dist") + (1 << k)).alias("dist"))))
    return reduce(DataFrame.unionByName, parts).join(flags, "node")


def ancestor_paths(nodes: DataFrame, node: str = "id", parent: str = "parent_id") -> DataFrame:
    """G-1: root-first path of ids ending with the node; empty when the chain
    hits an unknown id or a cycle. One row per node."""
    rows = ancestor_rows(nodes, node, parent)
    return rows.groupBy("node").agg(
        F.when(F.max("broken"), F.array().cast("array<string>")).otherwise(
            F.transform(F.array_sort(F.collect_list(F.struct((-F.col("dist")).alias("k"), F.col("anc").cast("string").alias("a")))),
                        lambda s: s["a"])).alias("path"),
        F.max("dist").alias("depth"),
    )


def reachable(seeds: DataFrame, edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """G-3 / D-5: every node reachable from the seeds (seeds included), with
    the first round it was reached in. Visited nodes never re-enter. Both joins of a
    round are merge joins: as broadcasts they would send every round's frontier through
    the driver, which adds up with the rounds."""
    e = cut_lineage(edges.select(F.col(src).alias("__src"), F.col(dst).alias("__dst")).distinct().repartition("__src"))
    frontier = cut_lineage(seeds.select(F.col(seeds.columns[0]).alias("node")).distinct().withColumn("hop", F.lit(0)))
    parts, hop = [frontier], 0
    while True:
        visited, hop = reduce(DataFrame.unionByName, parts), hop + 1
        found = (frontier.join(e.hint("merge"), F.col("node") == e.__src).select(F.col("__dst").alias("node")).distinct()
                 .join(visited.select("node").hint("merge"), "node", "left_anti").withColumn("hop", F.lit(hop)))
        frontier = cut_lineage(found)
        if frontier.isEmpty():
            return visited
        parts = [*_merged(parts), frontier]


def descendant_counts(nodes: DataFrame, node: str = "id", parent: str = "parent_id") -> DataFrame:
    """G-13: impact size = number of distinct descendants of every node that has
    any. Nodes whose chain is broken do not count. Sums move along the jumps of
    every round, so no (node, ancestor) pairs are made."""
    rounds, flags = _jumps(nodes, node, parent)
    own = flags.select("node", F.when(F.col("broken"), 0).otherwise(1).cast("long").alias("own"))
    counts = cut_lineage(own.withColumn("c", F.col("own")))
    for jumps in rounds[:-1]:
        below = jumps.filter("jump IS NOT NULL").join(counts, "node").groupBy(F.col("jump").alias("node")).agg(F.sum("c").alias("more"))
        counts = cut_lineage(counts.join(below, "node", "left").select("node", "own", (F.col("c") + F.coalesce("more", F.lit(0))).alias("c")))
    return counts.select("node", (F.col("c") - F.col("own")).alias("descendants")).filter("descendants > 0")


def resolve_to_roots(edges: DataFrame, is_root, dst: str = "dst", src: str = "src") -> DataFrame:
    """G-2: (dst, root) pairs: every node's sources followed through
    intermediate nodes until a root (``is_root(Column) -> Column``) is reached.
    Columns of logical tables built from other logical tables (joins, renames,
    created columns) resolve to physical columns this way, one level per round;
    each round joins only the unresolved frontier with the edge table, and a pair
    met before is not followed again."""
    e = cut_lineage(edges.select(F.col(dst).alias("__dst"), F.col(src).alias("__src")).distinct().repartition("__dst"))
    found = e.select(F.col("__dst").alias("node"), F.col("__src").alias("via"))
    parts = [found]
    while True:
        seen = reduce(DataFrame.unionByName, parts)
        pending = found.filter(~is_root(F.col("via")))
        found = pending.join(e, pending.via == e.__dst).select("node", F.col("__src").alias("via")).distinct()
        found = cut_lineage(found.join(seen, ["node", "via"], "left_anti"))
        if found.isEmpty():
            return seen.filter(is_root(F.col("via"))).select(F.col("node").alias(dst), F.col("via").alias("root"))
        parts = [*_merged(parts), found]
