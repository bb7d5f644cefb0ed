"""Lineage operators (A-9, A-10, A-16, U-6, J-9, J-23, J-24, G-5, G-6).

Lineage is kept as long edge tables (one row per edge). Nesting sources per
target is offered, but only after ``distinct`` and never as the default for a
registered job: a hot target can have any number of sources.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakelens.functions.scalars import col_of


def table_edges(edges: DataFrame, src: str, dst: str, ts: str | None = None, start=None, end=None) -> DataFrame:
    """A-9: distinct lower-cased (source, target) pairs within [start, end)."""
    x = edges
    if ts is not None and start is not None:
        x = x.filter(F.col(ts) >= start)
    if ts is not None and end is not None:
        x = x.filter(F.col(ts) < end)
    return x.select(F.lower(src).alias("source_table"), F.lower(dst).alias("target_table")).distinct()


def column_edges(edges: DataFrame, src_t: str, src_c: str, dst_t: str, dst_c: str) -> DataFrame:
    """A-10: distinct (target table, target column, source table, source column)."""
    return edges.select(
        F.lower(dst_t).alias("target_table"), F.lower(dst_c).alias("target_column"),
        F.lower(src_t).alias("source_table"), F.lower(src_c).alias("source_column"),
    ).distinct()


def nest_sources(edges: DataFrame, target: str = "target_table", source: str = "source_table") -> DataFrame:
    """A-16: sorted set of sources per target (use on bounded fan-in only)."""
    return edges.groupBy(target).agg(F.array_sort(F.collect_set(source)).alias("sources"))


def drop_self(edges: DataFrame, src: str = "source_table", dst: str = "target_table") -> DataFrame:
    """U-6: a table is not its own upstream."""
    return edges.filter(F.col(src) != F.col(dst))


def resolve_suffix(partials: DataFrame, datasets: DataFrame, name: str = "name", key: str = "key") -> DataFrame:
    """J-9: map each partially qualified ``name`` to the only dataset ``key``
    that ends with it (raw string suffix, as in the reference: 'orders' also
    matches 'my_orders'); no match or several matches -> null.

    Exact and linear: every key is exploded into its character suffixes of
    the lengths partial names have, the suffix table is aggregated to
    (suffix, #keys, one key) with map-side partial aggregation, and the
    distinct partial names are equi-joined to it.
    """
    k = datasets.select(F.col(key).alias("__k")).distinct()
    # Only suffixes as long as some partial name can ever match: the distinct
    # name lengths (a list bounded by the longest name, not by the data).
    lengths = sorted(r[0] for r in partials.select(F.length(F.col(name))).distinct().collect() if r[0])
    if not lengths:
        return partials.withColumn("resolved", F.lit(None).cast("string"))
    lens = F.array(*[F.lit(int(n)) for n in lengths])
    suffixes = k.select("__k", F.explode(F.filter(lens, lambda n: n <= F.length("__k"))).alias("__n")) \
        .select(F.substring("__k", -F.col("__n"), F.col("__n")).alias("__suffix"), "__k")
    summary = suffixes.groupBy("__suffix").agg(F.count(F.lit(1)).alias("__n"), F.min("__k").alias("__one"))
    names = partials.select(F.col(name).alias("__suffix")).distinct()
    res = names.join(summary, "__suffix", "left").select(
        F.col("__suffix").alias("__name"), F.when(F.col("__n") == 1, F.col("__one")).alias("resolved"))
    return partials.join(res, partials[name] == res["__name"], "left").drop("__name")


def last_job_edges(jobs: DataFrame, destination: str, sources: str, ts: str, keep_self: bool = False) -> DataFrame:
    """G-6: per destination the sources of its latest job (a later job
    overwrites an earlier one), one edge per row."""
    latest = jobs.filter(F.col(destination).isNotNull()).groupBy(destination).agg(
        F.max_by(F.col(sources), F.col(ts)).alias("__src"))
    out = latest.select(F.col(destination).alias("target_table"), F.explode("__src").alias("source_table"))
    return out if keep_self else drop_self(out)


def with_virtual_source(edges: DataFrame, known: DataFrame, source: str = "source_table", key: str = "key") -> DataFrame:
    """G-5: sources not in the known datasets become virtual (is_virtual=True)."""
    k = known.select(F.col(key).alias("__known")).distinct().withColumn("__hit", F.lit(True))
    out = edges.join(k, edges[source] == k["__known"], "left")
    return out.withColumn("is_virtual", F.col("__hit").isNull()).drop("__known", "__hit")


def placeholders(upstreams: DataFrame, listed: DataFrame, key: str = "key", name: str = "source_table") -> DataFrame:
    """J-24: upstream datasets not otherwise listed get a placeholder row (anti join)."""
    return upstreams.select(F.col(name).alias(key)).distinct().join(listed.select(key), key, "left_anti")


def supported_dependencies(deps: DataFrame, domains: Sequence[str], src_domain: str, dst_domain: str) -> DataFrame:
    """J-23: keep dependency rows whose both ends are of a supported domain."""
    d = [x.upper() for x in domains]
    return deps.filter(F.upper(col_of(src_domain)).isin(d) & F.upper(col_of(dst_domain)).isin(d))


def activity_lineage(activities: DataFrame, datasets: DataFrame, block: int = 1000) -> DataFrame:
    """J-19: (pipeline, activity, source, sink) of pipeline activities. A copy activity
    reads each of its ``inputs`` into each of its ``outputs``; a data flow has its
    ``inputs`` and ``outputs`` by position. ``datasets`` has name and entity_id; names
    that it lacks give no edge. Inputs are dealt in blocks, so that an activity with
    very many ends is not joined in one task."""
    end = lambda side: activities.filter("kind = 'copy'").select(
        "pipeline", "activity", F.ceil(F.size("inputs") / block).cast("int").alias("blocks"), F.posexplode(side).alias("at", "name"))
    known = lambda rows, out: rows.join(datasets.select("name", F.col("entity_id").alias(out)), "name").drop("name")
    ins = known(end("inputs").withColumn("block", F.floor(F.col("at") / block).cast("int")), "source").drop("at", "blocks")
    outs = known(end("outputs").filter("blocks > 0"), "sink").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).drop("at", "blocks")
    copied = ins.join(outs, ["pipeline", "activity", "block"]).select("pipeline", "activity", "source", "sink")
    flows = activities.filter("kind = 'flow'").select("pipeline", "activity", F.explode(F.arrays_zip("inputs", "outputs")).alias("ends"))
    flows = flows.select("pipeline", "activity", F.col("ends.inputs").alias("from"), F.col("ends.outputs").alias("to"))
    met = flows.join(datasets.select(F.col("name").alias("from"), F.col("entity_id").alias("source")), "from").join(
        datasets.select(F.col("name").alias("to"), F.col("entity_id").alias("sink")), "to")
    return copied.unionByName(met.select("pipeline", "activity", "source", "sink")).distinct()
