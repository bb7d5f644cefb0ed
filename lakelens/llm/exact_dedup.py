"""Exact dedup by deterministic block naming (operator 9, native).

Every normalised text is cut into blocks of ``block`` characters. The distinct
blocks are sorted and named by integers; adjacent names are paired and the
distinct pairs named again, until one name is left per document. Two texts have
the same (level, name) exactly when they are equal: no digest decides anything.

Defined cases: a null text counts as empty; an empty text is one empty block;
of rows equal in text the largest ``doc_id`` stays (null is smallest; among
repeated rows with that id one, the first scanned); an empty table gives an
empty result; other columns of the input are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakelens.llm.common import ascii_lower, table, written

BLOCK = 1024
#: Sorted runs that names are drawn from: a name is (run, rank in the run).
RUN_BITS = 20
LIST_ROWS, LIST_PLACES = 12, 1  # bits: lists of up to 4096 neighbouring rows and 2 places in a text


def _names(df: DataFrame, keys: list[str]) -> Column:
    """An integer for each distinct key: its rank in the sorted run it hashes to."""
    run = F.pmod(F.xxhash64(*keys), F.lit(1 << RUN_BITS))
    rank = F.dense_rank().over(Window.partitionBy(run).orderBy(*keys))
    return F.shiftleft(run, 40) + rank


def identities(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK) -> DataFrame:
    """(rid, doc_id, text_sha256, level, name) for every row of ``docs``."""
    text = ascii_lower(F.coalesce(F.col(text_col), F.lit("")))
    base = docs.select(F.monotonically_increasing_id().alias("rid"), F.col(id_col).alias("doc_id"), text.alias("t"))
    cut = base.select(
        "rid", "doc_id", F.sha2("t", 256).alias("sha"),
        F.greatest(F.lit(1), F.ceil(F.char_length("t") / block)).cast("int").alias("nb"),
        F.posexplode_outer(F.regexp_extract_all("t", F.lit("(?s).{1,%d}" % block), F.lit(0))).alias("pos", "block"))
    pos = F.coalesce("pos", F.lit(0))
    rows = cut.select(
        F.coalesce("block", F.lit("")).alias("block"),
        F.struct("rid", pos.alias("pos"), "nb", F.when(pos == 0, F.col("doc_id")).alias("doc_id"),
                 F.when(pos == 0, F.col("sha")).alias("sha")).alias("m"))
    # Copies among some 4096 neighbouring rows travel as one row, so a block that a
    # third of all rows holds meets in one task that much less often; a list has at
    # most LIST members.
    seat = F.struct(F.shiftright(F.col("m.rid"), LIST_ROWS), F.shiftright(F.col("m.pos"), LIST_PLACES))
    local = rows.groupBy("block", seat.alias("seat")).agg(F.collect_list("m").alias("members"))
    named = local.select("members", _names(local, ["block"]).alias("name"))
    first = written(named.select(F.explode("members").alias("m"), "name").select("m.*", "name"), "block-names")

    heads = first.filter("pos = 0").select("rid", "doc_id", F.col("sha").alias("text_sha256"), "nb", "name")
    done = heads.filter("nb = 1").select("rid", "doc_id", "text_sha256", F.lit(0).alias("level"), "name")
    longest = first.agg(F.max("nb")).first()[0] or 1
    left, level, finished = first.filter("nb > 1").select("rid", "pos", "nb", "name"), 0, None
    while longest > 1:
        level, longest = level + 1, (longest + 1) // 2
        pairs = left.groupBy("rid", F.shiftright("pos", 1).alias("pos"), F.shiftright(F.col("nb") + 1, 1).alias("nb")).agg(
            F.max(F.when(F.col("pos") % 2 == 0, F.col("name"))).alias("a"),
            F.coalesce(F.max(F.when(F.col("pos") % 2 == 1, F.col("name"))), F.lit(-1)).alias("b"))
        distinct = pairs.select("a", "b").distinct()
        names = distinct.select("a", "b", _names(distinct, ["a", "b"]).alias("name"))
        level_rows = written(pairs.join(names, ["a", "b"]).select("rid", "pos", "nb", "name"), f"pair-names-{level}")
        ended = level_rows.filter("nb = 1").select("rid", F.lit(level).alias("level"), "name")
        finished = ended if finished is None else finished.unionAll(ended)
        left = level_rows.filter("nb > 1")
    if finished is None:
        return done
    return done.unionAll(heads.filter("nb > 1").drop("nb", "name").join(finished, "rid")
                         .select("rid", "doc_id", "text_sha256", "level", "name"))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256."""
    rows = written(identities(docs, id_col, text_col, block), "identities")
    groups = written(
        rows.groupBy("level", "name").agg(F.max(F.struct("doc_id", (-F.col("rid")).alias("r"))).alias("k"), F.count("*").alias("n"))
        .filter("n > 1").select("level", "name", F.col("k.doc_id").alias("keep"), (-F.col("k.r")).alias("keep_rid"), "n"), "copies")
    joined = rows.join(groups, ["level", "name"], "left")
    single = F.col("n").isNull()
    return joined.select(
        "doc_id", F.when(single, F.col("doc_id")).otherwise(F.col("keep")).alias("keep_id"),
        F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
        (single | (F.col("rid") == F.col("keep_rid"))).alias("kept"), "text_sha256")


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


OP9_SQL = """
WITH t AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS nt FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, sha256(nt) AS text_sha256
FROM t WINDOW w AS (PARTITION BY nt)
"""
