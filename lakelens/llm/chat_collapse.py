"""Chat formatting by cumulative-snapshot collapse (operator 1, native).

A chat service logs a conversation again after every turn, so many logged
conversations are prefixes of longer ones. Each turn is hashed together with
its ordinal; the running XOR of these hashes (two 64-bit lanes) is the hash of
the turn prefix. A conversation whose whole hash is a proper prefix of another
one is dropped by an anti-join; of identical conversations the smallest
``conv_id`` stays. The rest is rendered as ChatML.

A conversation is never gathered whole: ordinals and running hashes are windows
over (conversation, span of ``SPAN`` turn numbers) with span offsets from a
small table, and the rendering returns parts of at most ``SPAN`` turns.

Defined cases: a null role or text is empty; a null turn sorts last; turns with
equal numbers are ordered by role and text; an exactly repeated row counts once;
rows without a ``conv_id`` belong to no conversation; ChatML markers inside a
text or role become a space; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakelens.llm.common import table, written

SPAN = 256
MARKER = r"<\|im_(start|end)\|>"


def ordered_turns(turns: DataFrame) -> DataFrame:
    """(conv_id, span, k, n_turns, role, text): turn ``k`` of ``n_turns``, from 1."""
    rows = turns.filter(F.col("conv_id").isNotNull()).select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")).distinct()
    rows = rows.withColumn("span", F.coalesce(F.floor(F.col("turn") / SPAN), F.lit((1 << 62))))
    counts = rows.groupBy("conv_id", "span").agg(F.count("*").alias("c"))
    whole = Window.partitionBy("conv_id")
    before = whole.orderBy("span").rowsBetween(Window.unboundedPreceding, -1)
    spans = counts.select("conv_id", "span", F.coalesce(F.sum("c").over(before), F.lit(0)).alias("before"),
                          F.sum("c").over(whole).alias("n_turns"))
    inside = Window.partitionBy("conv_id", "span").orderBy(F.col("turn").asc_nulls_last(), "role", "text")
    return rows.withColumn("rn", F.row_number().over(inside)).join(spans, ["conv_id", "span"]).select(
        "conv_id", "span", (F.col("before") + F.col("rn")).alias("k"), "n_turns", "role", "text")


def prefix_hashes(turns: DataFrame) -> DataFrame:
    """(conv_id, k, n_turns, h1, h2): hash of the first ``k`` turns."""
    lanes = turns.select("conv_id", "span", "k", "n_turns", F.xxhash64(F.lit(17), "k", "role", "text").alias("a"),
                         F.xxhash64("text", F.lit(91), "role", "k").alias("b"))
    inside = Window.partitionBy("conv_id", "span").orderBy("k").rowsBetween(Window.unboundedPreceding, 0)
    run = lanes.select("conv_id", "span", "k", "n_turns", F.bit_xor("a").over(inside).alias("a"), F.bit_xor("b").over(inside).alias("b"))
    totals = lanes.groupBy("conv_id", "span").agg(F.bit_xor("a").alias("ta"), F.bit_xor("b").alias("tb"))
    earlier = Window.partitionBy("conv_id").orderBy("span").rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select("conv_id", "span", F.coalesce(F.bit_xor("ta").over(earlier), F.lit(0)).alias("ca"),
                            F.coalesce(F.bit_xor("tb").over(earlier), F.lit(0)).alias("cb"))
    return run.join(carried, ["conv_id", "span"]).select(
        "conv_id", "k", "n_turns", F.col("a").bitwiseXOR(F.col("ca")).alias("h1"), F.col("b").bitwiseXOR(F.col("cb")).alias("h2"))


def maximal_conversations(hashes: DataFrame) -> DataFrame:
    """conv_id of the conversations that no longer or equal one stands for."""
    key = ["k", "h1", "h2"]
    whole = hashes.filter("k = n_turns").groupBy(*key).agg(F.min("conv_id").alias("conv_id"))
    proper = hashes.filter("k < n_turns").select(*key).distinct()
    return whole.join(proper, key, "left_anti").select("conv_id")


def chat_documents(turns: DataFrame) -> DataFrame:
    """(conv_id, part, n_turns, text): the rendered maximal conversations, in
    parts of at most ``SPAN`` turns."""
    ordered = written(ordered_turns(turns), "chat-turns")
    kept = maximal_conversations(written(prefix_hashes(ordered), "chat-prefixes"))
    clean = lambda c: F.regexp_replace(c, MARKER, " ")
    shown = ordered.join(kept, "conv_id", "left_semi").select(
        "conv_id", "n_turns", F.floor((F.col("k") - 1) / SPAN).cast("int").alias("part"), "k",
        F.concat(F.lit("<|im_start|>"), clean("role"), F.lit("\n"), clean("text"), F.lit("<|im_end|>\n")).alias("turn"))
    parts = shown.groupBy("conv_id", "part", "n_turns").agg(F.sort_array(F.collect_list(F.struct("k", "turn"))).alias("turns"))
    return parts.select("conv_id", "part", "n_turns", F.array_join("turns.turn", "").alias("text"))


def op1_chat_collapse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_documents(table(spark, sf_dir, "conversations"))


OP1_SQL = r"""
WITH t AS (SELECT DISTINCT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, count(*) AS n, list({'r': role, 't': text} ORDER BY turn NULLS LAST, role, text) AS l FROM t GROUP BY conv_id),
m AS (SELECT * FROM c a WHERE NOT EXISTS (SELECT 1 FROM c b WHERE b.l[1] = a.l[1] AND b.conv_id <> a.conv_id
        AND ((b.n > a.n AND b.l[1:a.n] = a.l) OR (b.n = a.n AND b.conv_id < a.conv_id AND b.l = a.l)))),
x AS (SELECT conv_id, n, unnest(l) AS e, unnest(range(1, n + 1)) AS k FROM m)
SELECT conv_id, ((k - 1) // 256)::INT AS part, n AS n_turns,
  string_agg('<|im_start|>' || regexp_replace(e.r, '<\|im_(start|end)\|>', ' ', 'g') || chr(10)
             || regexp_replace(e.t, '<\|im_(start|end)\|>', ' ', 'g') || '<|im_end|>' || chr(10), '' ORDER BY k) AS text
FROM x GROUP BY conv_id, n, (k - 1) // 256
"""
