"""Hard-negative mining by threshold joins over partial indexes (operator 11).

The search is an all-pairs threshold join in the manner of L2AP. Rows lie in parts,
anchors in blocks, and a task joins one block with one part:

* *Index.* Dimensions are ordered by energy and taken in steps. A row is posted
  under a step only while its suffix norm times the anchors' could still reach the
  lowest threshold; the dimensions beyond are omitted from the index.
* *Accumulation.* Partial scores add up step by step over the postings. After each
  step a pair goes if its partial score plus the product of the remaining norms
  stays below the anchor's threshold. What is left is verified in integers.
* *Thresholds.* An anchor first asks for scores above a value that a bounded sample
  of ``SAMPLE`` rows lets expect to suffice. Windows that are not full then
  lower theirs: to a value that the sample proves to suffice, or to the window's end.

Positives are found first (same label, by the sample's k-th best, a true lower
bound), then negatives for all positives of an anchor at once. Of each part an
anchor gets at most as many rows as its window holds.

Bounds in floating point only decide what to skip and carry a slack.

Defined cases: rows with a null label, id or vector, or with a null or non-finite
component, take no part; missing components of shorter vectors are 0; of several
rows with an anchor's id the smallest (label, vector) is the anchor, and none of
them answers it; equal scores rank by the smaller id, repeated rows rank each; a
negative positive score has an empty window; an anchor without positives or without
negatives in a window gives no rows; components whose scores could leave 2^55 are
an error; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakelens.llm.common import settled, table
from lakelens.llm.vectors import extent, matrix, require_range, scaled, usable

PART = 4096
BLOCK = 1024
STEP = 8
SAMPLE = 4096
NONE = -(1 << 62)  # the threshold of those who take every score
SLACK = 1e-9


def _suffix_norms(rows: np.ndarray, edges: list[int]) -> np.ndarray:
    """Norms of the components from each edge on (rows x edges)."""
    squares = np.cumsum(rows[:, ::-1] ** 2, axis=1)[:, ::-1]
    return np.sqrt(np.concatenate([squares, np.zeros((len(rows), 1))], axis=1)[:, edges])


def threshold_join(rows: np.ndarray, anchors: np.ndarray, least: np.ndarray, allowed: np.ndarray,
                   step: int = STEP) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(anchor, row, score) of the ``allowed`` pairs with a score of ``least[anchor]`` or
    more, and how many multiplications of a row's component the partial scores took."""
    order = np.argsort(-(rows.astype(float) ** 2).sum(axis=0), kind="stable")
    held, asked = rows[:, order].astype(float), anchors[:, order].astype(float)
    width = rows.shape[1]
    edges = [*range(0, width, step), width]
    of_row, of_anchor = _suffix_norms(held, edges), _suffix_norms(asked, edges)
    floor = least.astype(float)
    floor -= SLACK * (1 + np.abs(floor) + of_anchor[:, 0] * of_row[:, 0].max(initial=0))
    # A row is posted under a step while some anchor could reach its threshold from there on.
    with np.errstate(divide="ignore", invalid="ignore"):
        need = np.where(floor[:, None] <= 0, 0.0, np.where(of_anchor > 0, floor[:, None] / of_anchor, np.inf)).min(axis=0, initial=np.inf)
    alive = allowed & (of_anchor[:, :1] * of_row[:, 0] >= floor[:, None])
    partial, work = np.zeros(alive.shape), 0
    for s, (low, high) in enumerate(zip(edges, edges[1:])):
        q = np.flatnonzero(alive.any(axis=1))
        r = np.flatnonzero(alive[q].any(axis=0) & (of_row[:, s] >= need[s]))
        if not len(q) or not len(r):
            break
        at = np.ix_(q, r)
        partial[at] += asked[q, low:high] @ held[r, low:high].T
        work += len(q) * len(r) * (high - low)
        alive[at] &= partial[at] + of_anchor[q, s + 1][:, None] * of_row[r, s + 1] >= floor[q][:, None]
    i, j = np.nonzero(alive)
    scores = np.concatenate([np.zeros(0, np.int64), *[(anchors[i[k:k + 65536]] * rows[j[k:k + 65536]]).sum(axis=1) for k in range(0, len(i), 65536)]])
    true = scores >= least[i]
    return i[true], j[true], scores[true], work


def _first(anchor: np.ndarray, score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` best of each anchor: higher scores, then smaller ids."""
    order = np.lexsort((ids, -score, anchor))
    own = anchor[order]
    begin = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]])) if len(own) else own
    rank = np.arange(len(own)) - np.repeat(begin, np.diff(np.append(begin, len(own))))
    return order[rank < k]


def _answers(anchor: np.ndarray, slot: np.ndarray, ids: np.ndarray, score: np.ndarray) -> pa.Table:
    return pa.table({"anchor_id": pa.array(anchor, pa.int64()), "slot": pa.array(slot, pa.int32()),
                     "vec_id": pa.array(ids, pa.int64()), "score": pa.array(score, pa.int64())})


ANSWERS = "anchor_id long, slot int, vec_id long, score long"


def _meet(vectors: DataFrame, asks: DataFrame, search, part: int, block: int, rows: int) -> DataFrame:
    """``search(rows, anchors)`` for each pair of a part of ``vectors`` and a block of ``asks``."""
    parts, blocks = max(1, -(-rows // part)), max(1, -(-asks.count() // block))
    some = lambda seed, n, *by: F.pmod(F.xxhash64(F.lit(seed), *by), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = vectors.select("*", some(1, parts, "vec_id", "v").alias("part"), every(blocks).alias("block"))
    right = asks.select("*", every(parts).alias("part"), some(2, blocks, "anchor_id").alias("block"))
    return left.groupBy("part", "block").cogroup(right.groupBy("part", "block")).applyInArrow(search, ANSWERS)


def _ranked(answers: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("anchor_id", "slot").orderBy(F.desc("score"), "vec_id")
    return answers.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def positives_of(vectors: DataFrame, anchors: DataFrame, sample: tuple, width: int, rows: int, k: int, part: int, block: int) -> DataFrame:
    """(anchor_id, slot, positive_id, positive_score): the ``k`` best rows of an anchor's
    label, slots from 1."""
    shipped = vectors.sparkSession.sparkContext.broadcast(sample)  # at most SAMPLE rows

    def least(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, labels, held = shipped.value
        for batch in batches:
            mine, label, v = batch.column("anchor_id").to_numpy(), batch.column("label").to_numpy(), matrix(batch.column("v"), width)
            bound = np.full(len(mine), NONE)
            for q in range(len(mine)):
                scores = held[(labels == label[q]) & (ids != mine[q])] @ v[q]
                if len(scores) >= k:
                    bound[q] = np.partition(scores, -k)[-k]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(bound)], names=[*batch.schema.names, "least"])

    def search(held: pa.Table, asked: pa.Table) -> pa.Table:
        ids, mine = held.column("vec_id").to_numpy(), asked.column("anchor_id").to_numpy()
        allowed = (asked.column("label").to_numpy()[:, None] == held.column("label").to_numpy()) & (mine[:, None] != ids)
        i, j, scores, _ = threshold_join(matrix(held.column("v"), width), matrix(asked.column("v"), width), asked.column("least").to_numpy(), allowed)
        best = _first(i, scores, ids[j], k)
        return _answers(mine[i[best]], np.zeros(len(best), np.int32), ids[j[best]], scores[best])

    asks = settled(anchors.mapInArrow(least, "anchor_id long, label long, v array<long>, least long"), "anchor-thresholds")
    found = _ranked(_meet(vectors, asks, search, part, block, rows), k)
    return found.select("anchor_id", F.col("rank").alias("slot"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))


def negatives_of(vectors: DataFrame, windows: DataFrame, sample: tuple, width: int, rows: int, k: int, part: int, block: int) -> DataFrame:
    """(anchor_id, slot, vec_id, score, rank): the ``k`` best rows of other labels in
    each window; ``windows`` has anchor_id, label, v, slots, lows and highs."""
    spark = vectors.sparkSession
    shipped = spark.sparkContext.broadcast(sample)
    share = len(sample[0]) / max(1, rows)

    def starts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """For each window its thresholds, falling to the window's end."""
        ids, labels, held = shipped.value
        for batch in batches:
            mine, label, v = batch.column("anchor_id").to_numpy(), batch.column("label").to_numpy(), matrix(batch.column("v"), width)
            out = []
            for q, (lows, highs) in enumerate(zip(batch.column("lows").to_pylist(), batch.column("highs").to_pylist(), strict=True)):
                scores = np.sort(held[(labels != label[q]) & (ids != mine[q])] @ v[q])[::-1]
                falls = []
                for low, high in zip(lows, highs, strict=True):
                    inside = scores[(scores >= low) & (scores <= high)]
                    likely = int(2 * k * share) + 1
                    falls.append([int(inside[n - 1]) if len(inside) >= n else low for n in (likely, max(likely, k))] + [low])
                out.append(falls)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.list_(pa.list_(pa.int64())))], names=[*batch.schema.names, "falls"])

    def search(held: pa.Table, asked: pa.Table) -> pa.Table:
        ids, mine = held.column("vec_id").to_numpy(), asked.column("anchor_id").to_numpy()
        least, highs, slots = (asked.column(n).to_pylist() for n in ("leasts", "highs", "slots"))
        allowed = (asked.column("label").to_numpy()[:, None] != held.column("label").to_numpy()) & (mine[:, None] != ids)
        lowest = np.array([min(t) for t in least], np.int64)
        i, j, scores, _ = threshold_join(matrix(held.column("v"), width), matrix(asked.column("v"), width), lowest, allowed)
        out = [(np.zeros(0, np.int64),) * 4]
        ends = np.searchsorted(i, np.arange(len(mine) + 1))
        for q in range(len(mine)):
            own = slice(ends[q], ends[q + 1])
            for slot, low, high in zip(slots[q], least[q], highs[q], strict=True):
                inside = np.flatnonzero((scores[own] >= low) & (scores[own] <= high)) + ends[q]
                best = inside[_first(i[inside], scores[inside], ids[j[inside]], k)]
                out.append((np.full(len(best), mine[q]), np.full(len(best), slot), ids[j[best]], scores[best]))
        return _answers(*(np.concatenate(c) for c in zip(*out, strict=True)))

    open_ = settled(windows.mapInArrow(starts, windows.select("*", F.array().cast("array<array<bigint>>").alias("falls")).schema), "negative-windows")
    done = []
    for turn in range(3):
        asks = open_.withColumn("leasts", F.transform("falls", lambda f: F.get(f, F.lit(turn)))).drop("falls")
        found = settled(_ranked(_meet(vectors, asks, search, part, block, rows), k), "negatives")
        each = open_.select("anchor_id", F.explode(F.arrays_zip("slots", "lows", "highs", "falls")).alias("w")).select("anchor_id", F.col("w.slots").alias("slot"), "w")
        counts = found.groupBy("anchor_id", "slot").agg(F.count("*").alias("n"))
        state = each.join(counts, ["anchor_id", "slot"], "left").withColumn(
            "full", (F.coalesce("n", F.lit(0)) >= k) | (F.get("w.falls", F.lit(turn)) <= F.col("w.lows")))
        state = settled(state, "window-states")
        done.append(found.join(state.filter("full").select("anchor_id", "slot"), ["anchor_id", "slot"], "left_semi"))
        short = state.filter("NOT full")
        if short.isEmpty():
            break
        again = short.groupBy("anchor_id").agg(F.collect_list("w").alias("w"))  # at most one per positive
        open_ = open_.select("anchor_id", "label", "v").join(again, "anchor_id").select(
            "anchor_id", "label", "v", *[F.col(f"w.{n}").alias(n) for n in ("slots", "lows", "highs", "falls")])
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def hard_negatives(rows: DataFrame, anchors: DataFrame, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90,
                   part: int = PART, block: int = BLOCK, sample: int = SAMPLE) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score): for
    each of ``anchors`` and each of its best rows of the same label the best rows of other
    labels with ``low`` to ``high`` percent of the positive's score. Both tables have
    vec_id, label and v, an array of longs."""
    rows = rows.select(*(F.col(c).cast("long").alias(c) for c in ("vec_id", "label")), "v")
    size = extent(rows)
    require_range(size, 1 << 55)
    width = max(1, size.width)
    taken = rows.orderBy(F.xxhash64(F.lit(3), "vec_id", "v"), "vec_id", "label").limit(sample).toArrow()
    known = (taken.column("vec_id").to_numpy(), taken.column("label").to_numpy(), matrix(taken.column("v"), width))
    asks = anchors.groupBy(F.col("vec_id").cast("long").alias("anchor_id")).agg(F.min(F.struct(F.col("label").cast("long").alias("label"), "v")).alias("own"))
    asks = settled(asks.select("anchor_id", "own.label", "own.v"), "anchors")
    best = settled(positives_of(rows, asks, known, width, size.rows, positives, part, block), "positives")
    windows = best.filter("positive_score >= 0").groupBy("anchor_id").agg(F.collect_list(F.struct(
        "slot", F.expr(f"({low} * positive_score + 99) div 100").alias("low"), F.expr(f"{high} * positive_score div 100").alias("high"))).alias("w"))
    windows = asks.join(windows, "anchor_id").select(
        "anchor_id", "label", "v", *[F.col(f"w.{n}").alias(f"{n}s") for n in ("slot", "low", "high")])
    found = negatives_of(rows, windows, known, width, size.rows, negatives, part, block)
    return found.join(best, ["anchor_id", "slot"]).select(
        "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").filter(usable("embedding") & F.col("label").isNotNull() & F.col("vec_id").isNotNull())
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = settled(rows.select("vec_id", label.alias("label"), scaled("embedding", 256).alias("v")), "integer-vectors")
    return hard_negatives(vectors, vectors.filter("vec_id % 100 = 0"))


OP11_SQL = """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  [floor(256 * x::DOUBLE)::BIGINT FOR x IN embedding] AS v FROM embeddings
           WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, list_inner_product(a.v::DOUBLE[], c.v::DOUBLE[])::BIGINT AS score
      FROM v a JOIN v c ON a.vec_id <> c.vec_id WHERE a.vec_id % 100 = 0),
p AS (SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS slot FROM s WHERE same),
n AS (SELECT p.anchor_id, p.vec_id AS positive_id, s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score,
             row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY s.score DESC, s.vec_id)::INT AS rank
      FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT s.same AND 30 * p.score <= 100 * s.score AND 100 * s.score <= 90 * p.score
      WHERE p.slot <= 5)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 10
"""
