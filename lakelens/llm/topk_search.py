"""Exact top-k inner products by M-tree best-first search (operator 7).

With one more component that gives all vectors the same norm, the largest inner
products are the smallest Euclidean distances, so the triangle inequality holds. All
vectors form one tree:

* *Upper page.* At most ``PIVOTS`` sampled vectors are the routing objects of parts.
  Each vector goes to the part of its nearest one; a part's covering radius is the
  largest such distance. Parts with many vectors are dealt to several tasks.
* *Lower pages.* A task builds the M-tree of its vectors: nodes with a routing object,
  a covering radius and the distances of their entries to it.
* *Search.* A query first descends in its nearest part, which gives its k-th best so
  far. It is then sent only to parts that reach into this distance, and takes its
  bound along. Inside a tree it opens the nearest leaf first; nodes and entries whose
  stored parent distances put them beyond the k-th best are passed over without
  computing theirs. The queries of a task that open one page share a matrix product.

Scores themselves are exact integers; bounds in floating point only decide what to
skip and carry a slack.

Defined cases: null vectors, vectors with a null or non-finite component and
rows without an id take no part; missing components of shorter vectors are 0; of
several rows with a query's id the smallest vector is the query, and none of them
answers it; equal scores rank by the smaller id, repeated rows rank each;
components whose scores could leave 2^53 are an error; an empty table gives no rows;
other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakelens.llm.common import settled, table
from lakelens.llm.vectors import extent, matrix, require_range, scaled, usable

PART = 8192  # vectors of a task
PIVOTS = 1024  # routing objects of the upper page at most
BLOCK = 2048  # queries of a task
PAGE = 512
SLACK = 1e-9


def lifted(vectors: np.ndarray, top: float) -> np.ndarray:
    """``vectors`` with the component that makes their squared norm ``top``."""
    floats = vectors.astype(float)
    return np.concatenate([floats, np.sqrt(np.maximum(top - (floats**2).sum(axis=1), 0))[:, None]], axis=1)


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    squares = (a**2).sum(axis=1)[:, None] + (b**2).sum(axis=1) - 2 * a @ b.T
    return np.sqrt(np.maximum(squares, 0))


class Node(NamedTuple):
    center: int  # row of the routing object
    radius: float
    rows: np.ndarray  # leaf: its entries; inner node: the centers of its children
    near: np.ndarray  # distances of those to the center
    children: list  # of an inner node
    radii: np.ndarray  # of the children


def build(points: np.ndarray, rows: np.ndarray, center: int, rng: np.random.Generator, page: int = PAGE) -> Node:
    """M-tree node over ``rows`` of ``points``, routed by ``center``."""
    far = distances(points[rows], points[center:center + 1])[:, 0]
    if len(rows) <= page:
        return Node(center, float(far.max()), rows, far, [], np.zeros(0))
    pivots = rng.choice(rows, size=min(page, -(-2 * len(rows) // page)), replace=False)
    mine = distances(points[rows], points[pivots]).argmin(axis=1)
    if len(np.unique(mine)) == 1:  # copies of one vector: any even split will do
        mine = np.arange(len(rows)) % len(pivots)
    children = [build(points, rows[mine == i], int(p), rng, page) for i, p in enumerate(pivots) if (mine == i).any()]
    centers = np.array([c.center for c in children])
    near = distances(points[centers], points[center:center + 1])[:, 0]
    return Node(center, float(far.max()), centers, near, children, np.array([c.radius for c in children]))


class MTree:
    def __init__(self, ids: np.ndarray, vectors: np.ndarray, top: float, page: int = PAGE):
        self.ids, self.vectors, self.top = ids, vectors.astype(float), top
        self.points = lifted(vectors, top)
        self.root = build(self.points, np.arange(len(ids)), 0, np.random.default_rng(len(ids)), page)

    def leaves(self, points: np.ndarray, worst: np.ndarray) -> Iterator[tuple[Node, np.ndarray, np.ndarray]]:
        """(leaf, queries that may find something there, their distances to its center);
        subtrees are left out by covering radius, first by the stored parent distance."""
        everyone = np.arange(len(points))
        stack = [(self.root, everyone, distances(points, self.points[[self.root.center]])[:, 0])]
        while stack:
            node, queries, far = stack.pop()
            if not node.children:
                yield node, queries, far
                continue
            for child, near, radius in zip(node.children, node.near, node.radii, strict=True):
                open_ = queries[np.abs(far - near) - radius <= worst[queries]]
                if len(open_):
                    d = distances(points[open_], self.points[[child.center]])[:, 0]
                    reach = d - radius <= worst[open_]
                    stack.append((child, open_[reach], d[reach]))

    def search(self, query_ids: np.ndarray, queries: np.ndarray, k: int, least: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
        """(query, row, score) with every row that may be among a query's ``k`` best others
        and scores ``least`` of it or more, and how many entries were scored."""
        asked, n = queries.astype(float), len(queries)
        points = np.concatenate([asked, np.zeros((n, 1))], axis=1)
        fixed = (asked**2).sum(axis=1) + self.top
        best = np.full((n, k), -np.inf)
        if least is not None:
            best[:] = least[:, None]  # k others with at least this score are known
        bound = lambda q: np.sqrt(np.maximum(fixed[q] - 2 * best[q].min(axis=1), 0) + SLACK * (1 + fixed[q])) + 1e-9
        everyone = np.arange(n)
        with np.errstate(invalid="ignore"):
            worst = np.where(np.isinf(best.min(axis=1)), np.inf, bound(everyone))
        pages, lows, fars = [], [], []
        for leaf, own, far in self.leaves(points, worst):
            low, all_far = np.full(n, np.inf), np.full(n, np.inf)
            low[own], all_far[own] = np.maximum(far - leaf.radius, 0), far
            pages.append(leaf)
            lows.append(low)
            fars.append(all_far)
        if not pages:
            return (*[np.zeros(0, np.int64)] * 3, 0)
        low, far = np.stack(lows, axis=1), np.stack(fars, axis=1)
        turn = np.argsort(low, axis=1, kind="stable")
        found, scored = [], 0
        for step in range(len(pages)):  # each query opens its nearest leaf that is left
            at = turn[:, step]
            open_ = np.flatnonzero(low[everyone, at] <= worst)
            if not len(open_):
                break
            for page in np.unique(at[open_]):
                q, leaf = open_[at[open_] == page], pages[page]
                possible = np.abs(far[q, page][:, None] - leaf.near) <= worst[q][:, None]
                rows = leaf.rows[possible.any(axis=0)]
                possible = possible[:, possible.any(axis=0)] & (self.ids[rows] != query_ids[q][:, None])
                scored += int(possible.sum())
                scores = np.where(possible, asked[q] @ self.vectors[rows].T, -np.inf)
                i, j = np.nonzero(scores >= best[q].min(axis=1)[:, None])
                i, j = i[np.isfinite(scores[i, j])], j[np.isfinite(scores[i, j])]
                found.append((q[i], rows[j], scores[i, j]))
                both = np.concatenate([best[q], scores], axis=1)
                best[q] = -np.partition(-both, k - 1, axis=1)[:, :k]
                full = np.isfinite(best[q].min(axis=1))
                worst[q[full]] = bound(q[full])
        q, rows, scores = (np.concatenate(c) for c in zip(*found, strict=True)) if found else [np.zeros(0)] * 3
        q, rows = q.astype(np.int64), rows.astype(np.int64)
        late = scores >= best.min(axis=1)[q]
        q, rows, scores = q[late], rows[late], scores[late].astype(np.int64)
        order = np.lexsort((self.ids[rows], -scores, q))
        q, rows, scores = q[order], rows[order], scores[order]
        rank = np.arange(len(q)) - np.searchsorted(q, q)
        return q[rank < k], rows[rank < k], scores[rank < k], scored


def _top(vectors: DataFrame) -> float:
    """The largest squared norm."""
    square = F.aggregate("v", F.lit(0).cast("long"), lambda t, x: t + x * x)
    return float(vectors.agg(F.max(square)).first()[0] or 0)


def routed(vectors: DataFrame, pivots: np.ndarray, width: int, top: float) -> DataFrame:
    """``vectors`` with their part and the distance to its routing object."""
    shipped = vectors.sparkSession.sparkContext.broadcast(lifted(pivots, top))  # at most PIVOTS vectors

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                far = distances(lifted(matrix(batch.column("v"), width), top), shipped.value)
                part = far.argmin(axis=1)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(part, pa.int32()), pa.array(far[np.arange(len(part)), part])],
                                                 names=[*batch.schema.names, "part", "far"])

    return vectors.mapInArrow(nearest, "vec_id long, v array<long>, part int, far double")


def exact_top_k(vectors: DataFrame, queries: DataFrame, k: int = 20, part: int = PART, block: int = BLOCK, pivots: int = PIVOTS) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row of ``queries`` the k highest
    inner products among ``vectors``; both have vec_id and v, an integer array."""
    spark = vectors.sparkSession
    vectors, queries = vectors.select("vec_id", "v"), queries.groupBy("vec_id").agg(F.min("v").alias("v"))
    size = extent(vectors.unionByName(queries))
    require_range(size, 1 << 53)
    width, top = max(1, size.width), _top(vectors)
    wanted = min(pivots, max(1, -(-size.rows // part)))
    sample = vectors.orderBy(F.xxhash64(F.lit(5), "vec_id", "v"), "vec_id").limit(wanted).toArrow()
    if not sample.num_rows:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    centers = matrix(sample.column("v"), width)
    held = settled(routed(vectors, centers, width, top), "routed-vectors")
    pages = {r.part: (r.far, max(1, -(-r.n // part))) for r in held.groupBy("part").agg(F.max("far").alias("far"), F.count("*").alias("n")).collect()}
    upper = (lifted(centers, top), np.array([pages.get(p, (-np.inf, 0))[0] for p in range(wanted)]), np.array([pages.get(p, (0, 0))[1] for p in range(wanted)]))
    shipped = spark.sparkContext.broadcast(upper)
    blocks = max(1, -(-queries.count() // block))

    def reached(home: bool):
        """Rows of queries with the (part, share) they are sent to: the first share of the
        nearest part, or afterwards all others within the query's bound."""
        def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            middle, radius, shares = shipped.value
            for batch in batches:
                asked = matrix(batch.column("v"), width)
                if not len(asked):
                    continue
                low = np.maximum(distances(np.concatenate([asked, np.zeros((len(asked), 1))], axis=1), middle) - radius, 0)
                low[:, shares == 0] = np.inf
                nearest = low.argmin(axis=1)
                if home:
                    at, to, share = np.arange(len(asked)), nearest, np.zeros(len(asked), np.int32)
                else:
                    least = batch.column("least").to_numpy(zero_copy_only=False).astype(float)
                    fixed = (asked.astype(float)**2).sum(axis=1) + top
                    worst = np.where(np.isnan(least), np.inf, np.sqrt(np.maximum(fixed - 2 * np.nan_to_num(least), 0) + SLACK * (1 + fixed)) + 1e-9)
                    at, to = np.nonzero((low <= worst[:, None]) & (shares > 0))
                    counts = shares[to]
                    share = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
                    at, to = np.repeat(at, counts), np.repeat(to, counts)
                    other = (to != nearest[at]) | (share > 0)
                    at, to, share = at[other], to[other], share[other]
                same = batch.take(pa.array(at))
                yield pa.RecordBatch.from_arrays([*same.columns, pa.array(to, pa.int32()), pa.array(share, pa.int32())], names=[*batch.schema.names, "part", "share"])
        return send

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        cols = [np.zeros(0, np.int64)] * 3
        if left.num_rows and right.num_rows:
            ids, asked = left.column("vec_id").to_numpy(), right.column("vec_id").to_numpy()
            tree = MTree(ids, matrix(left.column("v"), width), top)
            known = right.column("least").to_numpy().astype(float)
            q, rows, scores, _ = tree.search(asked, matrix(right.column("v"), width), k, np.where(np.isnan(known), -np.inf, known))
            cols = [asked[q], ids[rows], scores]
        return pa.table(dict(zip(("query_id", "vec_id", "score"), (pa.array(c, pa.int64()) for c in cols), strict=True)))

    def answers(asks: DataFrame) -> DataFrame:
        """Each share of a part meets the blocks of queries that were sent to it."""
        asks = settled(asks.withColumn("block", F.pmod(F.xxhash64(F.lit(2), "vec_id"), F.lit(blocks)).cast("int")), "sent-queries")
        met = asks.select(F.col("part").alias("to"), F.col("share").alias("its"), F.col("block").alias("by")).distinct()
        shares = F.element_at(F.array(*[F.lit(int(s)) for s in upper[2]]), F.col("part") + 1)
        dealt = held.withColumn("share", F.pmod(F.xxhash64(F.lit(1), "vec_id", "v"), shares).cast("int"))
        rows = dealt.join(met, (F.col("part") == F.col("to")) & (F.col("share") == F.col("its"))).select("vec_id", "v", "part", "share", F.col("by").alias("block"))
        return rows.groupBy("part", "share", "block").cogroup(asks.groupBy("part", "share", "block")).applyInArrow(search, "query_id long, vec_id long, score long")

    plain = "vec_id long, v array<long>, least long"
    first = settled(answers(queries.withColumn("least", F.lit(None).cast("long")).mapInArrow(reached(True), f"{plain}, part int, share int")), "home-answers")
    least = first.groupBy("query_id").agg(F.when(F.count("*") >= k, F.min("score")).alias("least"))
    bounded = queries.join(least, F.col("vec_id") == F.col("query_id"), "left").select("vec_id", "v", "least")
    more = answers(bounded.mapInArrow(reached(False), f"{plain}, part int, share int"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = first.unionByName(more).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def integer_vectors(embeddings: DataFrame, scale: int = 64) -> DataFrame:
    """(vec_id, v): floor(scale * x) of every usable vector."""
    rows = embeddings.filter(usable("embedding") & F.col("vec_id").isNotNull())
    return rows.select(F.col("vec_id").cast("long").alias("vec_id"), scaled("embedding", scale).alias("v"))


def op7_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = settled(integer_vectors(table(spark, sf_dir, "embeddings")), "integer-vectors")
    return exact_top_k(vectors, vectors.filter("vec_id % 20 = 0"))


OP7_SQL = """
WITH v AS (SELECT vec_id, [floor(64 * x::DOUBLE)::BIGINT FOR x IN embedding] AS v FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v::DOUBLE[], c.v::DOUBLE[])::BIGINT AS score
      FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""
