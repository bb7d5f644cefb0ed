"""N-gram Jaccard join in the metric space of shingle sets (operator 6).

Two documents link when 100 * |x & y| >= percent * |x | y| over their distinct
word shingles. Jaccard distance is a metric, and the join divides its space:

1. *First pivots, regions and windows.* Documents as pivots cannot divide a corpus
   whose documents are nearly all at distance 1, so the first pivots are the
   singleton sets {s}. Under one global order a set's nearest pivot is its first
   shingle. A neighbour within the radius differs in at most
   ``n - ceil(percent * n)`` of its shingles, so a set is replicated to the
   regions of its first ``n - ceil(percent * n) + 1`` pivots; then two linked sets
   always share a region. Shingles that many documents share come last in the
   order (a hint only: any order gives the same links), so that a common passage
   attracts no one. Before the first shingle that two sets share, all differ; so
   their shingles from there on must suffice for a link, or the pair is left to an
   earlier region. Of regions with the same sets the first in the order stays.
2. *Pivot documents inside regions.* Each region compares its members with one of
   its documents. Links merge into components (the ball around the pivot), and
   members of a region that are in one component need no further comparison. Large
   regions go on with new pivots as long as that merges.
3. *Recursion in the metric of parities.* A set's sketch holds the parity of its size
   in each of some hundred buckets. The Hamming distance of sketches is a metric and
   never more than the symmetric difference of the sets, which linked sets bound
   by ``(n + m) * (1 - t) / (1 + t)``. What is left of a region is cut into annuli, first
   around the empty set (by size), then, while it stays large, around pivots (by
   sketch distance): an annulus is at least as wide as the triangle inequality
   allows links to reach, so a set joins its own annulus and visits the next one. The
   annulus is part of the join key. Pairs whose sketches are near enough are compared.
Nothing is left out: the join is exact.

Sets are kept as 64-bit shingle hashes (two shingles of one compared pair collide
with a probability below 1e-12); equal sets are found by 128 bits, and a clash of
the shorter key is detected and answered by another seed.

Defined cases: null and empty texts have an empty set and link with nothing;
texts of fewer than ``width`` words are one shingle; equal sets are one component;
a null id is never the smallest; repeated rows each get a row; an empty table
gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakelens.llm.common import given_back, released, settled, small_batches, table
from lakelens.llm.components import components
from lakelens.llm.packing import slices

WIDTH = 5
PERCENT = 75
BLOCK = 1 << 21  # shingles counted at once inside a task
SHARED = 32  # a shingle seen this often within blocks comes late in the order
LATE = 1 << 20  # shingles that the order hint holds at most (8 MB)
BITS = 25  # size of the bit map that selects documents by id (4 MB)
REGION = 256  # larger open regions choose new pivots, then divide by sketch distance
LONGS = 16  # 64-bit words of the sketch that region rows carry, and least ones of a set's own
MOST_LONGS = 512  # a set's own sketch has about a bit per shingle, up to this
SHRINK = 0.75  # a division that leaves a cell larger than this share of it is its last
CACHE = 200_000
EVEN = np.uint64(0x9E3779B97F4A7C15)


class _Words(dict):
    def __init__(self, seed: int):
        super().__init__()
        self.seed = seed

    def __missing__(self, word: bytes) -> int:
        self[word] = value = xxhash.xxh3_64_intdigest(word, self.seed)
        return value


class Shingler:
    """Sorted distinct 64-bit shingle hashes of texts."""

    def __init__(self, seed: int, width: int = WIDTH):
        self.seed, self.width, self.words = seed, width, _Words(seed)

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        # On bytes, lower() folds A-Z only and split() cuts at \x09-\x0D and space.
        words = [t.encode().lower().split() for t in texts]
        if len(self.words) > CACHE:
            self.words = _Words(self.seed)
        lengths = np.array([len(w) for w in words])
        flat = np.fromiter(map(self.words.__getitem__, chain.from_iterable(words)), np.uint64, int(lengths.sum()))
        k = self.width
        rolled = flat[:max(0, len(flat) - k + 1)].copy()
        for j in range(1, k):
            rolled = rolled * EVEN + flat[j:j + len(rolled)]
        for shift, factor in ((33, 0xFF51AFD7ED558CCD), (33, 0xC4CEB9FE1A85EC53)):
            rolled = (rolled ^ (rolled >> np.uint64(shift))) * np.uint64(factor)
        rolled = (rolled ^ (rolled >> np.uint64(33))).view(np.int64)
        out = []
        for n, begin, w in zip(lengths, np.cumsum(lengths) - lengths, words, strict=True):
            if n >= k:
                out.append(np.unique(rolled[begin:begin + n - k + 1]))
            elif n:
                out.append(np.array([xxhash.xxh3_64_intdigest(b" ".join(w), self.seed + int(n))], np.uint64).view(np.int64))
            else:
                out.append(np.zeros(0, np.int64))
        return out


def digest(shingles: np.ndarray) -> tuple[int, int]:
    value = xxhash.xxh3_128_intdigest(shingles.tobytes())
    return tuple(np.array([value & (2**64 - 1), value >> 64], np.uint64).view(np.int64).tolist())


def prefix_length(n: int, percent: int) -> int:
    return n - (percent * n + 99) // 100 + 1


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[str]]]:
    for batch in batches:
        for begin, texts in slices(batch.column(1)):
            yield batch.column(0).slice(begin, len(texts)).to_pylist(), texts


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    offsets = np.zeros(len(arrays) + 1, np.int32)
    np.cumsum([len(a) for a in arrays], out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([*arrays, np.zeros(0, np.int64)])))


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def profile(texts: DataFrame, seed: int, width: int) -> DataFrame:
    """Rows of documents (doc_id, n, h1, h2) and, apart from them, shingles that
    several sets of one block share (shingle, c)."""
    types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32())
    names = ["doc_id", "n", "h1", "h2", "shingle", "c"]

    def batch(columns) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

    def shared(block: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        values, counts = np.unique(np.concatenate([*block, np.zeros(0, np.int64)]), return_counts=True)
        values, counts = values[counts > 1], counts[counts > 1]
        for i in range(0, len(values), 1 << 17):
            v = values[i:i + (1 << 17)]
            none = [None] * len(v)
            yield batch([none, none, none, none, v, counts[i:i + (1 << 17)]])

    @given_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, block, held, seen = Shingler(seed, width), [], 0, set()
        for ids, part in _batches(batches):
            sets = shingler(part)
            keys = [digest(s) for s in sets]
            none = [None] * len(ids)
            yield batch([ids, [len(s) for s in sets], [k[0] if len(s) else None for k, s in zip(keys, sets, strict=True)],
                         [k[1] if len(s) else None for k, s in zip(keys, sets, strict=True)], none, none])
            for key, s in zip(keys, sets, strict=True):
                if key not in seen:
                    seen.add(key)
                    block.append(s)
                    held += len(s)
            if held >= BLOCK:
                yield from shared(block)
                block, held, seen = [], 0, set()
        yield from shared(block)

    return texts.mapInArrow(run, "doc_id long, n int, h1 long, h2 long, shingle long, c int")


def sketch(shingles: np.ndarray) -> np.ndarray:
    """Parities of a set's size in 64 * L buckets, L a power of two near a bit per shingle."""
    longs = min(MOST_LONGS, max(LONGS, 1 << (int(len(shingles) - 1) // 64).bit_length()))
    odd = np.bincount(shingles & (64 * longs - 1), minlength=64 * longs) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64)


def replicated(texts: DataFrame, late: np.ndarray, seed: int, width: int, percent: int) -> DataFrame:
    """(h1, n, early, late, parity): the regions of each set, late ones apart, and its
    sketch."""
    shipped = texts.sparkSession.sparkContext.broadcast(late)

    @given_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, late = Shingler(seed, width), shipped.value
        for _, part in _batches(batches):
            rows, seen = ([], [], [], [], []), set()
            for s in shingler(part):
                if not len(s) or (key := digest(s)[0]) in seen:
                    continue
                seen.add(key)
                at = np.minimum(np.searchsorted(late, s), max(0, len(late) - 1))
                is_late = late[at] == s if len(late) else np.zeros(len(s), bool)
                p = prefix_length(len(s), percent)
                first = s[~is_late][:p]
                last = s[is_late][:p - len(first)]
                for column, value in zip(rows, (key, len(s), first, last, sketch(s)), strict=True):
                    column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(rows[0], pa.int64()), pa.array(rows[1], pa.int32()), *map(_lists, rows[2:])],
                                             names=["h1", "n", "early", "late", "parity"])

    return texts.mapInArrow(run, "h1 long, n int, early array<long>, late array<long>, parity array<long>")


def shingle_sets(texts: DataFrame, ids: np.ndarray, seed: int, width: int) -> DataFrame:
    """(h1, s) of the documents whose id's bit is set in ``ids`` (or null)."""
    shipped = texts.sparkSession.sparkContext.broadcast(ids)

    @given_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, bits = Shingler(seed, width), shipped.value

        def wanted() -> Iterator[pa.RecordBatch]:
            for batch in batches:
                d = batch.column(0).fill_null(0).to_numpy(zero_copy_only=False)
                hit = (bits[(d >> 6) & (len(bits) - 1)] >> (d & 63).astype(np.uint64)) & np.uint64(1)
                yield batch.filter(pa.array((hit == 1) | batch.column(0).is_null().to_numpy(zero_copy_only=False)))

        for _, part in _batches(wanted()):
            sets = {digest(s)[0]: s for s in shingler(part) if len(s)}
            yield pa.RecordBatch.from_arrays([pa.array(list(sets), pa.int64()), _lists(list(sets.values()))], names=["h1", "s"])

    return texts.mapInArrow(run, "h1 long, s array<long>")


def id_bits(ids: DataFrame, bits: int = BITS) -> np.ndarray:
    """A bit map of fixed size over ids modulo 2 ** bits; ``ids`` has doc_id."""
    word = F.shiftright("doc_id", 6).bitwiseAND(F.lit((1 << (bits - 6)) - 1))
    bit = F.expr("shiftleft(1L, cast(doc_id & 63 AS int))")
    rows = ids.filter("doc_id IS NOT NULL").groupBy(word.alias("w")).agg(F.bit_or(bit).alias("m")).toPandas()
    out = np.zeros(1 << (bits - 6), np.int64)
    out[rows["w"].to_numpy(np.int64)] = rows["m"].to_numpy(np.int64)
    return out.view(np.uint64)


def _near_size(a: Column, b: Column, percent: int) -> Column:
    return F.least(a, b) * 100 >= F.greatest(a, b) * percent


def _apart(na: Column, nb: Column, percent: int) -> Column:
    """The largest symmetric difference of linked sets of these sizes."""
    return F.floor((na + nb) * (100 - percent) / (100 + percent) + 1e-6)


def _enough(left_a: Column, left_b: Column, na: Column, nb: Column, percent: int) -> Column:
    """Whether sets of these sizes can link that share no shingle before the last ``left``
    ones of each."""
    return F.least(left_a, left_b).cast("long") * (100 + percent) >= (na.cast("long") + nb) * percent


def _parity_distance(a: Column, b: Column) -> Column:
    """Hamming distance of two sketches; the longer one is folded once (sizes of pairs
    in question differ by less than a factor of two)."""
    half = lambda x: F.floor(F.size(x) / 2).cast("int")
    fold = lambda x: F.zip_with(F.slice(x, 1, half(x)), F.slice(x, half(x) + 1, half(x)), lambda p, q: p.bitwiseXOR(q))
    left = F.when(F.size(a) > F.size(b), fold(a)).otherwise(a)
    right = F.when(F.size(b) > F.size(a), fold(b)).otherwise(b)
    return F.aggregate(F.zip_with(left, right, lambda p, q: F.bit_count(p.bitwiseXOR(q))), F.lit(0), lambda t, x: t + x)


class Comparer:
    """Intersection sizes of pairs that may link."""

    def __init__(self, texts: DataFrame, classes: DataFrame, parities: DataFrame, seed: int, width: int, percent: int):
        self.texts, self.classes, self.parities = texts, classes, parities
        self.seed, self.width, self.percent = seed, width, percent

    def possible(self, pairs: DataFrame) -> DataFrame:
        """``pairs`` whose whole sketches are near enough."""
        side = lambda x: self.parities.select(F.col("h1").alias(x), F.col("parity").alias(f"p{x}"))
        both = pairs.join(side("a"), "a").join(side("b"), "b")
        return both.filter(_parity_distance(F.col("pa"), F.col("pb")) <= _apart(F.col("na"), F.col("nb"), self.percent)).select("a", "b", "na", "nb")

    def __call__(self, pairs: DataFrame) -> DataFrame:
        """(a, b, na, nb, both), written, for the pairs that may link."""
        pairs = settled(self.possible(pairs), "possible-pairs")
        if pairs.isEmpty():
            return pairs.withColumn("both", F.lit(0))
        members = settled(pairs.select(F.col("a").alias("h1")).unionAll(pairs.select(F.col("b").alias("h1"))).distinct(), "members")
        bits = id_bits(self.classes.join(members, "h1", "left_semi").select("doc_id"))
        sets = settled(shingle_sets(self.texts, bits, self.seed, self.width).join(members, "h1", "left_semi"), "shingle-sets")
        left = pairs.join(sets.select(F.col("h1").alias("a"), F.col("s").alias("sa")), "a")
        both = left.join(sets.select(F.col("h1").alias("b"), F.col("s").alias("sb")), "b")
        return settled(both.select("a", "b", "na", "nb", F.size(F.array_intersect("sa", "sb")).alias("both")), "overlaps")


def _linked(pairs: DataFrame, percent: int) -> DataFrame:
    return pairs.filter(F.col("both") * 100 >= (F.col("na") + F.col("nb") - F.col("both")) * percent).select("a", "b")


def _relabelled(rows: DataFrame, labels: DataFrame, name: str) -> DataFrame:
    """``rows`` (key, h1, n, left) with their component, of the regions that hold several."""
    known = rows.select("key", "h1", "n", "left").join(labels.select(F.col("node").alias("h1"), "label"), "h1", "left")
    known = known.withColumn("root", F.coalesce("label", "h1")).drop("label")
    split = known.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.count("*").alias("c"))
    return settled(known.join(split.filter("lo <> hi").select("key", "c"), "key"), name)


WORDS = [f"w{i}" for i in range(LONGS)]
# ``visits`` has a bit for each division in which the row is in the annulus next to its
# own; a pair meets in one cell where no division has both as visitors.
SLIM = ["key", "h1", "n", "left", "root", "visits"]
CELL = [*SLIM, *WORDS]


def _annuli(rows: DataFrame, ring: Column, turn: int) -> DataFrame:
    """``rows`` in the annulus ``ring`` of their cell and, as visitors, in the next one."""
    seats = F.array(F.struct(ring.alias("ring"), F.col("visits").alias("visits")),
                    F.struct((ring + 1).alias("ring"), F.col("visits").bitwiseOR(F.lit(1 << turn)).alias("visits")))
    return rows.withColumn("seat", F.explode(seats)).withColumns(
        {"key": F.xxhash64("key", F.lit(turn), "seat.ring"), "visits": F.col("seat.visits")}).drop("seat")


def _sketched(rows: DataFrame, parities: DataFrame) -> DataFrame:
    """``rows`` with the words of a sketch of fixed length (longer ones are folded)."""
    def word(i: int) -> Column:
        return F.aggregate(F.filter("parity", lambda x, at: at % LONGS == i), F.lit(0).cast("long"), lambda t, x: t.bitwiseXOR(x))

    return rows.join(parities.select("h1", *[word(i).alias(w) for i, w in enumerate(WORDS)]), "h1")


def _by_size(rows: DataFrame, percent: int) -> DataFrame:
    """Annuli around the empty set: cells of one size class, which the sets of the class
    below visit. Linked sets are at most one class apart."""
    return _annuli(rows, F.floor(F.log(F.col("n")) / float(np.log(100 / percent)) + 1e-9).cast("int"), 0).select(SLIM)


def _crowded(cells: DataFrame) -> DataFrame:
    """Cells with rows of several components that are not all visitors, with their counts."""
    counted = cells.groupBy("key").agg(F.count("*").alias("c"), F.min("root").alias("lo"), F.max("root").alias("hi"), F.bit_and("visits").alias("all"))
    return counted.filter("lo <> hi AND all = 0").select("key", "c")


def _by_pivot(cells: DataFrame, percent: int, turn: int) -> DataFrame:
    """Annuli around a pivot of each cell, as wide as links can reach."""
    pivot = cells.groupBy("key").agg(F.min_by(F.struct(*WORDS), F.xxhash64(F.lit(turn), "h1")).alias("p"), F.max("n").alias("most"))
    far = sum((F.bit_count(F.col(w).bitwiseXOR(F.col(f"p.{w}"))) for w in WORDS), F.lit(0))
    ring = F.floor(far / (_apart(F.col("most"), F.col("most"), percent) + 1)).cast("int")
    return _annuli(cells.join(pivot, "key"), ring, turn).select(cells.columns)


def _cell_pairs(cells: DataFrame, percent: int) -> DataFrame:
    """Different pairs (a, b, na, nb) of components that meet in a cell, near in size and
    sketch."""
    side = lambda x: cells.select("key", *[F.col(c).alias(f"{c}_{x}") for c in CELL[1:]])
    na, nb = F.col("n_a"), F.col("n_b")
    far = sum((F.bit_count(F.col(f"{w}_a").bitwiseXOR(F.col(f"{w}_b"))) for w in WORDS), F.lit(0))
    near = (F.col("h1_a") < F.col("h1_b")) & (F.col("root_a") != F.col("root_b")) & (F.col("visits_a").bitwiseAND(F.col("visits_b")) == 0) \
        & (F.least(na, nb) * 100 >= F.greatest(na, nb) * percent) & _enough(F.col("left_a"), F.col("left_b"), na, nb, percent) & (far <= _apart(na, nb, percent))
    right = side("b").withColumnRenamed("key", "key_b")
    return side("a").join(right, (F.col("key") == F.col("key_b")) & near).select(
        F.col("h1_a").alias("a"), F.col("h1_b").alias("b"), na.alias("na"), nb.alias("nb")).distinct()


def _rest(open_: DataFrame, parities: DataFrame, percent: int) -> DataFrame:
    """Pairs of the open regions that may link, by annuli."""
    slim = settled(_by_size(open_.select("key", "h1", "n", "left", "root").withColumn("visits", F.lit(0).cast("long")), percent), "size-cells")
    crowded = settled(_crowded(slim), "crowded-cells")
    cells = settled(_sketched(slim.join(crowded, "key"), parities).select(*CELL, "c"), "cells")
    released(slim, crowded)
    done, turn = [cells.filter(F.col("c") <= REGION).select(CELL)], 0
    large = cells.filter(F.col("c") > REGION)
    while turn < 62 and not large.isEmpty():
        turn += 1
        # Cells that one more pivot does not make smaller are left as they are.
        parted = settled(_by_pivot(large.select(*CELL, F.col("key").alias("from"), "c"), percent, turn), "parted-cells")
        worth = parted.groupBy("from", "key", "c").agg(F.count("*").alias("now")).groupBy("from").agg(F.max(F.col("now") / F.col("c")).alias("share"))
        worth = settled(worth.filter(F.col("share") <= SHRINK).select("from"), "parted-keys")
        done.append(large.select(CELL).join(worth.select(F.col("from").alias("key")), "key", "left_anti"))
        further = parted.join(worth, "from", "left_semi").select(CELL)
        cells = settled(further.join(_crowded(further), "key"), "cells")
        released(parted)
        done.append(cells.filter(F.col("c") <= REGION).select(CELL))
        large = cells.filter(F.col("c") > REGION)
    done.append(large.select(CELL))
    ready = done[0]
    for more in done[1:]:
        ready = ready.unionByName(more)
    return settled(_cell_pairs(ready, percent), "near-pairs")


def _early_regions(regions_of: DataFrame, percent: int) -> DataFrame:
    """(key, h1, n, left, p): the regions of shingles that are not late, without sets that
    have no partner there; ``left`` counts a set's shingles from the region's on."""
    rows = regions_of.select(F.posexplode("early").alias("at", "key"), "h1", "n", (F.col("n") - F.col("at")).alias("left")).drop("at")
    rows = rows.repartition("key").distinct()
    # A partner is the nearest larger set or a smaller one which ``left`` lets be the smaller.
    here = Window.partitionBy("key").orderBy("n", "h1")
    n, before = F.col("n"), here.rowsBetween(Window.unboundedPreceding, -1)
    smaller = F.last(F.when(_enough(F.col("left"), F.col("left"), n, n, percent), n), ignorenulls=True).over(before)
    beside = {"smaller": F.coalesce(smaller, F.lit(0)), "larger": F.coalesce(F.lead("n").over(here), F.lit(0))}
    rows = rows.withColumns(beside).filter(
        _near_size(n, F.col("smaller"), percent) | _near_size(n, F.col("larger"), percent) & _enough(F.col("left"), F.col("left"), n, F.col("larger"), percent))
    region = Window.partitionBy("key")
    rows = rows.select("key", "h1", "n", "left", F.min(F.struct("h1", "n")).over(region).alias("p"),
                       F.bit_xor("h1").over(region).alias("x"), F.bit_xor(F.xxhash64("h1", "n")).over(region).alias("y"))
    rows = settled(rows, "early-regions")
    first = rows.filter("h1 = p.h1 AND x <> h1").groupBy("x", "y").agg(F.min("key").alias("key"))
    return rows.join(settled(first.select("key"), "first-regions"), "key", "left_semi").drop("x", "y")


def links(texts: DataFrame, classes: DataFrame, late: np.ndarray, seed: int, width: int, percent: int) -> DataFrame:
    """(a, b): enough links between different sets (by h1) to give all components."""
    regions_of = settled(replicated(texts, late, seed, width, percent), "region-keys")
    early = _early_regions(regions_of, percent)
    # Only shared shingles can be hot: their pivots are found by a map-side sum,
    # and there are at most LATE of them.
    hot = regions_of.select(F.posexplode("late").alias("at", "key"), "h1", "n", (F.col("n") - F.size("early") - F.col("at")).alias("left"))
    pivots = hot.groupBy("key").agg(F.min(F.struct("h1", "n")).alias("p"), F.max("h1").alias("last")).filter("p.h1 <> last").drop("last")
    hot = hot.join(F.broadcast(pivots), "key").select("key", "h1", "n", "left", "p").distinct()
    regions = settled(early.unionAll(hot).select("key", "h1", "n", "left", F.col("p.h1").alias("p"), F.col("p.n").alias("np")), "regions")
    inside = regions.select("h1").distinct()
    parities = settled(regions_of.select("h1", "parity").join(inside, "h1", "left_semi").dropDuplicates(["h1"]), "parities")
    released(regions_of)
    compare = Comparer(texts, classes, parities, seed, width, percent)

    near = _near_size(F.col("n"), F.col("np"), percent)
    stars = regions.filter((F.col("h1") != F.col("p")) & near).select(F.col("h1").alias("a"), F.col("p").alias("b"), F.col("n").alias("na"), F.col("np").alias("nb"))
    tried = compare(stars.distinct())
    found = _linked(tried, percent)
    open_ = _relabelled(regions, components(found), "open-regions")
    released(regions)
    turn, progress = 0, True
    while progress and not (large := open_.filter(F.col("c") > REGION)).isEmpty():
        turn += 1
        row = F.struct("h1", "n", "root")
        new = large.groupBy("key").agg(F.array(*[F.min_by(row, F.xxhash64(F.lit(turn), F.lit(i), "h1")) for i in range(4)]).alias("p"))
        met = large.select("key", "h1", "n", "root").join(new.select("key", F.explode(F.array_distinct("p")).alias("p")), "key")
        met = met.filter((F.col("root") != F.col("p.root")) & _near_size(F.col("n"), F.col("p.n"), percent))
        more = compare(met.select(F.col("h1").alias("a"), F.col("p.h1").alias("b"), F.col("n").alias("na"), F.col("p.n").alias("nb")).distinct())
        merged = _linked(more, percent)
        progress = merged.count() * 100 > large.count()
        tried, found = tried.unionByName(more), settled(found.unionAll(merged), "links")
        open_ = _relabelled(open_, components(found), "open-regions")
    done = tried.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    rest = _rest(open_, parities, percent).join(done, ["a", "b"], "left_anti")
    return found.unionAll(_linked(compare(rest), percent))


def ngram_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH,
                     percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of ``docs``."""
    with small_batches(docs.sparkSession):
        return _components(_texts(docs, id_col, text_col), width, percent)


def _components(texts: DataFrame, width: int, percent: int) -> DataFrame:
    for seed in range(100):
        seen = settled(profile(texts, seed, width), "shingle-profile")
        rows = seen.filter("c IS NULL").select("doc_id", "n", "h1", "h2")
        classes = settled(rows.filter("n > 0").groupBy("h1").agg(F.min("doc_id").alias("doc_id"), F.min("h2").alias("lo"), F.max("h2").alias("hi")), "classes")
        if classes.filter("lo <> hi").isEmpty():
            break
    shared = seen.filter("c IS NOT NULL").groupBy("shingle").agg(F.sum("c").alias("c")).filter(F.col("c") >= SHARED)
    late = shared.orderBy(F.desc("c"), "shingle").limit(LATE).select("shingle").toPandas()["shingle"].to_numpy(np.int64)
    found = links(texts, classes, np.sort(late), seed, width, percent)
    rows = rows.join(components(found).withColumnRenamed("node", "h1"), "h1", "left")
    rows = settled(rows.select("doc_id", "n", F.coalesce("label", "h1").alias("label")), "labelled")
    groups = rows.filter("n > 0").groupBy("label").agg(F.min("doc_id").alias("least"), F.count("*").alias("c")).filter("c > 1")
    small = settled(groups.select("label", "least"), "component-ids")
    return rows.join(small, "label", "left").select(
        "doc_id", F.col("n").cast("long").alias("n_shingles"), F.coalesce("least", "doc_id").alias("component_id"))


def op6_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_components(table(spark, sf_dir, "documents"))
