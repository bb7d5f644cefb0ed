"""Substring dedup by difference-cover anchors (operator 13).

A window is ``window`` consecutive words of one document. A word goes if a window
over it also starts in a document with a smaller id.

1. *Anchors.* Anchors are shorter windows that start only at positions p with
   ``p mod period`` in a difference cover: for any two residues some shift puts both
   into the cover. Two equal windows, wherever they start, thus hold an equal anchor
   at the same shift in both. The anchor length is ``window - period + 1``, so that
   it fits at every shift. Of 7 positions 3 are hashed. Only anchors that documents
   with different ids have lead on.
2. *Extension.* Every window over such an anchor is hashed whole (96 bits from 128
   bits a word), and of each group of equal windows all but those of its smallest
   id count. No pairs are made: a group is one sorted run.
3. *Cut.* The starts of counted windows go back to their document, and the words
   under them go.

Passages that very many rows hold are spotted in a sample (one row in ``SAMPLE``, at
most ``HOT`` hashes; a hint only, any other choice gives the same rows). Hot anchors
lead on without being counted. Hot windows are dealt to several tasks by a salt;
of each task's rows those of its smallest id meet once more.

Defined cases: a null or empty text has no words; rows without an id neither give
nor lose words; rows with one id do not take from each other, whether their texts
are equal or not, and each row gets a row; texts are never cut, windows do not cross
rows; an empty table gives no rows; other columns are not read unless ``keep`` asks
for the row as ``record``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakelens.llm.common import settled, small_batches, table
from lakelens.llm.packing import slices

WINDOW = 13
SAMPLE = 64
HOT = 1 << 16
SALT_ROWS = 20_000  # rows of a hot window that share a task
# Perfect difference sets by period.
COVERS = {1: (0,), 3: (0, 1), 7: (0, 1, 3), 13: (0, 1, 3, 9), 31: (1, 5, 11, 24, 25, 27)}
EMPTY = np.zeros(0, np.int64)


def cover_of(window: int) -> tuple[int, tuple[int, ...]]:
    """(period, cover) with anchors of at least half a window."""
    return max((p, c) for p, c in COVERS.items() if 2 * p <= window + 1)


class Words:
    """The words of some texts, as one run of hashes."""

    def __init__(self, texts: list[str]):
        self.words = [t.encode().split() for t in texts]  # bytes split at space and 09-0D alone
        self.lengths = np.array([len(w) for w in self.words], np.int64)
        self.bases = np.cumsum(self.lengths) - self.lengths
        digests = b"".join(xxhash.xxh3_128_digest(w) for ws in self.words for w in ws)
        self.hashes = np.frombuffer(digests, "<u8").reshape(-1, 2)
        self.doc = np.repeat(np.arange(len(texts)), self.lengths)
        self.at = np.arange(len(self.doc)) - np.repeat(self.bases, self.lengths)

    def starts(self, size: int) -> np.ndarray:
        """Where ``size`` words of one text begin, as a mask."""
        return self.at + size <= np.repeat(self.lengths, self.lengths)

    def hashed(self, starts: np.ndarray, size: int, half: int) -> np.ndarray:
        """64-bit hashes of the ``size`` words from each of ``starts`` (positions)."""
        words, value = self.hashes[:, half], np.full(len(starts), 0x51AFD7ED558CCD + half, np.uint64)
        for i in range(size):
            value = (value ^ words[starts + i]) * np.uint64(0x9E3779B97F4A7C15)
            value ^= value >> np.uint64(32)
        return value.view(np.int64)

    def anchors(self, window: int) -> tuple[np.ndarray, int]:
        period, cover = cover_of(window)
        size = window - period + 1
        return np.flatnonzero(self.starts(size) & np.isin(self.at % period, cover)), size


def _held(sorted_values: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(found, place) of ``wanted`` in ``sorted_values``."""
    if not len(sorted_values):
        return np.zeros(len(wanted), bool), np.zeros(len(wanted), np.int64)
    place = np.minimum(np.searchsorted(sorted_values, wanted), len(sorted_values) - 1)
    return sorted_values[place] == wanted, place


def _rows(names: list[str], *columns: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)


def frequent(rows: DataFrame, window: int) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """The hint: by kind (0 anchors, 1 windows) sorted hashes and the rows that each
    is expected to have."""

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, texts in slices(batch.column("text")):
                found = Words(texts)
                for kind, (starts, size) in enumerate((found.anchors(window), (np.flatnonzero(found.starts(window)), window))):
                    values, counts = np.unique(found.hashed(starts, size, 0), return_counts=True)
                    yield _rows(["kind", "h", "n"], np.full(len(values), kind, np.int32), values, counts.astype(np.int64))

    sample = rows.filter(F.pmod(F.xxhash64("doc_id", F.lit(SAMPLE)), F.lit(SAMPLE)) == 0)
    counted = sample.mapInArrow(hashes, "kind int, h long, n long").groupBy("kind", "h").agg(F.sum("n").alias("n"))
    most = counted.filter("n >= 4").orderBy(F.desc("n"), "kind", "h").limit(HOT).collect()
    out = {}
    for kind in (0, 1):
        own = np.array(sorted((r.h, SAMPLE * r.n) for r in most if r.kind == kind), np.int64).reshape(-1, 2)
        out[kind] = (own[:, 0].copy(), own[:, 1].copy())
    return out


def anchor_rows(rows: DataFrame, window: int, hot: np.ndarray) -> DataFrame:
    """(h, doc_id, mark, at) of all anchors that are not hot."""

    def anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, marks = (batch.column(n).to_numpy() for n in ("doc_id", "mark"))
            for begin, texts in slices(batch.column("text")):
                found = Words(texts)
                starts, size = found.anchors(window)
                h = found.hashed(starts, size, 0)
                starts, h = (x[~_held(hot, h)[0]] for x in (starts, h))
                doc = begin + found.doc[starts]
                yield _rows(["h", "doc_id", "mark", "at"], h, ids[doc], marks[doc], found.at[starts].astype(np.int32))

    return rows.select("doc_id", "mark", "text").mapInArrow(anchors, "h long, doc_id long, mark long, at int")


def window_rows(rows: DataFrame, window: int, hot_anchors: np.ndarray, hot: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """(h, g, doc_id, mark, at, salts, salt) of the windows over leading anchors;
    ``rows`` carry theirs in ``anchors``."""
    values, expected = hot
    period = cover_of(window)[0]

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, marks, lists = batch.column("doc_id").to_numpy(), batch.column("mark").to_numpy(), batch.column("anchors")
            for begin, texts in slices(batch.column("text")):
                found = Words(texts)
                own = lists.slice(begin, len(texts))
                n = np.diff(own.offsets.to_numpy()) if len(own) else EMPTY
                sizes = np.where(own.is_valid().to_numpy(zero_copy_only=False), n, 0)
                led = np.repeat(found.bases, sizes) + own.flatten().to_numpy()
                starts, size = found.anchors(window)
                led = np.concatenate([led, starts[_held(hot_anchors, found.hashed(starts, size, 0))[0]]])
                # A window may start up to period - 1 words before an anchor, in the same text.
                doc, first = found.doc[led], found.bases[found.doc[led]]
                step = np.zeros(len(found.doc) + 1, np.int64)
                np.add.at(step, np.maximum(first, led - period + 1), 1)
                np.add.at(step, led + 1, -1)
                starts = np.flatnonzero((np.cumsum(step[:-1]) > 0) & found.starts(window))
                h, g = found.hashed(starts, window, 0), found.hashed(starts, window, 1).astype(np.int32)
                is_hot, place = _held(values, h)
                salts = np.ones(len(h), np.int32)
                salts[is_hot] = 1 + expected[place[is_hot]] // SALT_ROWS
                doc = begin + found.doc[starts]
                at = found.at[starts].astype(np.int32)
                salt = ((marks[doc] ^ at).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(40)).astype(np.int64) % salts
                yield _rows(["h", "g", "doc_id", "mark", "at", "salts", "salt"], h, g, ids[doc], marks[doc], at, salts, salt.astype(np.int32))

    return rows.mapInArrow(windows, "h long, g int, doc_id long, mark long, at int, salts int, salt int")


def _later(rows: DataFrame, *key: str) -> DataFrame:
    """``rows`` with ``later``: whether a smaller id has the same key."""
    return rows.withColumn("later", F.col("doc_id") > F.min("doc_id").over(Window.partitionBy(*key)))


def repeated_starts(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, mark, starts): where the windows start that a smaller id has too.
    ``docs`` has doc_id, text and mark, a hash that tells the texts of one id apart."""
    spark = docs.sparkSession
    rows = docs.filter("doc_id IS NOT NULL")
    with small_batches(spark):
        hot = frequent(rows, window)
        same = Window.partitionBy("h")
        anchors = anchor_rows(rows, window, hot[0][0])
        shared = anchors.select("*", F.min("doc_id").over(same).alias("lo"), F.max("doc_id").over(same).alias("hi")).filter("lo < hi")
        led = settled(shared.groupBy("doc_id", "mark").agg(F.collect_set("at").alias("anchors")), "shared-anchors")
        met = rows.join(led, ["doc_id", "mark"], "left").select("doc_id", "mark", "text", "anchors")
        found = _later(window_rows(met, window, hot[0][0], hot[1]), "h", "g", "salt").filter("later OR salts > 1")
        found = settled(found.select("doc_id", "mark", "at", "later", *[F.when(~F.col("later"), F.col(c)).alias(c) for c in ("h", "g")]),
                        "repeated-windows")
    split = _later(found.filter("NOT later").drop("later"), "h", "g")
    starts = found.filter("later").unionByName(split.filter("later")).groupBy("doc_id", "mark").agg(F.collect_set("at").alias("starts"))
    return settled(starts, "repeated-starts")


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, keep: bool = False) -> DataFrame:
    """(doc_id, n_words, n_removed, kept, removed array<(start, end)>) for every row of
    ``docs``: the kept words joined by a space, and the removed runs of words (end
    exclusive). ``keep`` adds the row as ``record``."""
    extra = [F.struct("*").alias("record")] if keep else []
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("mark"), *extra)
    starts = repeated_starts(rows.select("doc_id", "text", "mark"), window)
    met = rows.join(starts, ["doc_id", "mark"], "left").select("doc_id", "text", "starts", *(["record"] if keep else []))
    run = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, texts in slices(batch.column("text")):
                same = batch.slice(begin, len(texts))
                total, gone, kept, runs = [], [], [], []
                for text, at in zip(texts, same.column("starts"), strict=True):
                    words = text.encode().split()
                    step = np.zeros(len(words) + 1, np.int64)
                    if at.is_valid:
                        own = at.values.to_numpy()
                        step[own] += 1
                        step[own + window] -= 1
                    out = np.cumsum(step) > 0
                    edges = np.flatnonzero(np.diff(out, prepend=False, append=False)).reshape(-1, 2)
                    total.append(len(words))
                    gone.append(int(out.sum()))
                    kept.append(b" ".join([words[i] for i in np.flatnonzero(~out[:-1])] if len(edges) else words).decode())
                    runs.append([(int(a), int(b)) for a, b in edges])
                columns = {"doc_id": same.column("doc_id"), "n_words": pa.array(total, pa.int64()), "n_removed": pa.array(gone, pa.int64()),
                           "kept": pa.array(kept, pa.string()), "removed": pa.array(runs, run)}
                yield pa.RecordBatch.from_pydict(columns | ({"record": same.column("record")} if keep else {}))

    schema = met.select("doc_id", F.lit(0).cast("long").alias("n_words"), F.lit(0).cast("long").alias("n_removed"), F.lit("").alias("kept"),
                        F.array().cast("array<struct<start:int,end:int>>").alias("removed"), *(["record"] if keep else [])).schema
    return met.mapInArrow(cut, schema)


def op13_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring_dedup(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


OP13_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
w AS (SELECT doc_id, unnest([{i: i, g: array_to_string(ws[i:i + 12], ' ')} FOR i IN range(1, len(ws) - 11)], recursive := true) FROM d),
f AS (SELECT g, min(doc_id) AS least FROM w GROUP BY g),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS k FROM w JOIN f USING (g) WHERE least < doc_id),
each AS (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS k FROM d),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY k) AS kept, count(*) AS n FROM each ANTI JOIN gone USING (doc_id, k) GROUP BY doc_id)
SELECT doc_id, len(ws) AS n_words, len(ws) - coalesce(n, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""
