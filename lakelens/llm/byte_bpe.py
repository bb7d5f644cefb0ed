"""Byte-level BPE encoding and decoding (operator 2).

Distinct pieces of a batch are bucketed by length into padded numpy matrices of
token ids. Each round every row merges its leftmost pair of minimum rank; pair
ranks come from an open-addressing hash table held in numpy arrays, only the
pairs beside a merge are looked up again, the row is closed up, and finished
rows leave the matrix. Pieces longer than the widest matrix merge in the same
order by a heap over a linked list.

Defined cases: a null or empty text has no ids and decodes to empty bytes; any
text round-trips; long texts and long pieces are handled whole; repeated rows
each get a row; other columns are not read.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakelens.llm.common import table
from lakelens.llm.packing import slices

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
NONE = np.int32(2**31 - 1)
WIDEST = 256
CACHE = 300_000  # chunks whose ids a task remembers


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class PairTable:
    """(left id, right id) -> id of their join, by hashing with linear probing."""

    def __init__(self, ranks: dict[bytes, int]):
        found = [(ranks[t[:i]], ranks[t[i:]], r) for t, r in ranks.items() for i in range(1, len(t)) if t[:i] in ranks and t[i:] in ranks]
        pairs = np.array(found, np.int64).reshape(-1, 3)
        self.bits = max(4, int(2 * len(pairs)).bit_length())
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.vals = np.full(1 << self.bits, NONE, np.int32)
        keys, vals = (pairs[:, 0] << 32) | pairs[:, 1], pairs[:, 2].astype(np.int32)
        at, self.probes = self._slot(keys), 0
        while len(keys):
            self.probes += 1
            free = self.keys[at] == -1
            self.keys[at[free]] = keys[free]  # of rows on one free slot the last wins
            placed = self.keys[at] == keys
            self.vals[at[placed]] = vals[placed]
            keys, vals, at = keys[~placed], vals[~placed], (at[~placed] + 1) & (len(self.keys) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def __call__(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs; NONE where there is no such token or a side is padding."""
        keys = (left.astype(np.int64) << 32) | right
        keys[(left < 0) | (right < 0)] = -2
        at, out = self._slot(keys), np.full(keys.shape, NONE, np.int32)
        for _ in range(self.probes):
            hit = self.keys[at] == keys
            out[hit] = self.vals[at[hit]]
            at = (at + 1) & (len(self.keys) - 1)
        return out


class ByteBpe:
    def __init__(self, ranks: dict[bytes, int]):
        self.ranks, self.pairs = ranks, PairTable(ranks)
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], np.int32)

    def merge_matrix(self, pieces: list[bytes], width: int) -> list[np.ndarray]:
        """Ids of pieces of at most ``width`` bytes."""
        lengths = np.array([len(p) for p in pieces])
        ids = np.full((len(pieces), width), -1, np.int32)
        ids[np.arange(width) < lengths[:, None]] = self.byte_ids[np.frombuffer(b"".join(pieces), np.uint8)]
        rank = np.full((len(pieces), width), NONE, np.int32)  # rank[:, j]: of the pair j, j + 1
        rank[:, :-1] = self.pairs(ids[:, :-1], ids[:, 1:])
        rows, done, columns = np.arange(len(pieces)), [None] * len(pieces), np.arange(width)
        while len(rows):
            at = rank.argmin(axis=1)  # the first of equal minima
            each = np.arange(len(rows))
            best = rank[each, at]
            ended = best == NONE
            for i in np.flatnonzero(ended):
                done[rows[i]] = ids[i, :lengths[i]].copy()
            going = ~ended
            rows, ids, rank, lengths, at, best = rows[going], ids[going], rank[going], lengths[going], at[going], best[going]
            if not len(rows):
                break
            each = np.arange(len(rows))
            ids[each, at] = best
            after = columns[None, :] > at[:, None]
            closed = np.concatenate([ids[:, 1:], np.full((len(rows), 1), -1, np.int32)], axis=1)
            ids = np.where(after, closed, ids)
            closed = np.concatenate([rank[:, 1:], np.full((len(rows), 1), NONE, np.int32)], axis=1)
            rank = np.where(after, closed, rank)
            lengths = lengths - 1
            right = np.minimum(at + 1, width - 1)
            rank[each, at] = np.where(at + 1 < width, self.pairs(ids[each, at], ids[each, right]), NONE)
            left = np.maximum(at - 1, 0)
            rank[each, left] = np.where(at > 0, self.pairs(ids[each, left], ids[each, at]), rank[each, left])
            most = int(lengths.max())
            if most <= width // 2:  # rows have shrunk
                width = most
                ids, rank, columns = ids[:, :width], rank[:, :width], columns[:width]
        return done

    def merge_long(self, piece: bytes) -> np.ndarray:
        """The same merges, in the same order, for one long piece."""
        n = len(piece)
        ids = self.byte_ids[np.frombuffer(piece, np.uint8)]
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        first = self.pairs(ids[:-1], ids[1:])
        ids = ids.tolist()
        heap = [(int(first[i]), i, ids[i], ids[i + 1]) for i in np.flatnonzero(first != NONE).tolist()]
        heapq.heapify(heap)
        token = {r: t for t, r in self.ranks.items()} if heap else {}

        def push(i: int) -> None:
            j = after[i]
            if j < n and (r := self.ranks.get(token[ids[i]] + token[ids[j]])) is not None:
                heapq.heappush(heap, (r, i, ids[i], ids[j]))

        while heap:
            r, i, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j >= n or ids[j] != b:
                continue  # one of the two has been merged since
            ids[i], ids[j], after[i] = r, -1, after[j]
            if after[i] < n:
                before[after[i]] = i
            push(i)
            if before[i] >= 0:
                push(before[i])
        return np.array([x for x in ids if x >= 0], np.int32)

    def encode(self, pieces: list[bytes]) -> list[np.ndarray]:
        """Ids of each piece."""
        buckets: dict[int, list[int]] = {}
        for i, piece in enumerate(pieces):
            width = max(2, 1 << (len(piece) - 1).bit_length())
            buckets.setdefault(width if width <= WIDEST else 0, []).append(i)
        out = [None] * len(pieces)
        for width, members in buckets.items():
            for begin in range(0, len(members), 1 << 14):
                some = members[begin:begin + (1 << 14)]
                group = [pieces[i] for i in some]
                for i, ids in zip(some, self.merge_matrix(group, width) if width else map(self.merge_long, group), strict=True):
                    out[i] = ids
        return out


class TextEncoder:
    """Ids of texts. A chunk between single spaces that begins and ends with a
    visible character is split alike in any text, so its ids are remembered."""

    def __init__(self, path: str, pattern: str):
        import regex

        self.bpe, self.split = ByteBpe(read_ranks(path)), regex.compile(pattern).findall
        self.known: dict[str, bytes | None] = {}
        self.pieces: dict[str, bytes] = {}

    def _learn(self, strings: list[str]) -> list[bytes]:
        """Ids of strings, each split on its own."""
        split = [self.split(s) for s in strings]
        new = list(set().union(*split).difference(self.pieces))
        self.pieces.update(zip(new, (ids.tobytes() for ids in self.bpe.encode([p.encode() for p in new])), strict=True))
        out = [b"".join(map(self.pieces.__getitem__, s)) for s in split]
        if len(self.pieces) > CACHE:
            self.pieces = {}
        return out

    def __call__(self, texts: list[str]) -> list[bytes]:
        chunks = [[s if i == 0 else " " + s for i, s in enumerate(t.split(" "))] for t in texts]
        if len(self.known) > CACHE:
            self.known = {}
        new = list(set().union(*chunks).difference(self.known))
        plain = [c for c in new if (s := c.removeprefix(" ")) and not s[0].isspace() and not s[-1].isspace()]
        self.known.update(dict.fromkeys(new))
        for begin in range(0, len(plain), 1 << 14):
            some = plain[begin:begin + (1 << 14)]
            self.known.update(zip(some, self._learn(some), strict=True))
        out: list[bytes | None] = []
        for parts in chunks:
            ids = list(map(self.known.__getitem__, parts))
            out.append(None if None in ids else b"".join(ids))
        odd = [i for i, ids in enumerate(out) if ids is None]
        for i in odd:
            out[i] = self._learn([texts[i]])[0]
        for c in new:
            if len(c) > 64:
                del self.known[c]
        return out


def bpe_encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ranks: str = RANKS,
               pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """(doc_id, ids array<int>) for every row of ``docs``."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = TextEncoder(ranks, pattern)
        for batch in batches:
            for begin, texts in slices(batch.column(1)):
                found = encoder(texts)
                offsets = np.zeros(len(found) + 1, np.int32)
                np.cumsum([len(x) // 4 for x in found], out=offsets[1:])
                values = pa.array(np.frombuffer(b"".join(found), "<i4"))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(begin, len(texts)), pa.ListArray.from_arrays(pa.array(offsets), values)],
                                                 names=["doc_id", "ids"])

    return rows.mapInArrow(encode, "doc_id long, ids array<int>")


def bpe_decode(encoded: DataFrame, ranks: str = RANKS) -> DataFrame:
    """(doc_id, ids, decoded binary); unknown ids are an error, null ids decode to nothing."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token = {r: t for t, r in read_ranks(ranks).items()}
        for batch in batches:
            for begin in range(0, batch.num_rows, 256):
                part = batch.slice(begin, 256)
                ids = part.column(1)
                values, offsets = ids.values.to_numpy(), ids.offsets.to_numpy()
                texts = [b"".join(map(token.__getitem__, values[a:b].tolist())) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([part.column(0), ids, pa.array(texts, pa.binary())], names=["doc_id", "ids", "decoded"])

    return encoded.select("doc_id", F.coalesce("ids", F.array().cast("array<int>")).alias("ids")).mapInArrow(decode, "doc_id long, ids array<int>, decoded binary")


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    decoded = bpe_decode(bpe_encode(table(spark, sf_dir, "documents")))
    return decoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                          F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
                          F.sha2("decoded", 256).alias("decoded_sha256"))
