"""Packing by concatenate and cut (operator 8).

Pass 1 tokenises every text once and writes the ids with their running offset
inside the scan partition. Prefix sums over the partition totals turn these into
global offsets. Pass 2 cuts the ids at every multiple of the window: each piece
is a boundary record (document, start, length, sequence, offset), and only the
last sequence of the corpus is not full (it is padded by the reader).

Ids are kept as runs of at most ``RUN`` ids, so that no row grows with a text.

Defined cases: a null or empty text is one end mark; very long texts span as
many sequences as they need; repeated rows are packed each; an empty table gives
no pieces; other columns are not read. Strings of special tokens in a text are
those tokens, as in a plain call of the tokenizer.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakelens.llm.common import given_back, small_batches, table, written

WINDOW = 2048
RUN = 1 << 16
END_ID = 1
VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
CACHE = 100_000  # chunks, and words, whose ids a task remembers (some 20 MB each)
SLICE = 1 << 20  # bytes of text handled before a batch is handed on
PART = SLICE // 2  # the same of texts whose distinct chunks are looked up at once
ROWS = 500  # of an Arrow batch
LONG = 64  # longer chunks and words hardly repeat and are not remembered

# The rules by which a tokenizer lower-cases and cuts a text into words.
NORMALIZER = {"type": "Sequence", "normalizers": [
    {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]}
PRE_TOKENIZER = {"type": "Sequence", "pretokenizers": [
    {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]}
# The same on lower-cased Latin-1 text without control characters, where NFC changes nothing.
ODD = re.compile("[^\t-\r -~\xa1-\xff]").search
LETTER, DIGIT = "a-z\xaa\xb5\xba\xdf-\xf6\xf8-\xff", "0-9\xb2\xb3\xb9\xbc-\xbe"
WORD = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{LETTER}]+|[{DIGIT}]|[^\t-\r {LETTER}{DIGIT}]+| ").findall  # and the spaces between chunks
SPACE = b"\xff" * 4  # no id
SHOWN = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]  # bytes that stand for themselves
BYTE = {b: chr(b) for b in SHOWN} | {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in SHOWN)}
LATIN = {c: "".join(BYTE[b] for b in chr(c).encode()) for c in range(0x80, 0x100)}


class ChunkTokenizer:
    """Ids of texts as little-endian 32-bit binaries.

    The tokenizer drops white space and never joins text across a space, so a text's
    ids are those of its chunks between spaces, and a chunk's those of its words. Each
    distinct chunk of a part of the texts is looked up once, and each new word is given
    to the tokenizer's model. Chunks with other than Latin-1 characters, or with what
    may be a special token, go through the whole tokenizer, all of them as one line,
    and are told apart by the offsets of its ids. A task remembers frequent chunks and
    words."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        rules = [json.loads(x.__getstate__()) if x else None for x in (self.tokenizer.normalizer, self.tokenizer.pre_tokenizer)]
        self.by_words = rules == [NORMALIZER, PRE_TOKENIZER]
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.known: dict[str, bytes] = {"": b""}
        self.words: dict[str, bytes] = {" ": SPACE}

    def _by_line(self, chunks: list[str]) -> list[bytes]:
        found = self.tokenizer.encode(" ".join(chunks), add_special_tokens=False)
        ids = np.array(found.ids, "<u4")
        # Where each id ends: special tokens may take a space on either side along.
        at = np.fromiter((end - 1 for _, end in found.offsets), np.int64, len(ids))
        ends = np.cumsum(np.fromiter(map(len, chunks), np.int64, len(chunks)) + 1)  # where the next chunk begins
        return _cut(ids, np.searchsorted(at, ends, side="left"))

    def _by_word(self, chunks: list[str]) -> list[bytes]:
        line = WORD(" ".join([*chunks, ""]).lower())
        new = list(set(line).difference(self.words))
        found = [[t.id for t in self.model.tokenize(w if w.isascii() else w.translate(LATIN))] for w in new]
        ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)))
        self.words.update(zip(new, _cut(np.array(list(chain.from_iterable(found)), "<u4"), ends), strict=True))
        data = b"".join(map(self.words.__getitem__, line))
        _forget(self.words, new)
        ends = (4 * np.flatnonzero(np.frombuffer(data, "<u4") == np.frombuffer(SPACE, "<u4"))).tolist()
        return [data[a:b] for a, b in zip([0, *[end + 4 for end in ends[:-1]]], ends, strict=True)]

    def _learn(self, chunks: list[str]) -> None:
        for i in range(0, len(chunks), 1024):
            part = chunks[i:i + 1024]
            line = " ".join(part)
            if self.by_words and not ODD(line) and not any(t in line for t in self.special):
                by_word, by_line = part, []
            else:
                by_line = [c for c in part if not self.by_words or ODD(c) or any(t in c for t in self.special)]
                by_word = list(set(part).difference(by_line))
            if by_word:
                self.known.update(zip(by_word, self._by_word(by_word), strict=True))
            if by_line:
                self.known.update(zip(by_line, self._by_line(by_line), strict=True))

    def __call__(self, texts: list[str]) -> list[bytes]:
        parts = pc.split_pattern(pa.array(texts, pa.string()), " ")
        chunks = parts.values.dictionary_encode()
        each, distinct = chunks.indices.to_numpy(), chunks.dictionary.to_pylist()
        new = [c for c in distinct if c not in self.known]
        self._learn(new)
        held = [self.known[c] for c in distinct]
        sizes = np.fromiter(map(len, held), np.int64, len(held)) // 4
        begins, ids = np.cumsum(sizes) - sizes, np.frombuffer(b"".join(held), "<u4")
        sizes = sizes[each]
        ends = np.cumsum(sizes)
        ids = ids[np.repeat(begins[each] - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)]
        _forget(self.known, new)
        return _cut(ids, np.concatenate([np.zeros(1, np.int64), ends])[parts.offsets.to_numpy()[1:]])


def _cut(ids: np.ndarray, ends: np.ndarray) -> list[bytes]:
    data = ids.tobytes()
    return [data[4 * a:4 * b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)] if len(ends) else []


def _forget(known: dict[str, bytes], new: list[str]) -> None:
    """Frequent keys came first; what is new beyond ``CACHE`` goes, and what is long."""
    full = len(known) > CACHE
    for key in new:
        if full or len(key) > LONG:
            del known[key]


def slices(texts: pa.Array, most: int = SLICE) -> Iterator[tuple[int, list[str]]]:
    """(begin, texts) of consecutive parts of a column of about ``most`` bytes, so
    that Python objects exist for one part at a time."""
    ends = np.cumsum(pc.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False))
    begin = 0
    while begin < len(ends):
        held = ends[begin - 1] if begin else 0
        stop = max(begin + 1, int(np.searchsorted(ends, held + most, side="right")))
        yield begin, texts.slice(begin, stop - begin).to_pylist()
        begin = stop


def tokenised(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """(doc_id, part, at, start, n, doc_tokens, ids): runs of a document's ids;
    ``at`` is the run's place among the ids of its scan partition."""
    schema = "doc_id long, part int, at long, start long, n long, doc_tokens long, ids binary"
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    @given_back
    def tokenise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        encode, part, at = ChunkTokenizer(vocabulary), TaskContext.get().partitionId(), 0
        end = np.array([END_ID], "<u4").tobytes()
        for batch in batches:
            for begin, texts in slices(batch.column(1), PART):
                out, ids = [], batch.column(0).slice(begin, len(texts)).to_pylist()
                for doc, data in zip(ids, encode(texts), strict=True):
                    data += end
                    total = len(data) // 4
                    for start in range(0, total, RUN):
                        n = min(RUN, total - start)
                        out.append((doc, part, at, start, n, total, data[4 * start:4 * (start + n)]))
                        at += n
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.int64(), pa.int32(), *[pa.int64()] * 4, pa.binary()), strict=True)],
                    names=["doc_id", "part", "at", "start", "n", "doc_tokens", "ids"])

    return rows.mapInArrow(tokenise, schema)


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
         vocabulary: str = VOCABULARY) -> DataFrame:
    """(doc_id, start, length, ids, doc_tokens, sequence_id, offset) per piece;
    ``ids`` are little-endian unsigned 32-bit."""
    with small_batches(docs.sparkSession, ROWS):
        runs = written(tokenised(docs, id_col, text_col, vocabulary), "token-runs")
    totals = runs.groupBy("part").agg(F.sum("n").alias("n"))  # a row per scan partition
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    placed = runs.join(F.broadcast(bases), "part").withColumn("begin", F.col("base") + F.col("at"))
    first, last = F.floor(F.col("begin") / window), F.floor((F.col("begin") + F.col("n") - 1) / window)
    cut = placed.select("*", F.explode(F.sequence(first, last)).alias("sequence_id"))
    low = F.greatest("begin", F.col("sequence_id") * window)
    high = F.least(F.col("begin") + F.col("n"), (F.col("sequence_id") + 1) * window)
    inside = (low - F.col("begin")).cast("int")
    return cut.select(
        "doc_id", (F.col("start") + inside).alias("start"), (high - low).alias("length"),
        F.substr("ids", inside * 4 + 1, ((high - low) * 4).cast("int")).alias("ids"), "doc_tokens", "sequence_id",
        (low - F.col("sequence_id") * window).alias("offset"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = pack(table(spark, sf_dir, "documents"))
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
