"""Toxic spans by a linear-chain conditional random field (operator 5).

Labels exist per document, so training tokens are labelled first, by degrees: a
token of a toxic document is an offence with the chance that its strongest word,
stem or ending feature gives, which grows with the contexts that toxic documents
have it in beyond what clean ones let expect. Clean uses and wrong labels lower a
chance. A two-state CRF (word, stem and ending features, transitions) is fitted to
these sequences. At scoring time forward-backward gives each token's marginal; a
document's score is a logistic function of the sum of its squared marginals and of
their maximum. Tokens over one half, and a toxic document's highest, are its
offending spans.

A chain has at most ``CHAIN`` tokens: longer texts are several chains, all of
which count. The sample for the fit is bounded: ``TRAIN_ROWS`` labelled rows per
class (clean: twice), each of at most ``TRAIN_BYTES`` and all of at most
``TRAIN_TOTAL``, taken by a hash of the id from rows whose crc32(doc_id) mod 5 is not
0. The fit works on integers; its memory is some ten times ``TRAIN_TOTAL`` at most.

Defined cases: null and empty texts have no tokens and score low; a document
labelled more than once counts as toxic if one label says so; null labels and
labels without a document teach nothing; without labels of both classes every
score is 0; repeated rows each get a row; other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakelens.llm.common import given_back, table
from lakelens.llm.packing import slices

CHAIN = 512
TRAIN_ROWS = 1500
TRAIN_BYTES = 20_000
TRAIN_TOTAL = 24 << 20  # bytes of all texts of the sample
EPOCHS = 3
STEPS = 60  # updates at least; a small sample is passed over more often
DOUBT = 0.1
PRIOR = 1e-3  # odds that a feature is a sign
SLIGHT = 0.01  # chances below this are none
CACHE = 200_000
CELLS = 1 << 20  # tokens scored at once


def features(token: str) -> tuple[str, ...]:
    """Features of a token between white space; punctuation around it is ignored."""
    word = re.sub(r"^\W+|\W+$", "", token.lower())
    if not word:
        return ()
    return (f"w:{word}", *[f"p{n}:{word[:n]}" for n in (4, 5) if len(word) > n], *([f"s4:{word[-4:]}"] if len(word) > 5 else []))


class Crf(NamedTuple):
    weights: dict[str, float]
    start: float  # odds of a toxic first token
    trans: np.ndarray  # 2 x 2
    bias: float
    head: np.ndarray  # of the document score: constant, log sum, log maximum

    def emission(self, token: str) -> float:
        return self.bias + sum(self.weights.get(f, 0.0) for f in features(token))


def chains(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(begin, length) of chains in the concatenated tokens, longest first."""
    ends = np.cumsum(lengths)
    begins = np.concatenate([np.arange(e - n, e, CHAIN) for e, n in zip(ends, lengths, strict=True)] or [np.zeros(0, np.int64)]).astype(np.int64)
    stops = np.repeat(ends, -(-lengths // CHAIN))
    size = np.minimum(CHAIN, stops - begins)
    order = np.argsort(-size, kind="stable")
    return begins[order], size[order]


def _matrix(begins: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Token positions (time x chain) and how many chains are alive at each time."""
    longest = int(size[0])
    at = begins[None, :] + np.arange(longest)[:, None]
    alive = np.searchsorted(-size, -np.arange(longest), side="left")
    return at, alive


def forward_backward(potential: np.ndarray, alive: np.ndarray, start: float, trans: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Forward and backward probabilities of the toxic state (time x chain).

    ``potential`` is the toxic state's, the clean one's is 1; chains are sorted
    longest first and ``alive[t]`` of them reach time t."""
    (t00, t01), (t10, t11) = trans
    forward, backward = np.zeros_like(potential), np.full_like(potential, 0.5)
    first = start * potential[0]
    forward[0] = first / (1 + first)
    for t in range(1, len(potential)):
        n = alive[t]
        p = forward[t - 1, :n]
        one = (t01 + p * (t11 - t01)) * potential[t, :n]
        forward[t, :n] = one / (one + t00 + p * (t10 - t00))
    for t in range(len(potential) - 2, -1, -1):
        n = alive[t + 1]
        b = backward[t + 1, :n]
        one, zero = potential[t + 1, :n] * b, 1 - b
        to_one = t10 * zero + t11 * one
        backward[t, :n] = to_one / (to_one + t00 * zero + t01 * one)
    return forward, backward


def _blocks(begins: np.ndarray, size: np.ndarray, cells: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    i = 0
    while i < len(size):
        n = max(1, min(cells // int(size[i]), 4096))
        yield begins[i:i + n], size[i:i + n]
        i += n


def marginals(model: Crf, emission: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Probability of the toxic state for each of the concatenated tokens."""
    out = np.zeros(len(emission))
    potential = np.exp(np.clip(emission, -30, 30))
    for begins, size in _blocks(*chains(lengths), CELLS):
        at, alive = _matrix(begins, size)
        inside = np.arange(len(at))[:, None] < size
        at = np.where(inside, at, 0)
        f, b = forward_backward(np.where(inside, potential[at], 1.0), alive, model.start, model.trans)
        one = f * b
        out[at[inside]] = (one / (one + (1 - f) * (1 - b)))[inside]
    return out


class Sample(NamedTuple):
    """Labelled texts as integers: words by id, features by id (0: none)."""
    words: np.ndarray  # of all documents, one after the other
    lengths: np.ndarray
    toxic: np.ndarray  # of the documents
    features: np.ndarray  # word x 4
    names: list[str]  # of the features, from 1

    def documents(self) -> Iterator[tuple[int, np.ndarray]]:
        end = np.cumsum(self.lengths)
        for doc, (e, n) in enumerate(zip(end, self.lengths, strict=True)):
            yield doc, self.words[e - n:e]


def sample_of(texts: list[str], labels: list[int]) -> Sample:
    """One pass over the texts; strings are kept once per different word and feature."""
    words: dict[str, int] = {}
    docs = []
    for text in texts:
        tokens = text.split()
        docs.append(np.fromiter((words.setdefault(t, len(words)) for t in tokens), np.int32, len(tokens)))
    ids: dict[str, int] = {}
    of_word = np.zeros((len(words), 4), np.int32)
    for i, word in enumerate(words):
        for j, f in enumerate(features(word)):
            of_word[i, j] = ids.setdefault(f, len(ids) + 1)
    return Sample(np.concatenate([np.zeros(0, np.int32), *docs]), np.array([len(d) for d in docs], np.int64), np.array(labels) == 1, of_word, list(ids))


def evidence(sample: Sample) -> tuple[np.ndarray, np.ndarray]:
    """(chance, documents) of each feature, from 0. The chance that a token of a toxic
    document with it is an offence: the share of its toxic documents beyond those
    that clean ones let expect, times the chance that this is no accident (prior odds
    ``PRIOR``, normal evidence). A feature counts at most once for each different token
    before it, as words that only the near copies of one document have come after the
    same token each time."""
    size = len(sample.names) + 1
    counts = np.zeros((2, size))
    for doc, words in sample.documents():
        counts[int(sample.toxic[doc]), np.unique(sample.features[np.unique(words)])] += 1
    counts[:, 0] = 0
    good, bad = counts
    scale = sample.toxic.sum() / max(1, (~sample.toxic).sum())

    def odds(n: np.ndarray) -> np.ndarray:
        with np.errstate(invalid="ignore", divide="ignore"):
            proof = np.maximum(0.0, n - scale * good) ** 2 / (n + scale**2 * good) / 2
        return np.where(bad > 0, PRIOR * np.exp(np.minimum(50.0, np.nan_to_num(proof))), 0.0)

    # In a few texts nothing is sure, but what toxic ones share most may well be a sign.
    lift = max(1.0, 0.5 / max(1e-300, odds(bad).max(initial=0.0)) if bad.any() else 0.5)

    def chance(n: np.ndarray) -> np.ndarray:
        o = np.where(n >= 3, lift * odds(n), 0.0)
        return np.maximum(0.0, 1 - scale * good / np.maximum(1, n)) * o / (1 + o)

    more = chance(bad) >= SLIGHT
    held = len(sample.features) + 1
    pairs = [np.zeros(0, np.int64)]
    for doc, words in sample.documents():
        if sample.toxic[doc] and len(words):
            before = np.concatenate([[0], words[:-1].astype(np.int64) + 1])
            own = sample.features[words]
            at, j = np.nonzero(more[own])
            pairs.append(np.unique(own[at, j].astype(np.int64) * held + before[at]))
    tokens = np.bincount(np.unique(np.concatenate(pairs)) // held, minlength=size)
    found = np.where(more, chance(np.minimum(bad, tokens)), 0.0)
    return np.where(found >= SLIGHT, found, 0.0), good + bad


def fit(texts: list[str], labels: list[int], epochs: int = EPOCHS, seed: int = 7) -> Crf | None:
    """Fit the field and the document score to labelled texts; None without both classes."""
    if len(set(labels)) < 2:
        return None
    return fit_sample(sample_of(texts, labels), epochs, seed)


def fit_sample(sample: Sample, epochs: int = EPOCHS, seed: int = 7) -> Crf:
    chances, documents = evidence(sample)
    kept_ids = np.flatnonzero((documents >= 5) | (chances > 0))
    column = np.zeros(len(documents), np.int32)
    column[kept_ids] = np.arange(1, len(kept_ids) + 1)  # 0: no feature
    table_of = column[sample.features]
    marked = chances[sample.features].max(axis=1, initial=0.0)
    words, lengths, n_words = sample.words, sample.lengths, len(sample.features)
    truth = np.where(np.repeat(sample.toxic, lengths), marked[words], 0.0)

    weights, squares = np.zeros(len(kept_ids) + 1), np.full(len(kept_ids) + 1, 1e-2)
    bias, start = np.log((truth.sum() + 1) / max(1, len(truth))), 0.0
    weights[1:] = -bias * chances[kept_ids]  # a sure sign starts at even odds, also on words not met
    log_trans, trans_squares = np.zeros((2, 2)), np.full((2, 2), 1e-2)
    begins, size = chains(lengths)
    blocks = list(_blocks(begins, size, 1 << 16))
    rng = np.random.default_rng(seed)
    for _ in range(max(epochs, -(-STEPS // max(1, len(blocks))))):
        for k in rng.permutation(len(blocks)):
            at, alive = _matrix(*blocks[k])
            inside = np.arange(len(at))[:, None] < blocks[k][1]
            at = np.where(inside, at, 0)
            seen = words[at]
            potential = np.where(inside, np.exp(np.clip(bias + weights[table_of[seen]].sum(axis=2), -30, 30)), 1.0)
            trans = np.exp(log_trans)
            f, b = forward_backward(potential, alive, np.exp(start), trans)
            gamma = f * b / (f * b + (1 - f) * (1 - b))
            residual = np.where(inside, truth[at] - gamma, 0.0)
            per_word = np.bincount(seen.ravel(), residual.ravel(), n_words)
            gradient = np.bincount(table_of.ravel(), np.repeat(per_word, 4), len(weights)) - 1e-3 * weights
            gradient[0] = 0
            squares += gradient**2
            weights += 0.5 * gradient / np.sqrt(squares)
            # Pair marginals, for the transitions.
            from_, to, ok = (1 - f[:-1], f[:-1]), ((1 - b[1:]), potential[1:] * b[1:]), inside[1:]
            joint = np.array([[from_[i] * trans[i, j] * to[j] for j in (0, 1)] for i in (0, 1)])
            joint = (joint / joint.sum(axis=(0, 1)))[:, :, ok].sum(axis=2)
            y = truth[at]
            state = (1 - y, y)
            seen_pairs = np.array([[(state[i][:-1] * state[j][1:])[ok].sum() for j in (0, 1)] for i in (0, 1)])
            step = (seen_pairs - joint) - 1e-3 * log_trans
            trans_squares += step**2
            log_trans += 0.3 * step / np.sqrt(trans_squares)
    # Features of little weight do not travel to the tasks.
    weights[np.abs(weights) < 0.01] = 0.0
    kept = {sample.names[f - 1]: float(weights[column[f]]) for f in kept_ids if weights[column[f]]}
    model = Crf(kept, float(np.exp(start)), np.exp(log_trans), float(bias), np.zeros(3))
    x = document_inputs(marginals(model, (bias + weights[table_of].sum(axis=1))[words], lengths), lengths)
    return model._replace(head=_logistic(x, sample.toxic.astype(float)))


def document_inputs(p: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Per document: 1, log of the sum of its squared marginals and log of the maximum,
    both from ``DOUBT`` up. Marginals as such would add up with a text's length alone."""
    total, most = np.zeros(len(lengths)), np.zeros(len(lengths))
    full = np.flatnonzero(lengths)
    if len(full):
        begins = (np.cumsum(lengths) - lengths)[full]
        total[full], most[full] = np.add.reduceat(p**2, begins), np.maximum.reduceat(p, begins)
    return np.stack([np.ones(len(lengths)), np.log(total + DOUBT), np.log(most + DOUBT)], axis=1)


def _logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Logistic regression by Newton steps, classes weighted alike."""
    w, head = np.where(y == 1, 0.5 / max(1, y.sum()), 0.5 / max(1, (1 - y).sum())) * len(y), np.zeros(x.shape[1])
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ head, -30, 30)))
        g = x.T @ (w * (y - p)) - 0.1 * head
        h = (x * (w * p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(x.shape[1])
        head = head + np.linalg.solve(h, g)
    return head


def training_rows(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, rows: int, most_bytes: int, total: int) -> DataFrame:
    """The bounded sample: (id, text, toxic)."""
    known = labels.filter("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    known = known.filter(F.crc32(F.col("doc_id").cast("string")) % 5 != 0)
    pick = lambda y, n: known.filter(F.col("toxic") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n)
    sample = pick(1, rows).unionAll(pick(0, 2 * rows)).withColumnRenamed("doc_id", "label_id")
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).filter(F.octet_length("text") <= most_bytes)
    met = texts.join(F.broadcast(sample), F.col("id") == F.col("label_id")).select("id", "text", "toxic")
    # An id may have any number of rows: the sample stays bounded, in rows and in bytes.
    few = met.limit(4 * rows)
    order = Window.orderBy(F.xxhash64("id"), "id", "text")
    return few.withColumn("upto", F.sum(F.octet_length("text")).over(order)).filter(F.col("upto") <= total).drop("upto")


def fit_on(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", rows: int = TRAIN_ROWS,
           most_bytes: int = TRAIN_BYTES, total: int = TRAIN_TOTAL) -> Crf | None:
    sample = training_rows(docs, labels, id_col, text_col, rows, most_bytes, total).orderBy("id", "text").toArrow()
    return fit(sample.column("text").to_pylist(), [int(y) for y in sample.column("toxic").to_pylist()])


def toxicity(docs: DataFrame, model: Crf | None, id_col: str = "doc_id", text_col: str = "text", keep: bool = False) -> DataFrame:
    """(doc_id, score, spans array<(start, end, p)>) for every row of ``docs``;
    offsets are code points, end exclusive. ``keep`` adds the row as ``record``."""
    place = next((i for i, (c, kind) in enumerate(docs.dtypes) if keep and c == text_col and kind == "string"), None)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), *([F.struct("*").alias("record")] if keep else []),
                       *([F.col(text_col).cast("string").alias("text")] if place is None else []))  # a text goes to Python once
    shipped = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the training sample
    span = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("p", pa.float64())])

    @given_back
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shipped.value
        known: dict[str, float] = {}
        for batch in batches:
            for begin, part in slices(batch.column("text") if place is None else batch.column("record").field(place)):
                part = [text or "" for text in part]
                if model is None:
                    scores, spans = np.zeros(len(part)), [[] for _ in part]
                else:
                    if len(known) > CACHE:
                        known = {}
                    scores, spans = score_texts(model, part, known)
                same = batch.slice(begin, len(part))
                columns = {"doc_id": same.column(0), "score": pa.array(scores, pa.float64()), "spans": pa.array(spans, pa.list_(span))}
                yield pa.RecordBatch.from_pydict(columns | ({"record": same.column(1)} if keep else {}))

    none = F.array().cast("array<struct<start:int,end:int,p:double>>")
    return rows.mapInArrow(score, rows.select("doc_id", F.lit(0.0).alias("score"), none.alias("spans"), *(["record"] if keep else [])).schema)


def score_texts(model: Crf, texts: list[str], known: dict[str, float]) -> tuple[np.ndarray, list[list[tuple]]]:
    tokens = [t.split() for t in texts]
    for token in set().union(*tokens).difference(known):
        known[token] = model.emission(token)
    lengths = np.array([len(t) for t in tokens])
    emission = np.fromiter((known[w] for t in tokens for w in t), float, int(lengths.sum()))
    p = marginals(model, emission, lengths)
    scores = 1 / (1 + np.exp(-np.clip(document_inputs(p, lengths) @ model.head, -30, 30)))
    spans: list[list[tuple]] = [[] for _ in texts]
    hit = p > 0.5
    for doc in np.flatnonzero((scores >= 0.5) & (lengths > 0)):  # each toxic text names an offence
        begin = int(lengths[:doc].sum())
        hit[begin + int(p[begin:begin + lengths[doc]].argmax())] = True
    hits = np.flatnonzero(hit)
    owner = np.searchsorted(np.cumsum(lengths), hits, side="right")
    for doc in np.unique(owner):
        base = int(lengths[:doc].sum())
        wanted = set((hits[owner == doc] - base).tolist())
        spans[doc] = [(m.start(), m.end(), float(p[base + i])) for i, m in enumerate(re.finditer(r"\S+", texts[doc])) if i in wanted]
    return scores, spans


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = toxicity(docs, fit_on(docs, table(spark, sf_dir, "labels")))
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "spans")
