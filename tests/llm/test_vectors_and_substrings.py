"""Operators 11 to 13: brute force, odd rows, ties and skew."""

import collections
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakelens.llm import hard_negatives, substring_dedup, whitening
from lakelens.llm.vectors import scaled, usable

# ---- operator 13


def cut_by_hand(rows, window):
    """doc_id, kept words of each row by brute force."""
    words = [(d, (t or "").encode().split()) for d, t in rows]
    least = {}
    for d, ws in words:
        if d is not None:
            for i in range(len(ws) - window + 1):
                key = tuple(ws[i:i + window])
                least[key] = min(d, least.get(key, d))
    out = []
    for d, ws in words:
        gone = set()
        for i in range(len(ws) - window + 1):
            if d is not None and least[tuple(ws[i:i + window])] < d:
                gone.update(range(i, i + window))
        out.append((d, len(ws), len(gone), b" ".join(w for i, w in enumerate(ws) if i not in gone).decode()))
    return collections.Counter(out)


def cut_by_spark(spark, rows, window):
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("mark", F.lit(1)).withColumn("starts", F.lit("x"))
    found = substring_dedup.substring_dedup(docs, window=window).select("doc_id", "n_words", "n_removed", "kept").collect()
    return collections.Counter(tuple(r) for r in found)


def passages(seed, n=60):
    """Random texts over a small vocabulary, with shared passages at every shift, copies,
    repeats inside a text and repeated rows."""
    rng = random.Random(seed)
    common = [f"c{i}" for i in range(40)]
    rows = []
    for d in range(n):
        ws = [f"w{rng.randrange(2000)}" for _ in range(rng.randrange(60))]
        for _ in range(rng.randrange(4)):
            i, j = sorted(rng.sample(range(41), 2))
            at = rng.randrange(len(ws) + 1)
            ws[at:at] = common[i:j]
        rows.append((d, rng.choice([" ", "\t\n", "  "]).join(ws)))
    return [*rows, (3, rows[7][1]), (3, rows[3][1]), (3, rows[3][1]), (None, rows[9][1]), (90, "a b " * 60), (91, "a b " * 60),
            (92, rows[5][1] + " " + rows[5][1]), (93, None), (94, ""), (95, "é b " * 20), (96, "é b " * 20), (-5, rows[11][1])]


@pytest.mark.parametrize("window", [1, 2, 5, 13, 26])
def test_substrings_match_brute_force(spark, window):
    rows = passages(window)
    assert cut_by_spark(spark, rows, window) == cut_by_hand(rows, window)


def test_hot_passages_are_split(spark, monkeypatch):
    """With every hash hot and salted, the rows stay the same."""
    monkeypatch.setattr(substring_dedup, "SAMPLE", 1)
    monkeypatch.setattr(substring_dedup, "SALT_ROWS", 3)
    rows = passages(4) + [(200 + i, "x " + " ".join(f"c{i}" for i in range(30))) for i in range(80)]
    assert cut_by_spark(spark, rows, 13) == cut_by_hand(rows, 13)


def test_covers_meet_at_every_shift():
    for period, cover in substring_dedup.COVERS.items():
        for a in range(period):
            assert any((s % period in cover) and ((a + s) % period in cover) for s in range(period))


def test_substrings_of_nothing(spark):
    none = spark.createDataFrame([], "doc_id long, text string, record string")
    assert substring_dedup.substring_dedup(none, keep=True).count() == 0


def test_long_text_and_removed_runs(spark):
    long = " ".join(f"t{i}" for i in range(200_000))
    rows = [(1, long), (2, "lead " + long + " tail"), (3, "a " * 5)]
    found = {r.doc_id: r for r in substring_dedup.substring_dedup(spark.createDataFrame(rows, "doc_id long, text string"), keep=True).collect()}
    assert found[1].n_removed == 0 and found[2].kept == "lead tail" and [tuple(x) for x in found[2].removed] == [(1, 200_001)]
    assert found[2].record.text.startswith("lead t0") and found[3].removed == []


# ---- operator 12


def whitened(spark, vectors, **options):
    frame = spark.createDataFrame(vectors, "vec_id long, embedding array<float>, whitened string, x string")
    rows = frame.filter(usable("embedding")).select("vec_id", scaled("embedding", 64, 1_000_000).alias("x"))
    return whitening.whiten(rows, missing=1_000_000, **options).collect()


def check_whitening(vectors, found, weighted=False, most=16):
    x = {}
    width = max(len(v) for _, v, *_ in vectors if v)
    for i, v, *_ in vectors:
        if v is not None and all(c is not None and np.isfinite(c) for c in v):
            x.setdefault(i, []).append(tuple(int(np.floor(64 * float(np.float32(c)))) + 1_000_000 for c in v) + (1_000_000,) * (width - len(v)))
    rows = [r for own in x.values() for r in own]
    fit = rows if weighted else list(dict.fromkeys(rows))
    n, total = len(fit), [sum(c) for c in zip(*fit)]
    exact = np.array([[n * c - s for c, s in zip(r, total)] for r in fit], dtype=object)
    y = exact.astype(float) / n
    cov = y.T @ y / n
    values, axes = np.linalg.eigh(cov)
    values, axes = values[::-1], axes[:, ::-1]
    assert len(found) == len(rows)
    for r in found:
        options = [np.array([n * c - s for c, s in zip(v, total)], dtype=object) for v in x[r.vec_id]]
        assert r.n == n and int(r.deviation) in [int((o * o).sum()) for o in options]
        k = len(r.whitened)
        assert k == min(most, int((values > len(values) * 2.3e-16 * values[0]).sum()))
        np.testing.assert_allclose(r.explained, values[:k] / np.trace(cov), rtol=1e-9)
        assert r.identity_error < 1e-6
        best = [np.abs(np.abs((o.astype(float) / n) @ axes[:, :k] / np.sqrt(values[:k])) - np.abs(r.whitened)).max() for o in options]
        assert min(best) < 1e-6


@pytest.mark.parametrize("weighted", [False, True])
def test_whitening_matches_numpy(spark, weighted):
    rng = np.random.default_rng(5)
    vectors = [(i, [float(c) for c in np.float32(rng.normal(size=20) * np.arange(1, 21))], "w", "x") for i in range(200)]
    vectors += [(300 + i, vectors[3][1], "w", None) for i in range(90)]  # a third of the rows hold one vector
    vectors += [(400, None, None, None), (401, [1.0, None] * 10, None, None), (402, [float("nan")] * 20, None, None), (403, [float("inf")] * 20, None, None),
                (404, [1.0, 2.0], None, None)]
    check_whitening(vectors, whitened(spark, vectors, weighted=weighted), weighted)


def test_whitening_of_flat_data(spark):
    rng = np.random.default_rng(6)
    vectors = [(i, [float(a), float(b), float(a + b), 0.0], None, None) for i, (a, b) in enumerate(rng.integers(-5, 5, (40, 2)))]
    check_whitening(vectors, whitened(spark, vectors))
    assert whitened(spark, [(1, [1.0, 2.0], None, None), (2, [1.0, 2.0], None, None)]) == []
    assert whitened(spark, []) == [] and whitened(spark, [(1, [], None, None)]) == []


def test_whitening_range(spark):
    with pytest.raises(ValueError):
        whitened(spark, [(1, [1e30, 2.0], None, None), (2, [1.0, 2.0], None, None)])


# ---- operator 11


def mine_by_hand(rows, anchors, positives, negatives):
    own = {}
    for i, label, v in anchors:
        own[i] = min(own.get(i, (label, v)), (label, v))
    out = collections.Counter()
    for i, (label, v) in own.items():
        score = lambda u: int(np.dot(u, v))  # noqa: E731, B023
        rank = sorted(((-score(u), j) for j, y, u in rows if j != i and y == label))[:positives]
        for s, j in rank:
            found = sorted((-score(u), k) for k, y, u in rows if k != i and y != label and 30 * -s <= 100 * score(u) <= 90 * -s)[:negatives]
            out.update((i, j, r + 1, k, -s, -t) for r, (t, k) in enumerate(found))
    return out


def mine_by_spark(spark, rows, anchors, **options):
    frame = lambda x: spark.createDataFrame(x, "vec_id long, label int, v array<long>")
    return collections.Counter(tuple(r) for r in hard_negatives.hard_negatives(frame(rows), frame(anchors), **options).collect())


@pytest.mark.parametrize("options", [{}, {"part": 64, "block": 8, "sample": 20}, {"sample": 1, "part": 100}, {"positives": 2, "negatives": 3, "sample": 60}])
def test_negatives_match_brute_force(spark, options):
    rng = np.random.default_rng(len(options))
    rows = [(int(i), int(rng.choice(6, p=[0.5, 0.2, 0.1, 0.1, 0.09, 0.01])), [int(c) for c in rng.integers(-9, 14, 21)]) for i in range(400)]
    rows += [(500 + i, i % 3, rows[i % 2][2]) for i in range(60)]  # ties
    rows += [(600, 1, [0] * 21), (601, 0, [0] * 21), (602, 2, [-c for c in rows[0][2]]), (7, 3, rows[9][2]), (7, 3, rows[9][2]), (8, 0, rows[3][2])]
    anchors = [r for r in rows if r[0] % 20 == 0 or r[0] in (7, 8, 601, 602)]
    got = mine_by_spark(spark, rows, anchors, **options)
    assert got == mine_by_hand(rows, anchors, options.get("positives", 5), options.get("negatives", 10))


def test_negatives_of_nothing(spark):
    assert not mine_by_spark(spark, [], [])
    assert not mine_by_spark(spark, [(1, 0, [1, 2])], [(1, 0, [1, 2])])
    assert mine_by_spark(spark, [(1, 0, [5]), (2, 0, [5, 0]), (3, 1, [3])], [(1, 0, [5])]) == {(1, 2, 1, 3, 25, 15): 1}
    with pytest.raises(ValueError):
        mine_by_spark(spark, [(1, 0, [1 << 40]), (2, 0, [1 << 40])], [(1, 0, [1])])


def test_threshold_join_skips_and_keeps(spark):
    """Every pair at or over its threshold is found, with less than all the work."""
    rng = np.random.default_rng(9)
    rows, anchors = (np.int64(rng.normal(size=(n, 64)) * 100 / (1 + np.arange(64))) for n in (500, 40))
    scores = anchors @ rows.T
    least = np.partition(scores, -5, axis=1)[:, -5]
    i, j, found, work = hard_negatives.threshold_join(rows, anchors, least, np.ones(scores.shape, bool))
    assert {(a, b): c for a, b, c in zip(i, j, found)} == {(a, b): scores[a, b] for a, b in zip(*np.nonzero(scores >= least[:, None]))}
    assert work < 0.5 * scores.size * 64


# ---- operator 5: the field's marginals and the size of its fit


def test_marginals_match_enumeration():
    import itertools

    from lakelens.llm import toxicity

    rng = np.random.default_rng(3)
    for n in (1, 2, 5, 7):
        emission, start, trans = rng.normal(size=n), float(np.exp(rng.normal())), np.exp(rng.normal(size=(2, 2)))
        total, one = 0.0, np.zeros(n)
        for path in itertools.product((0, 1), repeat=n):
            weight = np.exp(sum(e for e, y in zip(emission, path) if y)) * (start if path[0] else 1)
            weight *= np.prod([trans[a, b] for a, b in zip(path, path[1:])])
            total += weight
            one += weight * np.array(path)
        model = toxicity.Crf({}, start, trans, 0.0, np.zeros(3))
        np.testing.assert_allclose(toxicity.marginals(model, emission, np.array([n])), one / total, rtol=1e-9)


def test_sample_is_bounded_in_bytes(spark):
    from lakelens.llm import toxicity

    docs = spark.createDataFrame([(i, "a b c " * (i % 7 + 1)) for i in range(400)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 3 == 0) for i in range(400)], "doc_id long, toxic boolean").withColumn("toxic", F.col("toxic").cast("int"))
    few = toxicity.training_rows(docs, labels, "doc_id", "text", 50, 30, 900).collect()
    assert 0 < len(few) <= 150 and 800 < sum(len(r.text) for r in few) <= 900 and all(len(r.text) <= 30 for r in few)
    assert toxicity.fit(["", "a b"], [1, 0]) is not None and toxicity.fit(["", ""], [1, 0]) is not None


# ---- operator 6: skew


def test_ngram_join_of_a_large_group_and_a_common_passage(spark, monkeypatch):
    """A group of near copies, some of them too far from the rest, and a passage that a
    third of the documents share; regions of 40 rows go through every division."""
    from lakelens.llm import ngram_join
    from tests.llm.test_operators import brute_components

    monkeypatch.setattr(ngram_join, "REGION", 40)
    rng = random.Random(8)
    words = [f"v{i}" for i in range(3000)]
    base, passage = rng.sample(words, 80), rng.sample(words, 50)
    rows = []
    for i in range(420):
        if i % 3 == 0:
            text = passage + rng.sample(words, rng.randint(5, 60))
        else:
            text = list(base)
            for _ in range(rng.choice((0, 1, 2, 2, 3, 4, 5, 6))):
                text[rng.randrange(len(text))] = rng.choice(words)
        rows.append((i, " ".join(text)))
    got = ngram_join.ngram_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute_components(rows)


def test_sketch_distance_is_a_lower_bound():
    from lakelens.llm.ngram_join import LONGS, sketch

    rng = np.random.default_rng(2)
    for n in (3, 200, 700, 3000):
        a = np.unique(rng.integers(-2**62, 2**62, n))
        b = np.unique(np.concatenate([a[rng.random(len(a)) < 0.8], rng.integers(-2**62, 2**62, n // 6)]))
        x, y = sketch(a), sketch(b)
        while len(x) != len(y):
            x, y = (x.reshape(2, -1)[0] ^ x.reshape(2, -1)[1], y) if len(x) > len(y) else (x, y.reshape(2, -1)[0] ^ y.reshape(2, -1)[1])
        apart = len(np.setxor1d(a, b))
        assert len(x) >= LONGS and sum(int(v).bit_count() for v in (x ^ y).view(np.uint64)) <= apart


# ---- operators 4, 8 and 9: very many hits, ids of odd texts, hot blocks


def test_secrets_of_a_text_with_many_hits(spark):
    from lakelens.llm import secret_scan

    rng = random.Random(3)
    words = ["".join(rng.choice("0123456789abcdef") for _ in range(rng.randint(20, 30))) for _ in range(40_000)]
    text = " ".join(words) + " é token=abcdefgh"
    want, at = [], 0
    for w in words:
        if len(w) >= 24:
            want.append((at, at + len(w)))
        at += len(w) + 1
    found = secret_scan.secret_scan(spark.createDataFrame([(1, text), (2, ""), (3, None)], "doc_id long, text string"), more=()).collect()
    row = next(r for r in found if r.doc_id == 1)
    assert row.n_hex == len(want) and row.n_assign == 1
    assert [s for s in row.spans.split(",") if s.startswith("hex")] == [f"hex:{a}:{b}" for a, b in want]
    assert row.spans.endswith(f"assign:{text.index('token')}:{len(text)}")


def test_packed_ids_are_the_tokenizers(spark, small_dir):
    from tokenizers import Tokenizer

    from lakelens.llm import packing

    plain = Tokenizer.from_file(packing.VOCABULARY)
    docs = [r.text or "" for r in spark.read.parquet(f"{small_dir}/documents.parquet").select("text").collect()]
    rng = random.Random(5)
    odd = ["<|endoftext|> a <|startoftext|>b", " lead", "trail ", "a  b c　d", "\x00\x01 ​ é ﬁ İ", "\n\t x\r\n y", "don't I'll ퟿ 한국어 日本 🙂🙃 👩‍👩"]
    odd += ["".join(rng.choice("ab é́ \n<|>'s１Å🙂　 x ") for _ in range(rng.randrange(60))) for _ in range(2000)]
    texts = docs + odd
    encode = packing.ChunkTokenizer(packing.VOCABULARY)
    for i in range(0, len(texts), 50):
        for text, data in zip(texts[i:i + 50], encode(texts[i:i + 50]), strict=True):
            assert np.frombuffer(data, "<u4").tolist() == plain.encode(text, add_special_tokens=False).ids, text


def test_equal_blocks_of_many_rows(spark, monkeypatch):
    from lakelens.llm import exact_dedup

    monkeypatch.setattr(exact_dedup, "LIST_ROWS", 3)
    rows = [(i, "" if i % 3 == 0 else "ab " * (i % 5) + ("AB " * 9 if i % 2 else "ab " * 9)) for i in range(300)]
    found = exact_dedup.exact_dedup(spark.createDataFrame(rows, "doc_id long, text string"), block=4).collect()
    best = {}
    for i, t in rows:
        best.setdefault(t.lower(), []).append(i)
    assert {(r.doc_id, r.keep_id, r.group_size, r.kept) for r in found} == {(i, max(g), len(g), i == max(g)) for g in best.values() for i in g}
