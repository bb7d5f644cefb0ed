"""The corpus pipeline, stage by stage, against brute force."""

import contextlib
import tracemalloc

import corpus_pipeline as pipeline
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lakelens.llm import common, exact_dedup, ngram_join, packing, secret_scan, toxicity
from lakelens.llm.common import written


def test_stages_keep_columns_and_decide(spark, small_dir):
    docs = spark.read.parquet(f"{small_dir}/documents.parquet")
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{small_dir}/labels.parquet").collect()}
    columns, rows = docs.columns, docs.collect()
    for name, stage in pipeline.STAGES[:-1]:
        docs = written(stage(spark, docs, small_dir), "test-stage")
        assert docs.columns == columns
        before, rows = rows, docs.collect()
        kept = {r.doc_id for r in rows}
        if name == "toxicity":
            gone = [r.doc_id for r in before if r.doc_id not in kept]
            assert gone and sum(labels.get(d) == 0 for d in gone) <= 1
        elif name == "exact dedup":
            best = {}
            for r in before:
                key = (r.text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
                best[key] = max(best.get(key, -1), r.doc_id)
            assert kept == set(best.values())
    assert exact_dedup.exact_dedup(docs).filter("NOT kept").isEmpty()
    assert ngram_join.ngram_components(docs).filter("doc_id <> component_id").isEmpty()
    assert secret_scan.secret_scan(docs).filter("spans <> ''").isEmpty()
    pieces = pipeline.STAGES[-1][1](spark, docs, small_dir)
    assert pieces.select("doc_id").distinct().count() == docs.count()
    assert pieces.agg(F.max("length")).first()[0] <= 2048


def test_near_copies_go_by_row(spark, small_dir):
    """Ids that repeat or are null: one row of each component stays, and no other goes."""
    base = " ".join(f"v{i}" for i in range(80))
    near = [base + " x", base + " y z", base + " q"]
    other = " ".join(f"u{i}" for i in range(50))
    rows = [(1, base), (5, near[0]), (5, other), (None, near[1]), (1, near[2]), (None, ""), (7, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = [tuple(r) for r in pipeline.drop_near_copies(spark, docs, small_dir).collect()]
    assert sum(t.startswith("v0") for _, t in kept) == 1 and all(d == 1 for d, t in kept if t.startswith("v0"))
    assert (5, other) in kept and sum(t == "" for _, t in kept) == 2 and len(kept) == 4


def test_whole_run_on_odd_tables(spark, tmp_path):
    """Null and empty texts, repeated rows, few and clashing columns, and no rows at all."""
    base = " ".join(f"v{i}" for i in range(60))
    rows = [(1, base, "a", 1), (2, base.upper(), "b", 2), (3, base + " tail", None, 3), (4, None, None, 4), (5, "", None, 5), (6, "other words here", "x", 6),
            (6, "other words here", "x", 6), (6, "other words here", "w", 6), (None, "no id at all", None, 7), (7, "secret = abcdefgh12", None, 8)]
    for n, table in enumerate((rows, [])):
        folder = str(tmp_path / str(n))
        spark.createDataFrame(table, "doc_id long, text string, _sha string, record long").write.parquet(f"{folder}/documents.parquet")
        spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
        pieces = pipeline.run(spark, folder).collect()
        assert sorted((r.doc_id for r in pieces), key=str) == ([] if n else [2, 5, 6, None])
    docs = spark.createDataFrame(rows, "doc_id long, text string, _sha string, record long")
    kept = pipeline.drop_copies(spark, docs, "").collect()
    assert [r["_sha"] for r in kept if r.doc_id == 6] == ["w"] and kept[0].__fields__ == docs.columns


def test_workers_give_memory_back(spark):
    """A Python worker lives on after its task; what the task held goes back to the system."""
    psutil = pytest.importorskip("psutil")

    def held():
        """MB of own memory of each Python worker."""
        found = {}
        for p in psutil.Process().children(recursive=True):
            with contextlib.suppress(psutil.Error):
                if any("pyspark.daemon" in x for x in p.cmdline()):
                    found[p.pid] = p.memory_full_info().uss / 1e6
        return found

    word = F.expr("concat_ws(' ', transform(sequence(1, 150), i -> concat('w', substr(md5(concat(id, ' ', i)), 1, 10))))")
    docs = spark.range(0, 4000, 1, 1).select(F.col("id").alias("doc_id"), word.alias("text"))
    before = held()
    written(packing.pack(docs), "test-stage")
    grown = [mb - before.get(pid, 0) for pid, mb in held().items()]
    assert grown and max(grown) < 160, grown


def test_scored_rows_are_kept_whole(spark):
    """A row's text goes to Python once, within the row; null texts stay null."""
    model = toxicity.Crf({"w:bad": 9.0}, 1e-3, np.ones((2, 2)), -5.0, np.array([0.0, 1.0, 1.0]))
    rows = [(1, "a bad thing", "x"), (2, None, None), (None, "", "y"), (4, "fine", "z"), (2, "bad bad", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, record string").coalesce(1)
    plain = [tuple(r) for r in toxicity.toxicity(docs, model).collect()]
    kept = toxicity.toxicity(docs, model, keep=True)
    sent = kept._jdf.queryExecution().analyzed().toString()
    assert [tuple(r)[:3] for r in kept.collect()] == plain and plain[0][1] > 0.5 > plain[1][1]
    assert [tuple(r) for r in kept.select("record.*").collect()] == rows
    assert "text" not in toxicity.toxicity(docs, model, keep=True).columns and " AS text#" not in sent
    odd = docs.withColumn("text", F.lit(None))
    assert [r.score for r in toxicity.toxicity(odd, model, keep=True).collect()] == [plain[1][1]] * 5


def test_packing_remembers_few_words():
    """Packing's Python workers run beside a full heap: what a task remembers of texts
    of ever new words stays small, and the ids are those of the whole tokenizer."""
    tokenizer = packing.ChunkTokenizer(packing.VOCABULARY)
    texts = [" ".join(f"w{i}x{j}" for j in range(400)) for i in range(600)]
    tracemalloc.start()
    try:
        for i in range(0, len(texts), 20):
            found = tokenizer(texts[i:i + 20])
        held, peak = tracemalloc.get_traced_memory()
    finally:
        tracemalloc.stop()
    assert peak < 50e6, (held, peak)
    whole = [tokenizer.tokenizer.encode(t, add_special_tokens=False).ids for t in texts[-20:]]
    assert [np.frombuffer(x, "<u4").tolist() for x in found] == whole


def test_memory_goes_back_between_batches(monkeypatch):
    trimmed = []

    class Library:
        malloc_trim = trimmed.append

    monkeypatch.setattr(common.ctypes, "CDLL", lambda _: Library)
    batches = [pa.RecordBatch.from_pydict({"a": [i]}) for i in range(5)]
    assert list(common.given_back(lambda x: x)(iter(batches))) == batches
    assert len(trimmed) >= len(batches)


def test_released_tables_start_no_python_worker(spark, monkeypatch):
    df = written(spark.sql("SELECT 1L AS a, array(struct('x' AS b)) AS c, map('k', 1) AS d, x'00' AS e"), "test-released")
    monkeypatch.setattr(type(spark.sparkContext), "parallelize", None)  # its rows go through Python workers
    common.released(df)
    again = spark.read.schema(df.schema).parquet(df.inputFiles()[0].rsplit("/", 1)[0])
    assert again.dtypes == df.dtypes and again.count() == 0
