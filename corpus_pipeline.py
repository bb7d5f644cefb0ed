"""Corpus pipeline over ``documents``.

Each stage reads what its predecessor kept and returns the columns of
``documents``; the last returns packed pieces. Needed are ``doc_id`` and ``text``; other
columns are carried along, whatever their names. Rows without an id are judged like
any other; a null text is empty, and only one of the empty texts stays; of repeated
rows one stays; an empty table gives no pieces; without labels of both classes no
document counts as toxic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakelens.llm.common import ascii_lower, table, written
from lakelens.llm.exact_dedup import exact_dedup
from lakelens.llm.ngram_join import ngram_components
from lakelens.llm.packing import pack
from lakelens.llm.secret_scan import secret_scan
from lakelens.llm.toxicity import fit_on, toxicity


def _free(docs: DataFrame, *names: str) -> list[str]:
    """``names`` with as many underscores before them as no column of ``docs`` has."""
    taken = {c.lower() for c in docs.columns}
    return [next(name for n in range(1, len(taken) + 2) if (name := "_" * n + base) not in taken) for base in names]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: documents with a score of a half or more go. The model learns
    from the labelled rows of this stage's own input. Scoring is part of the
    scan, so no text is shuffled."""
    model = fit_on(docs, table(spark, sf_dir, "labels"))
    return toxicity(docs, model, keep=True).filter("score < 0.5").select("record.*")


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: of texts equal but for A-Z case the row with the largest id
    stays; of rows equal in id and text, the first by the text as it is and the other
    columns."""
    sha, nth, same_id, kept_sha = _free(docs, "sha", "nth", "id", "kept")
    kept = exact_dedup(docs).filter("kept").select(F.col("doc_id").alias(same_id), F.col("text_sha256").alias(kept_sha))
    # With the id, the digest stands for a row's text.
    rows = docs.withColumn(sha, F.sha2(ascii_lower(F.coalesce("text", F.lit(""))), 256))
    met = rows.join(kept, (F.col(sha) == F.col(kept_sha)) & F.col("doc_id").eqNullSafe(F.col(same_id)), "left_semi")
    others = F.to_json(F.struct(*[F.col(f"`{c}`") for c in docs.columns]))
    order = Window.partitionBy(sha, "doc_id").orderBy("text", others)
    return met.withColumn(nth, F.row_number().over(order)).filter(F.col(nth) == 1).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: of each component of near copies one row stays, that of the
    smallest id (rows without an id come last); texts without words stay. Rows get
    keys of their own, as an id may be null or have several texts."""
    (row,) = _free(docs, "row")
    rows = written(docs.withColumn(row, F.monotonically_increasing_id()), "near-copy-rows")
    found = ngram_components(rows, row).select(F.col("doc_id").alias("row"), "component_id")
    members = written(found.join(rows.select(F.col(row).alias("row"), F.col("doc_id").alias("id")), "row"), "near-copy-members")
    rank = F.struct(F.col("id").isNull(), "id", "row")
    best = members.groupBy("component_id").agg(F.min(rank)["row"].alias("best"), F.count("*").alias("c")).filter("c > 1")
    dropped = members.join(best, "component_id").filter("row <> best").select(F.col("row").alias(row))
    return rows.join(written(dropped, "near-copies"), row, "left_anti").select(*docs.columns)


def drop_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: documents with a secret of any kind go."""
    return secret_scan(docs, keep=True).filter("spans = ''").select("record.*")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: training sequences."""
    return pack(docs)


STAGES = [("toxicity", drop_toxic), ("exact dedup", drop_copies), ("n-gram join", drop_near_copies),
          ("secret scan", drop_secrets), ("packing", packed)]
ORACLE_SQL = None  # a trained model decides the first stage


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
