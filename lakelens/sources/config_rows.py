"""Declarative rows from configuration (S-19): custom lineage, governance,
data-quality monitors and query attributions written by hand in a config file
become the same long tables the operators consume. The config is small and
lives on the driver; ``createDataFrame`` turns it into rows once."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession


def lineage_rows(spark: SparkSession, lineage: Mapping[str, Sequence[str]]) -> DataFrame:
    """S-19: {target: [sources]} -> (source_table, target_table) edges."""
    rows = [(s.lower(), t.lower()) for t, srcs in lineage.items() for s in srcs]
    return spark.createDataFrame(rows, "source_table string, target_table string")


def governance_rows(spark: SparkSession, datasets: Mapping[str, Mapping]) -> DataFrame:
    """S-19: {dataset: {owners: [...], tags: [...], column_tags: {col: [tags]}, description}}
    -> (dataset, kind, value, column_name, seq) rows for ``governance.governance_rows``."""
    rows = []
    for ds, spec in datasets.items():
        for o in spec.get("owners", []):
            rows.append((ds.lower(), "owner", o, None, 0))
        for t in spec.get("tags", []):
            rows.append((ds.lower(), "tag", t, None, 0))
        for col, tags in spec.get("column_tags", {}).items():
            for t in tags:
                rows.append((ds.lower(), "column_tag", t, col, 0))
        if spec.get("description"):
            rows.append((ds.lower(), "description", spec["description"], None, 1))
    return spark.createDataFrame(rows, "dataset string, kind string, value string, column_name string, seq int")


def monitor_rows(spark: SparkSession, monitors: Sequence[Mapping]) -> DataFrame:
    """[{dataset, title, status, severity}] -> monitor rows (M-3)."""
    rows = [(m["dataset"].lower(), m["title"], m.get("status", "UNKNOWN"), m.get("severity", "LOW")) for m in monitors]
    return spark.createDataFrame(rows, "dataset string, title string, status string, severity string")


def attribution_rows(spark: SparkSession, attributions: Mapping[str, str]) -> DataFrame:
    """{query_id: email} -> rows for ``governance.attributions`` (M-8)."""
    return spark.createDataFrame(list(attributions.items()), "query_id string, email string")
