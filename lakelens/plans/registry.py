"""Registry of named jobs over the landed tables.

Each job is ``fn(spark, sf_dir) -> DataFrame``; most carry an equivalent ANSI
SQL text (DuckDB dialect) used as an independent oracle. Output conventions
shared by both sides: doubles rounded to 6 places, arrays sorted, no structs.
"""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Job = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Job] = {}
ORACLES: dict[str, str] = {}

_MODULES = (
    "profiling", "usage_jobs", "naming", "governance_jobs", "catalog_jobs", "log_jobs",
    "lineage_jobs", "lake_jobs", "document_jobs", "schema_jobs", "sql_jobs", "emit_jobs", "bi_jobs", "connector_jobs",
    "stream_jobs", "metadata_jobs",
)


def _with_session_defaults(fn: Job) -> Job:
    """Jobs treat timestamps as UTC wall-clock time (day windows, epoch
    arithmetic), so the session time zone is pinned to UTC before planning."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        if spark.conf.get("spark.sql.session.timeZone", "UTC") != "UTC":
            spark.conf.set("spark.sql.session.timeZone", "UTC")
        return fn(spark, sf_dir)
    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    return run


def register(name: str, oracle: str | None = None):
    """X-1: the extension point. A custom source or job is a function
    ``(spark, sf_dir) -> DataFrame`` registered under a name, optionally with
    an equivalent SQL text."""
    def deco(fn: Job) -> Job:
        if name in QUERIES:
            raise ValueError(f"duplicate job {name}")
        QUERIES[name] = _with_session_defaults(fn)
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


def load_all() -> None:
    for m in _MODULES:
        try:
            importlib.import_module(f"lakelens.plans.{m}")
        except ModuleNotFoundError as e:
            if e.name != f"lakelens.plans.{m}":
                raise


def queries() -> dict[str, Job]:
    load_all()
    return dict(QUERIES)


def oracles() -> dict[str, str]:
    load_all()
    return dict(ORACLES)
