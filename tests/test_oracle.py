"""Every registered job against its DuckDB oracle on the smallest tables."""

import pytest

import __spark_entry__ as entry
from check_oracle import compare, duck

from lakelens.plans import registry

KEYS = sorted(registry.queries())


@pytest.fixture(scope="module")
def con(small_dir):
    return duck(small_dir)


@pytest.mark.parametrize("key", KEYS)
def test_job_matches_oracle(spark, con, small_dir, key):
    status, msg, _ = compare(spark, con, key, entry.queries()[key], entry.oracle_sql().get(key), small_dir)
    assert status in ("OK", "ROWS-ONLY"), msg


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "field_path" in df.columns


def test_jobs_pin_utc(spark, con, small_dir):
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        status, msg, _ = compare(spark, con, "stream_usage_closed_days", entry.queries()["stream_usage_closed_days"],
                                 entry.oracle_sql()["stream_usage_closed_days"], small_dir)
        assert status == "OK", msg
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
