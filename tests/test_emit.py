"""Batches against the law they keep, and conformance counts."""

import pytest

from lakelens.operators import emit


def cut_by_law(sizes, takes):
    """Group numbers when a group takes one row and then further ones while
    ``takes(rows so far, bytes so far, next size)``."""
    out, rows, held, group = [], 0, 0, -1
    for s in sizes:
        if not rows or not takes(rows, held, s):
            rows, held, group = 0, 0, group + 1
        rows, held = rows + 1, held + s
        out.append(group)
    return out


def events_by_law(files, logs_per_event):
    out, event, place = [], -1, {}
    for f in files:
        n = place[f] = place.get(f, -1) + 1
        event += n % logs_per_event == 0
        out.append(event)
    return out


def packed(spark, sizes, most, limit):
    df = spark.createDataFrame(list(enumerate(sizes)), "seq long, size long").repartition(5)
    return [b for _, b in sorted((r.seq, r.batch) for r in emit.pack(df, "seq", "size", most, limit).collect())]


@pytest.mark.parametrize("sizes,most,limit,batches", [
    ([4, 4, 4, 4], 9, 8, [0, 0, 1, 1]), ([9, 1, 1, 9, 9], 9, 5, [0, 1, 1, 2, 3]), ([0, 0, 0, 0, 0], 2, 7, [0, 0, 1, 1, 2]),
    ([3, 3, 3], 9, 3, [0, 1, 2]), ([1], 1, 1, [0]), ([7, 0, 0], 9, 5, [0, 1, 1]), ([], 3, 3, []),
])
def test_small_batches(spark, sizes, most, limit, batches):
    assert packed(spark, sizes, most, limit) == batches == cut_by_law(sizes, lambda n, held, s: n < most and held + s <= limit)


def test_cuts_do_not_depend_on_partitions(spark):
    sizes = [0 if i % 11 == 0 else 500 if i % 97 == 0 else (i * 37) % 50 + 1 for i in range(3000)]
    df = spark.createDataFrame(list(enumerate(sizes)), "seq long, size long").repartition(5)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for parts in (1, 7, 300):
            spark.conf.set("spark.sql.shuffle.partitions", str(parts))
            for most, limit in ((7, 120), (200, 3000), (40, 10**9)):
                assert packed(spark, sizes, most, limit) == cut_by_law(sizes, lambda n, held, s: n < most and held + s <= limit)  # noqa: B023
                rows = sorted((r.seq, r.event_no, r.file_no) for r in emit.query_log_batches(df, "seq", "size", most, 4, limit).collect())
                files = cut_by_law(sizes, lambda n, held, s: n < 4 * most and held < limit)  # noqa: B023
                assert [f for _, _, f in rows] == files and [e for _, e, _ in rows] == events_by_law(files, most)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_a_hot_order_key_is_split(spark):
    """Rows of one key go by size, over several partitions."""
    df = spark.createDataFrame([(1, i % 90) for i in range(4000)] + [(None, 5)], "seq long, size long")
    rows = sorted((r.seq is None, r.size, r.batch) for r in emit.pack(df, "seq", "size", 50, 900).collect())
    law = cut_by_law([s for _, s, _ in rows], lambda n, held, s: n < 50 and held + s <= 900)
    assert sorted(b for *_, b in rows) == law


def test_conformance_observation(spark):
    from pyspark.sql import functions as F
    df = spark.createDataFrame([(1,), (-1,), (3,)], "x int")
    out, obs = emit.check(df, {"positive": F.col("x") > 0})
    rows = out.collect()
    assert [r.valid for r in rows] == [True, False, True]
    assert obs.get["rows"] == 3 and obs.get["valid_rows"] == 2
