"""S-19 config rows through the operators; O-2..O-4, O-7 helpers."""

from pyspark.sql import functions as F

from lakelens.operators import governance, lineage, ordering
from lakelens.sources import config_rows


def test_config_rows_feed_operators(spark):
    edges = config_rows.lineage_rows(spark, {"DB.S.Target": ["db.s.a", "db.s.b"]})
    listed = spark.createDataFrame([("db.s.a",)], "key string")
    assert {r.key for r in lineage.placeholders(edges, listed).collect()} == {"db.s.b"}
    g = config_rows.governance_rows(spark, {"db.s.t": {"owners": ["A@x.com"], "tags": ["gold"],
                                                       "column_tags": {"C1": ["pii"]}, "description": "d"}})
    row = governance.governance_rows(g).first()
    assert row.tags == ["gold"] and row.column_tags == ["c1:pii"] and row.description == "d" and len(row.owners) == 1
    a = governance.attributions(config_rows.attribution_rows(spark, {"q1": "a@x.com", "q2": "nope"}))
    assert {r.query_id: r.valid_email for r in a.collect()} == {"q1": True, "q2": False}
    m = config_rows.monitor_rows(spark, [{"dataset": "DB.T", "title": "rows > 0", "status": "PASSED"}])
    assert m.first().dataset == "db.t"


def test_ordering_helpers(spark):
    df = spark.createDataFrame([(1, "low", 3), (2, "high", 1), (3, "mid", 2), (4, "odd", 2)], "id int, p string, ts int")
    assert [r.id for r in ordering.newest_first(df, "ts", "id").collect()] == [1, 3, 4, 2]
    ranked = df.orderBy(ordering.priority("p", ["high", "mid", "low"]), "id").collect()
    assert [r.id for r in ranked] == [2, 3, 1, 4]
    assert [r.id for r in ordering.page(df, [F.col("id")], 2, 1).collect()] == [3, 4]
    assert spark.range(1).select(ordering.sorted_ids(F.array(F.lit(3), F.lit(1), F.lit(3)))).first()[0] == [1, 3]
