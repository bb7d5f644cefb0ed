"""A-5 / R-18 on a managed table in the session's (temporary) warehouse."""

from lakelens.operators import catalog
from lakelens.sources.tables import read_table


def test_stored_statistics_and_properties(spark, small_dir):
    name = "lakelens_stats_nation"
    read_table(spark, small_dir, "nation").write.mode("overwrite").saveAsTable(name)
    spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('owner_team' = 'data')")
    try:
        s = {r.column_name: r for r in catalog.stored_statistics(spark, name, ["n_nationkey", "n_name"]).collect()}
        assert s["n_nationkey"].distinct_value_count == 25 and s["n_nationkey"].null_value_count == 0
        assert s["n_nationkey"].min_value == "0" and s["n_nationkey"].max_value == "24"
        assert s["n_name"].record_count == 25
        props = {r.key: r.value for r in catalog.table_properties(spark, name).collect()}
        assert props.get("owner_team") == "data"
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
