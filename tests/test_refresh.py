from pyspark.sql import functions as F

from tidewater.operators.graph import DAY_MS
from tidewater.operators.merge import merge_eras
from tidewater.operators.profile import schema_profile
from tidewater.plans import taxi
from tidewater.plans.refresh import metadata_refresh
from tidewater.plans.standins import standin
from tidewater.sources.tables import ensure_zone, write_partitioned, write_replace

from conftest import SMALL

NOW = 1_705_708_800_000


def test_raw_zone_profiles_nothing_and_empty_zone(spark, tmp):
    ensure_zone(spark, "t_rawp", f"{tmp}/rawp")
    assert schema_profile(spark, "t_rawp").count() == 0  # no tables
    write_replace(taxi.raw_fix(standin(spark, SMALL, "y1")), "t_rawp.yellow_taxi_pre2015")
    assert schema_profile(spark, "t_rawp").count() == 0  # all text: nothing numeric


def test_metadata_refresh_end_to_end(spark, tmp):
    ensure_zone(spark, "t_r_raw", f"{tmp}/r_raw")
    ensure_zone(spark, "t_r_clean", f"{tmp}/r_clean")
    g1, g2 = taxi.raw_fix(standin(spark, SMALL, "g1")), taxi.raw_fix(standin(spark, SMALL, "g2"))
    write_replace(g1, "t_r_raw.green_taxi_2015_h1")
    write_partitioned(taxi.clean_green(merge_eras(g1, g2)), "t_r_clean.green_clean")
    old_graph_nodes = spark.createDataFrame(
        [("user/1", "User", "u1", {}), ("user/2", "User", "u2", {})],
        "key string, label string, name string, attrs map<string,string>")
    old_graph_edges = spark.createDataFrame(
        [("user/1", "User", "default://my_delta_environment.t_r_clean/green_clean", "Table", "READ", "READ_BY",
          NOW - 10 * DAY_MS),
         ("user/2", "User", "default://my_delta_environment.t_r_clean/green_clean", "Table", "READ", "READ_BY",
          NOW - 1 * DAY_MS)],
        "start_key string, start_label string, end_key string, end_label string, type string, "
        "reverse_type string, last_updated long")
    out = metadata_refresh(spark, ["t_r_raw", "t_r_clean"], NOW, graph=(old_graph_nodes, old_graph_edges))

    labels = {r.label: r["count"] for r in out["nodes"].groupBy("label").count().collect()}
    assert labels["Table"] == 2 and labels["Schema"] == 2 and labels["User"] == 2
    assert labels["Watermark"] == 4  # raw (text, lexical) and clean, high and low
    from tidewater.functions.columns import numeric_columns

    numeric_cols = len(numeric_columns(spark.table("t_r_clean.green_clean")))
    assert numeric_cols == 19
    assert labels["Stat"] == 21 * numeric_cols  # 21 statistics per numeric column
    reads = [r.start_key for r in out["edges"].where(F.col("type") == "READ").collect()]
    assert reads == ["user/2"]  # the 10-day-old relation expired
    docs = {r.name: r for r in out["search_docs"].collect()}
    assert set(docs) == {"green_taxi_2015_h1", "green_clean"}
    assert docs["green_clean"].column_count == 24
    assert set(docs["green_clean"].column_names) == set(spark.table("t_r_clean.green_clean").columns)
    wm = {(r.table_name, r.part_type): r.part_name for r in out["watermarks"].collect()}
    assert wm[("green_clean", "high_watermark")].startswith("ds=")
    assert out["profiles"].where(F.col("table_name") == "green_taxi_2015_h1").count() == 0
