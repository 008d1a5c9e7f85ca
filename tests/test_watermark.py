import pytest
from pyspark.sql import functions as F

from tidewater.operators.watermark import high_watermark, low_watermark, watermarks, watermarks_of
from tidewater.sources.tables import ensure_zone, write_replace


def test_empty_table_gives_none_label(spark):
    df = spark.createDataFrame([], "pickup_datetime timestamp")
    rows = watermarks_of({"t": df}, "clean").collect()
    assert {r.part_type for r in rows} == {"high_watermark", "low_watermark"}
    assert all(r.create_time is None and r.part_name == "ds=None" for r in rows)
    assert all(r.database == "default" and r.cluster == "my_delta_environment" for r in rows)


def test_text_watermark_is_lexical(spark):
    df = spark.createDataFrame([("2014-01-01",), ("9/1/2013",)], "pickup_datetime string")
    assert high_watermark(df).first()[0] == "9/1/2013"
    assert low_watermark(df).first()[0] == "2014-01-01"


def test_zone_sweep_missing_and_empty(spark, tmp):
    ensure_zone(spark, "t_wm", f"{tmp}/wm")
    assert watermarks(spark, "t_wm").count() == 0
    write_replace(spark.createDataFrame([("2014-01-01 00:00:00",)], "pickup_datetime string")
                  .select(F.to_timestamp("pickup_datetime").alias("pickup_datetime")), "t_wm.a")
    write_replace(spark.createDataFrame([(1,)], "x int"), "t_wm.b")
    with pytest.raises(KeyError):
        watermarks(spark, "t_wm")
    rows = watermarks(spark, "t_wm", missing="skip").collect()
    assert {(r.table_name, r.part_name) for r in rows} == {("a", "ds=2014-01-01 00:00:00")}


def test_low_le_high(spark):
    df = spark.range(1000).select(F.expr("timestamp_seconds(id * 7919 % 100003)").alias("pickup_datetime"))
    r = {x.part_type: x.create_time for x in watermarks_of({"t": df}, "s").collect()}
    assert r["low_watermark"] <= r["high_watermark"]


def test_partitioned_tables_with_empty_edges_and_text_times(spark, tmp):
    from tidewater.sources.tables import write_partitioned

    ensure_zone(spark, "t_wm_part", f"{tmp}/wmp")
    rows = [("2014-03-05 00:00:00", 2014, 3), ("2016-01-02 00:00:00", 2016, 1), (None, None, None)]
    df = spark.createDataFrame(rows, "t string, pickup_year int, pickup_month int").select(
        F.to_timestamp("t").alias("pickup_datetime"), "pickup_year", "pickup_month")
    # a table of another tool, with partition entries in the catalog
    df.write.partitionBy("pickup_year", "pickup_month").saveAsTable("t_wm_part.a")
    spark.sql("ALTER TABLE t_wm_part.a ADD PARTITION (pickup_year = 2017, pickup_month = 1)")
    text = [("9/1/2013", 2013, 9), ("10/1/2012", 2012, 10), ("1/1/2014", 2014, 1)]
    write_partitioned(spark.createDataFrame(text, "pickup_datetime string, pickup_year int, pickup_month int"), "t_wm_part.b")
    got = {(r.table_name, r.part_type): r.create_time for r in watermarks(spark, "t_wm_part").collect()}
    assert got[("a", "high_watermark")].startswith("2016-01-02") and got[("a", "low_watermark")].startswith("2014-03-05")
    assert got[("b", "high_watermark")] == "9/1/2013" and got[("b", "low_watermark")] == "1/1/2014"


def _zone(spark, zone, tmp):
    """Tables of several types, layouts and histories, with nulls, extremes and empty ones."""
    from tidewater.sources.tables import append_table, write_partitioned

    ensure_zone(spark, zone, f"{tmp}/a zone+50%")
    base = spark.range(0, 4000, numPartitions=5).select(
        "id", F.expr("IF(id % 11 = 0, NULL, timestamp_seconds(id * 7919 % 100003 - 50000))").alias("stamp"))
    write_replace(base.select(F.col("stamp").cast("timestamp_ntz").alias("t"), "id"), f"{zone}.ntz")
    write_replace(base.select(F.col("stamp").alias("T"), "id"), f"{zone}.legacy")  # written without statistics
    write_partitioned(base.select(F.to_date("stamp").alias("t"), (F.col("id") % 3).cast("int").alias("k")), f"{zone}.dates", ["k"])
    write_replace(base.select((F.col("id") - 2000).alias("t")), f"{zone}.numbers")
    write_replace(base.select(F.col("stamp").cast("string").alias("t")), f"{zone}.text_a")
    write_replace(base.select(F.col("stamp").cast("string").alias("t"), "id").where("id < 100"), f"{zone}.text_b")
    write_replace(base.select(F.col("stamp").cast("timestamp_ntz").alias("t")).limit(0), f"{zone}.empty")
    write_replace(base.select(F.lit(None).cast("date").alias("t"), "id"), f"{zone}.nulls")
    write_replace(base.select("id"), f"{zone}.grown")
    append_table(base.select("id", F.to_date("stamp").alias("t")).where("id > 3900"), f"{zone}.grown")
    write_partitioned(base.select("id", F.to_date("stamp").alias("t")), f"{zone}.layout", ["t"])
    spark.sql(f"CREATE TABLE {zone}.other USING json AS SELECT DATE'2020-01-02' AS t")
    base.select("id", F.to_date("stamp").alias("t")).createOrReplaceTempView("wm_base")


def test_footers_and_shared_scans_equal_the_full_aggregation(spark, tmp):
    _zone(spark, "t_wm_foot", tmp)
    key = lambda df: sorted(map(tuple, df.collect()), key=str)
    tables = {t.name: spark.table(f"t_wm_foot.{t.name}") for t in spark.catalog.listTables("t_wm_foot") if not t.isTemporary}
    assert len(tables) == 11
    expected = key(watermarks_of(tables, "t_wm_foot", "t"))
    for footers in (True, False, None):
        assert key(watermarks(spark, "t_wm_foot", "t", footers=footers)) == expected
    assert key(watermarks(spark, "t_wm_foot", {t: "t" for t in tables}, kinds=["low_watermark"], footers=True)) == \
        [r for r in expected if "low_watermark" in r]


def test_footers_read_no_rows_and_the_plan_is_no_larger_for_more_tables(spark, tmp, capsys):
    ensure_zone(spark, "t_wm_many", f"{tmp}/many")
    sizes = {}
    for n in (4, 24):
        for i in range(n):
            if not spark.catalog.tableExists(f"t_wm_many.ntz_{i}"):
                write_replace(spark.createDataFrame([(f"2020-01-{i + 1:02} 00:00:00",)], "t string").select(
                    F.to_timestamp_ntz("t").alias("t")), f"t_wm_many.ntz_{i}")
                write_replace(spark.createDataFrame([(f"2020-01-{i + 1:02}",)], "t string"), f"t_wm_many.text_{i}")
        df = watermarks(spark, "t_wm_many", "t", footers=True)
        capsys.readouterr()
        df.explain()
        plan = capsys.readouterr().out
        sizes[n] = len(plan.splitlines())
        assert plan.count("FileScan parquet") == 2 and "footer-bounds" in plan  # the footers' results, and one scan of the text tables
        assert "ntz_" not in plan.replace("timestamp_ntz", "")
        got = {(r.table_name, r.part_type): r.create_time for r in df.collect()}
        assert len(got) == 4 * n and got["ntz_3", "high_watermark"] == "2020-01-04 00:00:00" and got["text_2", "low_watermark"] == "2020-01-03"
    assert sizes[4] == sizes[24]
