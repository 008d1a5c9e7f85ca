import io
from contextlib import redirect_stdout

import pytest
from pyspark.sql import functions as F

from tidewater.plans import taxi
from tidewater.plans.standins import standin
from tidewater.sources.files import append_evolve, read_evolved
from tidewater.sources.tables import (
    ensure_zone,
    partition_columns,
    restore_version,
    scan_table,
    scan_version,
    vacuum,
    versions,
    write_overwrite,
    write_partitioned,
    write_replace,
)

from conftest import SMALL


def test_partitioned_roundtrip_null_partition_and_pruning(spark, tmp):
    ensure_zone(spark, "t_clean", f"{tmp}/clean")
    from tidewater.operators.merge import merge_eras

    merged = merge_eras(taxi.raw_fix(standin(spark, SMALL, "g1")), taxi.raw_fix(standin(spark, SMALL, "g2")))
    clean = taxi.clean_green(merged)
    write_partitioned(clean, "t_clean.green_clean")
    back = scan_table(spark, "t_clean", "green_clean")
    assert back.count() == clean.count()
    assert back.where(F.col("pickup_year").isNull()).count() == clean.where(F.col("pickup_year").isNull()).count() > 0
    q = back.where((F.col("pickup_year") == 1995) & (F.col("pickup_month") == 3)).select("fare_amount")
    buf = io.StringIO()
    with redirect_stdout(buf):
        q.explain()
    assert "PartitionFilters: [isnotnull(pickup_year" in buf.getvalue()
    assert "ReadSchema: struct<fare_amount:float>" in buf.getvalue()


def test_overwrite_checks_schema_and_self_read(spark, tmp):
    ensure_zone(spark, "t_raw", f"{tmp}/raw")
    df = spark.createDataFrame([(1, "a")], "k int, v string")
    write_replace(df, "t_raw.x")
    write_overwrite(scan_table(spark, "t_raw", "x").withColumn("k", F.col("k") + 1), "t_raw.x")
    assert scan_table(spark, "t_raw", "x").first().k == 2
    with pytest.raises(ValueError, match="schema"):
        write_overwrite(spark.createDataFrame([(1,)], "k int"), "t_raw.x")
    write_replace(spark.createDataFrame([(1,)], "k int"), "t_raw.x")
    assert scan_table(spark, "t_raw", "x").columns == ["k"]


def test_a_failed_write_leaves_the_old_table(spark, tmp):
    import os

    ensure_zone(spark, "t_safe", f"{tmp}/it's safe")
    write_replace(spark.createDataFrame([(1, "a")], "k int, v string"), "t_safe.x")
    bad = scan_table(spark, "t_safe", "x").withColumn("k", F.raise_error("no").cast("int"))
    for write in (write_replace, write_overwrite):
        with pytest.raises(Exception, match="no"):
            write(bad, "t_safe.x")
        assert [tuple(r) for r in scan_table(spark, "t_safe", "x").collect()] == [(1, "a")]
    write_replace(scan_table(spark, "t_safe", "x").union(scan_table(spark, "t_safe", "x")), "t_safe.x")
    assert scan_table(spark, "t_safe", "x").count() == 2
    assert [t.name for t in spark.catalog.listTables("t_safe")] == ["x"]
    folders = lambda: [d for d in os.listdir(f"{tmp}/it's safe") if d.startswith("x")]
    assert len(folders()) == 2  # the failed writes left nothing, the replaced version stays until a vacuum
    assert len(vacuum(spark, "t_safe.x")) == 1 and len(folders()) == 1
    assert scan_table(spark, "t_safe", "x").count() == 2


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("read", [lambda s, z, t: scan_table(s, z, t), lambda s, z, t: s.table(f"{z}.{t}"),
                                  lambda s, z, t: s.sql(f"SELECT * FROM {z}.{t}").where("pickup_year IS NOT NULL OR v > 0")])
def test_held_frames_keep_their_version(spark, tmp, read):
    """Frames made before S3, S4 and S6 give their old rows until a vacuum, then fail."""
    zone = f"t_held_{abs(hash(tmp)) % 10**9}"
    ensure_zone(spark, zone, f"{tmp}/held")
    name = f"{zone}.t"
    frame = lambda *data: spark.createDataFrame(list(data), "v int, pickup_year int, pickup_month int")
    steps = [
        (write_partitioned, frame(*[(i, 2015, i % 3) for i in range(6)])),
        (write_partitioned, frame((10, 2015, 1), (11, 2016, 2), (12, 2015, 2))),  # the same layout
        (write_overwrite, frame((20, 2015, 1), (21, None, None))),
        (write_replace, frame((30, 1, 1))),  # no layout any more
        (write_overwrite, frame((40, 1, 1))),
        (write_partitioned, frame((50, 2015, 1))),
        (write_replace, spark.createDataFrame([("x", 1, 2)], "other string, v int, pickup_year int")),
    ]
    held = []
    for write, df in steps:
        write(df, name)
        held.append((read(spark, zone, "t"), rows(df)))
        for old, expected in held:
            assert rows(old) == expected and old.count() == len(expected)
    assert len(versions(spark, name)) == len(steps) and [v["current"] for v in versions(spark, name)] == [True] + [False] * 6
    vacuum(spark, name)
    assert rows(held[-1][0]) == held[-1][1]
    for old, _ in held[:-1]:
        with pytest.raises(Exception):
            old.collect()


def test_overwrite_keeps_layout_and_comments(spark, tmp):
    ensure_zone(spark, "t_keep", f"{tmp}/keep")
    write_partitioned(spark.createDataFrame([(1, 2015, 1)], "v int, pickup_year int, pickup_month int"), "t_keep.t")
    spark.sql("COMMENT ON TABLE t_keep.t IS 'it''s trips'")
    spark.sql("ALTER TABLE t_keep.t ALTER COLUMN v COMMENT 'value'")

    def said():
        return spark.catalog.getTable("t_keep.t").description, {c.name: c.description for c in spark.catalog.listColumns("t_keep.t")}["v"]

    assert said() == ("it's trips", "value")
    write_overwrite(spark.createDataFrame([(1, 2, 3), (1, 5, 6)], "pickup_month int, V int, pickup_year int"), "t_keep.t")
    assert partition_columns(spark, "t_keep.t") == ["pickup_year", "pickup_month"] and said() == ("it's trips", "value")
    assert rows(spark.table("t_keep.t")) == [(2, 3, 1), (5, 6, 1)]
    assert scan_table(spark, "t_keep", "t").columns == ["v", "pickup_year", "pickup_month"]
    # another layout, another schema: what stays keeps its comment
    write_partitioned(spark.createDataFrame([(1, 2015, "n")], "v int, pickup_year int, extra string"), "t_keep.t", ["pickup_year"])
    assert partition_columns(spark, "t_keep.t") == ["pickup_year"] and said() == ("it's trips", "value")
    write_replace(spark.createDataFrame([(1.5,)], "v double"), "t_keep.t")
    assert partition_columns(spark, "t_keep.t") == [] and said() == ("it's trips", "value")


def test_versions_are_listed_read_and_restored(spark, tmp):
    from datetime import timedelta

    ensure_zone(spark, "t_travel", f"{tmp}/a 100% zone")
    write_partitioned(spark.createDataFrame([(1, 2015, 1), (2, None, None)], "v int, pickup_year int, pickup_month int"), "t_travel.t")
    write_replace(spark.createDataFrame([("a",)], "s string"), "t_travel.t")
    write_replace(spark.createDataFrame([("b",)], "s string"), "t_travel.t")
    third, second, first = versions(spark, "t_travel.t")
    assert third["current"] and not second["current"] and first["written"] <= second["written"]
    assert rows(scan_version(spark, "t_travel.t", first["version"])) == [(1, 2015, 1), (2, None, None)]
    restore_version(spark, "t_travel.t", second["version"])
    assert rows(spark.table("t_travel.t")) == [("a",)]
    restore_version(spark, "t_travel.t", first["version"])
    assert partition_columns(spark, "t_travel.t") == ["pickup_year", "pickup_month"]
    assert rows(spark.table("t_travel.t").where("pickup_year = 2015")) == [(1, 2015, 1)]
    assert vacuum(spark, "t_travel.t", older_than=timedelta(days=1)) == []
    assert vacuum(spark, "t_travel.t", keep=1) == [second["version"]]  # the newest other one is kept
    with pytest.raises(KeyError):
        scan_version(spark, "t_travel.t", second["version"])
    # a table that something else made becomes versioned at its first replacement
    spark.sql("CREATE TABLE t_travel.plain USING parquet PARTITIONED BY (k) AS SELECT 1 AS v, 2 AS k")
    write_overwrite(spark.createDataFrame([(5, 6)], "v int, k int"), "t_travel.plain")
    held = spark.table("t_travel.plain")
    assert partition_columns(spark, "t_travel.plain") == ["k"] and rows(held) == [(5, 6)]
    write_overwrite(held.selectExpr("v + 1 AS v", "k"), "t_travel.plain")
    assert rows(held) == [(5, 6)] and rows(spark.table("t_travel.plain")) == [(6, 6)]


def test_append_to_a_table_adds_columns(spark, tmp):
    from tidewater.sources.tables import append_table, write_partitioned

    ensure_zone(spark, "t_append", f"{tmp}/append")
    write_replace(spark.createDataFrame([("1", "x")], "vendor_id string, Surcharge string"), "t_append.a")
    append_table(spark.createDataFrame([("0.3", "y", 5)], "`new col` string, surcharge string, n int"), "t_append.a")
    got = sorted((tuple(r) for r in scan_table(spark, "t_append", "a").collect()), key=str)
    assert scan_table(spark, "t_append", "a").columns == ["vendor_id", "Surcharge", "new col", "n"]
    assert got == [("1", "x", None, None), (None, "y", "0.3", 5)]
    with pytest.raises(ValueError, match="types"):
        append_table(spark.createDataFrame([(1,)], "vendor_id int"), "t_append.a")
    write_partitioned(spark.createDataFrame([(1, 2015, 1)], "v int, pickup_year int, pickup_month int"), "t_append.p")
    append_table(spark.createDataFrame([(2, 2016, 2, "w")], "v int, pickup_year int, pickup_month int, extra string"), "t_append.p")
    assert sorted((r.v, r.extra, r.pickup_year) for r in scan_table(spark, "t_append", "p").collect()) == [(1, None, 2015), (2, "w", 2016)]


def test_append_raises_what_is_not_a_missing_folder(spark, tmp):
    import os

    path = f"{tmp}/broken"
    os.makedirs(path)
    with open(f"{path}/part-0.parquet", "w") as f:
        f.write("no parquet")
    with pytest.raises(Exception):
        append_evolve(spark.createDataFrame([("1",)], "a string"), path)


def test_append_evolve_adds_columns(spark, tmp):
    path = f"{tmp}/merged"
    a = spark.createDataFrame([("1", "x")], "vendor_id string, Surcharge string")
    b = spark.createDataFrame([("2", "0.3", "y")], "vendor_id string, improvement_surcharge string, surcharge string")
    append_evolve(a, path)
    append_evolve(b, path)
    back = read_evolved(spark, path, order=a.columns)
    assert back.columns == ["vendor_id", "Surcharge", "improvement_surcharge"]
    rows = sorted(back.collect())
    assert rows[0].improvement_surcharge is None and rows[1].Surcharge == "y"


def test_an_append_to_a_folder_opens_no_data_file(spark, tmp):
    import glob
    import os

    path = f"{tmp}/noted"
    append_evolve(spark.createDataFrame([("1", "x")], "a string, B string"), path)
    for file in glob.glob(f"{path}/*.parquet"):
        os.rename(file, f"{file}.away")
        with open(file, "w") as f:
            f.write("no parquet at all")  # reading it would fail
    append_evolve(spark.createDataFrame([("y", 2, "2")], "b string, c int, a string"), path)
    with pytest.raises(ValueError, match="other types"):
        append_evolve(spark.createDataFrame([(1,)], "A int"), path)
    for file in glob.glob(f"{path}/*.away"):
        os.replace(file, file[:-len(".away")])
    back = read_evolved(spark, path)
    assert back.columns == ["a", "B", "c"] and rows(back) == [("1", "x", None), ("2", "y", 2)]
    assert back.schema["c"].dataType.simpleString() == "int"
    # files of another tool are asked for their columns once
    other = f"{tmp}/other"
    spark.createDataFrame([("1",)], "Old string").write.parquet(other)
    append_evolve(spark.createDataFrame([("2", "n")], "old string, new string"), other)
    assert rows(read_evolved(spark, other)) == [("1", None), ("2", "n")] and read_evolved(spark, other).columns == ["Old", "new"]


def test_hot_month_is_split_across_files(spark, tmp):
    """A third of all rows in one (year, month): the rebalanced write spreads that
    partition over several tasks (files) instead of one."""
    import glob

    from tidewater.sources.tables import table_location

    ensure_zone(spark, "t_hot", f"{tmp}/hot")
    df = spark.range(0, 90000).select(
        F.when(F.col("id") < 30000, F.lit(2015)).otherwise((F.col("id") % 7 + 2008).cast("int")).alias("pickup_year"),
        F.when(F.col("id") < 30000, F.lit(1)).otherwise((F.col("id") % 12 + 1).cast("int")).alias("pickup_month"),
        F.col("id"), F.sha2(F.col("id").cast("string"), 256).alias("payload"))
    keys = ("spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.adaptive.coalescePartitions.minPartitionSize")
    old = {k: spark.conf.get(k, None) for k in keys}
    spark.conf.set(keys[0], "256k")
    spark.conf.set(keys[1], "64k")
    try:
        write_partitioned(df.repartition(8), "t_hot.t")
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    hot_files = glob.glob(f"{table_location(spark, 't_hot.t')}/pickup_year=2015/pickup_month=1/*.parquet")
    assert len(hot_files) > 1
    back = scan_table(spark, "t_hot", "t")
    assert back.count() == 90000
    assert back.where("pickup_year = 2015 AND pickup_month = 1").count() >= 30000


class _Conf:
    def __init__(self, values):
        self.values = values

    def get(self, key, default=None):
        return self.values.get(key, default)

    def set(self, key, value):  # a running session refuses core settings
        raise RuntimeError("CANNOT_MODIFY_CONFIG")


class _Context:
    def __init__(self):
        self.dir = None

    def getCheckpointDir(self):
        return self.dir

    def setCheckpointDir(self, d):
        self.dir = d


class _Session:
    def __init__(self, master, ckpt=None):
        self.conf = _Conf({"spark.master": master, **({"spark.checkpoint.dir": ckpt} if ckpt else {})})
        self.sparkContext = _Context()


def test_scratch_root_reads_the_session_setting():
    from tidewater.session import scratch_root

    s = _Session("spark://cluster:7077", "hdfs://nn/shared/ckpt/")
    assert scratch_root(s) == "hdfs://nn/shared/ckpt"


def test_scratch_root_unset_local_registers_own_folder_unset_cluster_raises():
    import pytest

    from tidewater.session import scratch_root

    local = _Session("local[2]")
    root = scratch_root(local)
    assert root and local.sparkContext.dir == root and scratch_root(local) == root
    for master in ("yarn", "local-cluster[2,1,1024]"):
        with pytest.raises(RuntimeError):
            scratch_root(_Session(master))


def test_clear_scratch_leaves_other_applications_alone(spark, tmp):
    import os
    import uuid

    from tidewater import session

    own = session.pinned(spark.range(5), "own")
    assert own.count() == 5
    root = session.app_folder(spark).replace("file:", "")
    other = os.path.join(os.path.dirname(root), f"another-{uuid.uuid4().hex}", "pinned-1")
    os.makedirs(other)
    session.clear_scratch(spark)
    assert os.path.isdir(other) and not os.path.exists(root)
