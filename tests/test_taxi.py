import glob
import os

from pyspark.sql import functions as F

from tidewater.operators.merge import merge_eras, union_sources
from tidewater.plans import registry, taxi
from tidewater.plans.standins import standin
from tidewater.sources.files import scan_csv
from tidewater.sources.tables import OPEN_FILES, ensure_zone, write_partitioned, write_replace

from conftest import SMALL


def _green(spark):
    return merge_eras(taxi.raw_fix(standin(spark, SMALL, "g1")), taxi.raw_fix(standin(spark, SMALL, "g2")))


def _yellow(spark):
    from tidewater.functions.columns import YELLOW_LATE_RENAMES, rename_if_present

    y2 = rename_if_present(taxi.raw_fix(standin(spark, SMALL, "y2")), YELLOW_LATE_RENAMES)
    return merge_eras(taxi.raw_fix(standin(spark, SMALL, "y1")), y2)


def test_merge_eras_properties(spark):
    g1, g2 = taxi.raw_fix(standin(spark, SMALL, "g1")), taxi.raw_fix(standin(spark, SMALL, "g2"))
    m = merge_eras(g1, g2)
    assert m.count() == g1.count() + g2.count()
    assert {c.lower() for c in m.columns} == {c.lower() for c in g1.columns} | {c.lower() for c in g2.columns}
    assert m.columns[: len(g1.columns)] == g1.columns


def test_merge_eras_first_spelling_wins(spark):
    a = spark.createDataFrame([(1,)], ["Fare"])
    b = spark.createDataFrame([(2, 3)], ["fare", "new"])
    m = merge_eras(a, b)
    assert m.columns == ["Fare", "new"]
    assert sorted(r.Fare for r in m.collect()) == [1, 2]


def test_clean_green_24_columns(spark):
    out = taxi.clean_green(_green(spark))
    assert out.columns == [c for c, _, _ in taxi.GREEN_CLEAN_SPEC]
    types = dict(out.dtypes)
    assert types["pickup_datetime"] == "timestamp" and types["rate_code_id"] == "int"
    assert types["fare_amount"] == "float" and types["pickup_year"] == "int"
    # the planted bad pickups become NULL, not errors
    assert out.where(F.col("pickup_datetime").isNull()).count() > 0


def test_clean_yellow_keeps_rate_code_and_folds_surcharge(spark):
    out = taxi.clean_yellow(_yellow(spark))
    assert "surcharge" not in out.columns and "rate_code" in out.columns
    assert dict(out.dtypes)["rate_code_id"] == "string"
    # y2 rows carry improvement_surcharge '0.3' but no surcharge: the fold makes them NULL
    late = out.where(F.col("pickup_year") >= 1998)
    assert late.count() > 0 and late.where(F.col("improvement_surcharge").isNotNull()).count() == 0
    kept = taxi.clean_yellow(_yellow(spark), surcharge="coalesce").where(F.col("pickup_year") >= 1998)
    assert kept.where(F.col("improvement_surcharge").isNull()).count() == 0


def test_processed_union(spark):
    g, y = taxi.clean_green(_green(spark)), taxi.clean_yellow(_yellow(spark))
    p = taxi.processed(g, y)
    assert p.count() == g.count() + y.count()
    assert dict(p.dtypes)["rate_code_id"] == "string"
    assert p.where(F.col("data_source").isNull()).count() == y.count()
    assert p.where(F.col("rate_code").isNull()).count() >= g.count()
    tagged = union_sources(g, y, tag_yellow=True)
    assert tagged.where(F.col("data_source") == "yellow").count() == y.count()


def _clean_tables(spark, zone, tmp):
    ensure_zone(spark, zone, f"{tmp}/{zone}")
    green, yellow = standin(spark, SMALL, "g2"), standin(spark, SMALL, "y1")
    write_partitioned(taxi.clean_green(taxi.raw_fix(green)), f"{zone}.green_clean")
    write_partitioned(taxi.clean_yellow(taxi.raw_fix(yellow)), f"{zone}.yellow_clean")


def test_processed_is_written_without_a_sort(spark, tmp, monkeypatch):
    # by default Spark sorts a task's rows by the layout, which spills
    _clean_tables(spark, "unsorted", tmp)
    seen = []

    def write(df, *args, **more):
        seen.append((df.sparkSession.conf.get("spark.sql.maxConcurrentOutputFileWriters"),
                     df.sparkSession.conf.get("spark.sql.session.timeZone")))
        write_partitioned(df, *args, **more)

    monkeypatch.setattr(taxi, "write_partitioned", write)
    zone, before = spark.conf.get("spark.sql.session.timeZone"), spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        taxi.load_processed(spark, "unsorted", "unsorted")
        held = spark.table("unsorted.nyc_taxi_dataset")
        n = held.count()
        taxi.load_processed(spark, "unsorted", "unsorted", tag_yellow=True)  # replaced: the caller's name shows the new rows
        now = spark.table("unsorted.nyc_taxi_dataset")
        assert seen == [(str(OPEN_FILES), "Asia/Tokyo")] * 2  # the caller's settings go along
        assert n == now.count() == spark.table("unsorted.green_clean").count() + spark.table("unsorted.yellow_clean").count()
        assert held.where("data_source IS NULL").count() and not now.where("data_source IS NULL").count()
        want = taxi.processed(spark.table("unsorted.green_clean"), spark.table("unsorted.yellow_clean"), tag_yellow=True)
        assert not now.exceptAll(want.select(now.columns)).count()
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == before


def test_more_months_than_open_files(spark, tmp):
    # beyond the limit Spark sorts the rest: no row is lost, no month doubled
    _clean_tables(spark, "few_files", tmp)
    spark.conf.set("spark.sql.maxConcurrentOutputFileWriters", "2")
    try:
        taxi.load_processed(spark, "few_files", "few_files")
    finally:
        spark.conf.unset("spark.sql.maxConcurrentOutputFileWriters")
    got = spark.table("few_files.nyc_taxi_dataset")
    want = taxi.processed(spark.table("few_files.green_clean"), spark.table("few_files.yellow_clean")).select(got.columns)
    assert got.count() == want.count() and not got.exceptAll(want).count()


def test_gzipped_landing_files_hold_the_same_rows(spark, tmp, monkeypatch):
    monkeypatch.setattr(registry, "LANDING_ROWS", 500)
    plain = registry.write_standin_csv(spark, SMALL, "g1", f"{tmp}/plain")
    packed = registry.write_standin_csv(spark, SMALL, "g1", f"{tmp}/packed", compression="gzip")
    files = glob.glob(f"{packed}/*.csv.gz")
    assert len(files) > 1
    assert sum(map(os.path.getsize, files)) < 0.5 * sum(map(os.path.getsize, glob.glob(f"{plain}/*.csv")))
    a, b = scan_csv(spark, plain), scan_csv(spark, packed)
    assert a.columns == b.columns and a.count() == b.count() and not a.exceptAll(b).count()


def test_zone_tables_are_compressed_by_zstd_unless_the_session_says(spark, tmp):
    import pyarrow.parquet as pq

    ensure_zone(spark, "codecs", f"{tmp}/codecs")

    def codec():
        write_replace(spark.range(10), "codecs.t")
        files = spark.table("codecs.t").inputFiles()
        return pq.ParquetFile(files[0].removeprefix("file://")).metadata.row_group(0).column(0).compression

    assert codec() == "ZSTD"
    spark.conf.set("spark.sql.parquet.compression.codec", "snappy")
    try:
        assert codec() == "SNAPPY"
    finally:
        spark.conf.unset("spark.sql.parquet.compression.codec")
