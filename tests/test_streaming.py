import os

from tidewater.streaming.ingest import ingest_new_files


def test_incremental_ingest_takes_only_new_files(spark, tmp):
    land = os.path.join(tmp, "landing")
    os.makedirs(land)
    header = ["VendorID", "lpep_pickup_datetime", "Trip_type "]
    with open(os.path.join(land, "a.csv"), "w") as f:
        f.write("VendorID,lpep_pickup_datetime,Trip_type \n1,2014-01-01 00:00:00,1\n")
    target, ckpt = os.path.join(tmp, "raw"), os.path.join(tmp, "ckpt")
    ingest_new_files(spark, land, header, target, ckpt).awaitTermination()
    assert spark.read.parquet(target).count() == 1
    with open(os.path.join(land, "b.csv"), "w") as f:
        f.write("VendorID,lpep_pickup_datetime,Trip_type \n2,2014-02-01 00:00:00,2\n3,,1\n")
    ingest_new_files(spark, land, header, target, ckpt).awaitTermination()
    back = spark.read.parquet(target)
    assert back.count() == 3
    assert back.columns == ["VendorID", "pickup_datetime", "trip_type"]


def test_a_file_with_another_header_fails_the_batch(spark, tmp):
    import pytest

    land = os.path.join(tmp, "landing")
    os.makedirs(land)
    with open(os.path.join(land, "a.csv"), "w") as f:
        f.write("lpep_pickup_datetime,VendorID,Trip_type \n2014-01-01 00:00:00,1,1\n")
    query = ingest_new_files(spark, land, ["VendorID", "lpep_pickup_datetime", "Trip_type "], f"{tmp}/raw", f"{tmp}/ckpt")
    with pytest.raises(Exception):
        query.awaitTermination()
