import pytest
from pyspark.sql import functions as F

from tidewater.functions.columns import (
    INGEST_RENAMES,
    canonical_case,
    copy_column,
    project,
    tag_source,
    drop_columns,
    numeric_columns,
    rename_if_present,
    surcharge_fold,
)


def test_rename_case_insensitive_and_noop(spark):
    df = spark.createDataFrame([("a", "b", "c")], ["LPEP_PICKUP_DATETIME", "Trip_type ", "other"])
    out = rename_if_present(df, INGEST_RENAMES)
    assert out.columns == ["pickup_datetime", "trip_type", "other"]


def test_rename_collision_raises(spark):
    df = spark.createDataFrame([("a", "b")], ["lpep_pickup_datetime", "tpep_pickup_datetime"])
    with pytest.raises(ValueError, match="collision"):
        rename_if_present(df, INGEST_RENAMES)


def test_canonical_case_keeps_positions(spark):
    df = spark.createDataFrame([(1, 2)], ["Fare_amount", "x"])
    assert canonical_case(df, ["fare_amount"]).columns == ["fare_amount", "x"]


def test_numeric_columns_like_pandas(spark):
    df = spark.sql("""SELECT 1 AS i, CAST(NULL AS INT) AS all_null, CAST(1.5 AS DECIMAL(5,2)) AS d,
                      true AS b, current_timestamp() AS t, CAST(1.5 AS FLOAT) AS f, 'x' AS s, 2L AS l""")
    assert numeric_columns(df) == ["i", "all_null", "f", "l"]


def test_surcharge_fold_policies(spark):
    df = spark.createDataFrame([(None, "0.3"), ("0.5", None)], "surcharge string, improvement_surcharge string")
    rep = [r[0] for r in df.select(surcharge_fold(df, "replace")).collect()]
    coa = [r[0] for r in df.select(surcharge_fold(df, "coalesce")).collect()]
    assert rep[0] is None and rep[1] == 0.5
    assert abs(coa[0] - 0.3) < 1e-6 and coa[1] == 0.5


def test_drop_columns_missing_ok(spark):
    df = spark.createDataFrame([(1, 2)], ["Surcharge", "x"])
    assert drop_columns(df, "surcharge", "nope").columns == ["x"]


def test_tag_copy_and_project(spark):
    df = spark.createDataFrame([("1.5", "2014-03-04 05:06:07", "N")], ["RateCodeID", "pickup_datetime", "rate_code"])
    out = copy_column(tag_source(df, "green"), "rate_code", "rate_code_id")
    assert out.first().data_source == "green" and out.first().rate_code_id == "N"
    typed = project(df, [("rate_code_id", "RateCodeID", "int"), ("y", None, "year:pickup_datetime"),
                         ("m", None, "month:pickup_datetime"), ("src", None, "lit:yellow")])
    assert tuple(typed.first()) == (1, 2014, 3, "yellow")
