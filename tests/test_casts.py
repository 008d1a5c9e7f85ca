from datetime import datetime

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.functions.casts import partition_label, to_float_lenient, to_int_lenient, to_ts_lenient, value_text


def test_int_lenient_matches_old_cast(spark):
    vals = ["1", "1.5", "-1.9", " 3 ", "CRD", "", "1e3", "2147483648", None]
    df = spark.createDataFrame([(v,) for v in vals], "s string")
    got = [r[0] for r in df.select(to_int_lenient("s")).collect()]
    assert got == [1, 1, -1, 3, None, None, None, None, None]


def test_float_lenient_never_raises(spark):
    df = spark.createDataFrame([("1.25",), ("x",), ("",), ("1e3",), (None,)], "s string")
    got = [r[0] for r in df.select(to_float_lenient("s")).collect()]
    assert got == [1.25, None, None, 1000.0, None]
    assert dict(df.select(to_float_lenient("s").alias("f")).dtypes)["f"] == "float"


def test_ts_lenient(spark):
    df = spark.createDataFrame([("2014-01-01 00:00:00",), ("2014-01-01",), ("x",), ("",), ("2014-1-2 3:4:5",)], "s string")
    got = [r[0] for r in df.select(to_ts_lenient("s")).collect()]
    assert got == [datetime(2014, 1, 1), datetime(2014, 1, 1), None, None, datetime(2014, 1, 2, 3, 4, 5)]


def test_lenient_casts_random_text(spark):
    from hypothesis import given, settings
    from hypothesis import strategies as st

    @settings(max_examples=15, deadline=None)
    @given(st.lists(st.text(max_size=12), min_size=1, max_size=40))
    def run(texts):
        df = spark.createDataFrame([(t,) for t in texts], "s string")
        df.select(to_int_lenient("s"), to_float_lenient("s"), to_ts_lenient("s")).collect()

    run()


def test_partition_label_python_str(spark):
    ts = T.TimestampNTZType()
    df = spark.createDataFrame(
        [(datetime(2014, 1, 1, 0, 0, 0),), (datetime(2024, 1, 1, 0, 0, 7, 179500),), (None,)], "t timestamp_ntz")
    got = [r[0] for r in df.select(partition_label("t", ts)).collect()]
    assert got == ["ds=2014-01-01 00:00:00", "ds=2024-01-01 00:00:07.179500", "ds=None"]
    s = spark.createDataFrame([("9/1/2013",)], "s string")
    assert s.select(value_text(F.col("s"), T.StringType())).first()[0] == "9/1/2013"
