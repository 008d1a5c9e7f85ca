import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidewater.operators.profile import cap_rows, column_profile


def _pandas_stats(s: pd.Series):
    s = s.dropna().astype(float)
    return {
        "count": len(s), "n_distinct": s.nunique(), "mean": s.mean(), "stddev": s.std(), "variance": s.var(),
        "skewness": s.skew(), "kurtosis": s.kurt(), "min": s.min(), "max": s.max(), "sum": s.sum(),
        **{k: s.quantile(q) for k, q in {"q05": .05, "q25": .25, "q50": .5, "q75": .75, "q95": .95}.items()},
    }


def test_profile_matches_pandas_with_hot_value(spark):
    rng = np.random.default_rng(7)
    n = 3000
    x = rng.normal(50, 10, n).round(2)
    x[: n // 3] = 7.0  # a third of the rows hold one value
    y = rng.integers(-5, 5, n).astype(float)
    y[::10] = np.nan
    pdf = pd.DataFrame({"x": x, "y": y, "s": ["a"] * n})
    df = spark.createDataFrame(pdf).repartition(5)
    prof = {r.column_name: r.asDict() for r in column_profile(df, n=None, digits=None).collect()}
    assert set(prof) == {"x", "y"}
    for c in ("x", "y"):
        want = _pandas_stats(pdf[c])
        got = prof[c]
        for k, v in want.items():
            assert got[k] == pytest.approx(v, rel=1e-9, abs=1e-9), (c, k)
    assert prof["y"]["n_missing"] == pdf["y"].isna().sum()
    assert prof["y"]["n_zeros"] == int((pdf["y"] == 0).sum())
    assert prof["y"]["n_negative"] == int((pdf["y"] < 0).sum())


def test_profile_edge_columns(spark):
    df = spark.sql("SELECT 5 AS const, CAST(NULL AS INT) AS nothing, 'x' AS s FROM range(10)")
    prof = {r.column_name: r for r in column_profile(df, n=None).collect()}
    assert prof["const"].skewness == 0.0 and prof["const"].kurtosis == 0.0 and prof["const"].n_distinct == 1
    assert prof["nothing"]["count"] == 0 and prof["nothing"].n_missing == 10 and prof["nothing"].q50 is None


def test_no_numeric_columns_is_empty(spark):
    df = spark.createDataFrame([("a",)], "s string")
    assert column_profile(df).count() == 0


def test_cap_and_approx(spark):
    df = spark.range(0, 20000).select((F.col("id") % 1000).alias("v"))
    capped = column_profile(df, n=500).first()
    assert capped["count"] == 500
    assert cap_rows(df, 123).count() == 123
    approx = column_profile(df, n=None, approx=True).first()
    assert approx["count"] == 20000 and abs(approx["n_distinct"] - 1000) < 50
    assert abs(approx["q50"] - 499.5) < 5


def test_capped_path_equals_distributed_path(spark):
    rng = np.random.default_rng(11)
    pdf = pd.DataFrame({"a": rng.integers(0, 50, 2000).astype(float), "b": rng.normal(0, 1, 2000)})
    pdf.loc[::7, "b"] = np.nan
    df = spark.createDataFrame(pdf).repartition(4)
    capped = {r.column_name: r.asDict() for r in column_profile(df, n=100000).collect()}
    whole = {r.column_name: r.asDict() for r in column_profile(df, n=None).collect()}
    assert capped.keys() == whole.keys()
    for c in capped:
        for k, v in whole[c].items():
            if isinstance(v, str) or v is None:
                assert capped[c][k] == v
            else:
                assert capped[c][k] == pytest.approx(v, rel=1e-9, abs=1e-12), (c, k)


def _profile(df, **kw):
    return {r.column_name: r.asDict() for r in column_profile(df, **kw).collect()}


def test_profile_rests_on_no_plan_property(spark):
    """Equal results with exchange reuse and adaptive execution on and off."""
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame({"x": np.r_[np.full(800, 123.0), rng.integers(0, 400, 1600)], "y": rng.normal(0, 1, 2400)})
    df = spark.createDataFrame(pdf).repartition(3)
    keys = ("spark.sql.exchange.reuse", "spark.sql.adaptive.enabled")
    old = {k: spark.conf.get(k) for k in keys}
    found = []
    try:
        for values in (("true", "true"), ("false", "true"), ("true", "false"), ("false", "false")):
            for k, v in zip(keys, values):
                spark.conf.set(k, v)
            found.append(_profile(df))
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    for c in pdf.columns:
        want = _pandas_stats(pdf[c])
        for got in found:
            for k in ("n_distinct", "q05", "q25", "q50", "q75", "q95"):
                assert got[c][k] == pytest.approx(want[k], rel=1e-12, abs=1e-12), (c, k)


def test_whole_numbers_stay_exact_and_infinities_show(spark):
    rows = [(12345678901, 1.0), (12345678902, float("inf")), (2**53, 2.0), (2**53 + 1, None), (2**53 + 1, float("-inf"))]
    got = _profile(spark.createDataFrame(rows, "k long, f double"))
    assert got["k"]["n_distinct"] == 4 and got["k"]["min"] == 12345678901.0
    assert (got["k"]["min_int"], got["k"]["max_int"]) == (12345678901, 2**53 + 1)
    assert got["f"]["max"] == float("inf") and got["f"]["min"] == float("-inf") and got["f"]["n_distinct"] == 4
    assert got["f"]["min_int"] is None and got["f"]["n_missing"] == 1


def test_defaults_neither_cap_nor_round(spark):
    df = spark.range(0, 150_000).select((F.col("id") + 0.123456789012).alias("v"))
    got = column_profile(df).first()
    assert got["count"] == 150_000 and got["min"] == 0.123456789012


def test_capped_tables_pinned_together(spark):
    from tidewater.operators.profile import profile_tables

    a = spark.range(0, 3000, numPartitions=4).select((F.col("id") % 97).alias("x"), F.lit("s").alias("s"))
    b = spark.range(0, 1000, numPartitions=3).select((F.col("id") * 0.5).alias("y"), (F.col("id") % 3).alias("z"))
    tables = {"a": a, "b": b}
    key = lambda r: (r["table_name"], r["column_name"])
    capped = {key(r): r.asDict() for r in profile_tables(tables, n=100000).collect()}
    whole = {key(r): r.asDict() for r in profile_tables(tables, n=None).collect()}
    assert capped.keys() == whole.keys() == {("a", "x"), ("b", "y"), ("b", "z")}
    for k in whole:
        for stat, v in whole[k].items():
            if isinstance(v, str) or v is None:
                assert capped[k][stat] == v
            else:
                assert capped[k][stat] == pytest.approx(v, rel=1e-9, abs=1e-12), (k, stat)
    small = profile_tables(tables, n=250).collect()
    assert {key(r): r["count"] for r in small} == {("a", "x"): 250, ("b", "y"): 250, ("b", "z"): 250}


def test_write_profile_only_with_numeric_columns(spark, tmp):
    import os

    from tidewater.sources.files import write_profile

    none_path, some_path = os.path.join(tmp, "none"), os.path.join(tmp, "some")
    assert write_profile(column_profile(spark.createDataFrame([("a",)], "s string")), none_path) is False
    assert not os.path.exists(none_path)
    df = spark.range(0, 50).select((F.col("id") % 7).alias("v"), F.lit("x").alias("s"))
    assert write_profile(column_profile(df, n=None), some_path) is True
    back = spark.read.json(some_path).collect()
    assert [(r.column_name, r["count"], r.n_distinct) for r in back] == [("v", 50, 7)]


def test_exact_quantiles_property(spark):
    from hypothesis import HealthCheck, given, settings
    from hypothesis import strategies as st

    values = st.one_of(st.integers(-20, 20).map(float), st.sampled_from([0.0, -0.0, float("nan"), 1e9, -1e-9]))

    @settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
    @given(st.lists(values, min_size=1, max_size=300), st.integers(1, 5))
    def check(xs, parts):
        pdf = pd.DataFrame({"x": xs})
        df = spark.createDataFrame(pdf, "x double").repartition(parts)
        got = column_profile(df, n=None, digits=None).first().asDict()
        s = pdf["x"].dropna()
        assert got["count"] == len(s) and got["n_missing"] == len(xs) - len(s)
        assert got["n_distinct"] == s.nunique()
        for k, q in {"q05": .05, "q25": .25, "q50": .5, "q75": .75, "q95": .95}.items():
            if len(s):
                assert got[k] == pytest.approx(s.quantile(q), rel=1e-12, abs=1e-12), k
            else:
                assert got[k] is None

    check()


def test_zone_profiles_share_scans(spark, tmp, monkeypatch):
    from tidewater.operators import profile
    from tidewater.sources.tables import ensure_zone, write_partitioned, write_replace

    ensure_zone(spark, "t_prof_many", f"{tmp}/a b/many")
    for i in range(6):
        df = spark.range(0, 300 + i).select((F.col("id") % (7 + i)).alias("x"), (F.col("id") * 0.25 * i).alias("Y" if i % 2 else "y"),
                                            F.lit("s").alias("s"))
        write_replace(df, f"t_prof_many.plain_{i}")
        write_partitioned(df.withColumn("k", (F.col("x") % 3).cast("int")), f"t_prof_many.parted_{i}", ["k"])
    write_replace(spark.range(10), "t_prof_many.alone")
    write_replace(spark.range(10).select(F.lit("t").alias("t")), "t_prof_many.text")
    seen = []
    monkeypatch.setattr(profile, "_exact_stats", lambda long, f=profile._exact_stats: seen.append(long) or f(long))
    got = {(r.table_name, r.column_name): r.asDict() for r in profile.schema_profile(spark, "t_prof_many").collect()}
    plan = seen[0]._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation") == 3  # plain ones, partitioned ones, the one alone
    tables = {t.name: spark.table(f"t_prof_many.{t.name}") for t in spark.catalog.listTables("t_prof_many")}
    expected = {(r.table_name, r.column_name): r.asDict() for r in profile.profile_tables(tables).collect()}
    assert got.keys() == expected.keys() and len(got) == 6 * 2 + 6 * 3 + 1
    for k in expected:
        for stat, v in expected[k].items():
            assert got[k][stat] == (pytest.approx(v, rel=1e-12, abs=1e-12) if isinstance(v, float) else v), (k, stat)


@pytest.mark.parametrize("few", [1, 3, 1 << 16])
def test_radix_selection_of_extreme_values(spark, few):
    """All passes, down to single values: subnormals, infinities, both zeros, ends of the long range."""
    import struct

    from tidewater.operators.profile import _exact_stats, _long_form, _with_image

    rng = np.random.default_rng(5)
    wide = [struct.unpack("<d", rng.bytes(8))[0] for _ in range(400)]
    doubles = [x for x in wide if x == x] + [0.0, -0.0, 5e-324, -5e-324, 2.0**-1022, 2.0**-1022 - 5e-324, 1.7976931348623157e308,
                                             float("inf"), -float("inf"), 2.0, float(np.nextafter(2.0, 0)), float(np.nextafter(2.0, 3)), 8.0, 1e22] * 2
    longs = [int(x) for x in rng.integers(-2**63, 2**63 - 1, 300)] + [-2**63, 2**63 - 1, 0, 1, -1] * 3
    rows = [(longs[i % len(longs)] if i < len(longs) else None, doubles[i] if i < len(doubles) else None) for i in range(max(len(longs), len(doubles)))]
    df = spark.createDataFrame(rows, "k long, f double").repartition(4)
    images = sorted((r.d, r.image) for r in _with_image(df.select(F.lit(None).cast("long").alias("i"), F.col("f").alias("d")).where("d IS NOT NULL")).collect())
    bits = lambda x: struct.unpack("<q", struct.pack("<d", abs(x)))[0] * (-1 if x < 0 else 1)
    assert all(image == bits(x) for x, image in images)
    got = {r.col_idx: r for r in _exact_stats(_long_form(df, ["k", "f"]), few=few).collect()}
    for idx, values in ((0, longs), (1, doubles)):
        ordered = sorted(values)
        for name, q in {"q05": .05, "q25": .25, "q50": .5, "q75": .75, "q95": .95}.items():
            pos = q * (len(ordered) - 1)
            lo, hi = float(ordered[int(np.floor(pos))]), float(ordered[int(np.ceil(pos))])
            assert got[idx][name] == (lo if lo == hi else lo + (pos - np.floor(pos)) * (hi - lo)), (idx, name)
