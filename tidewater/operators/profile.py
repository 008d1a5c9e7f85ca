"""Column profiles of numeric columns (count, moments, distinct count, quantiles).

Everything that grows with the data stays on the executors.

1. One scan: the long form ``(col_idx, i, d)`` of the numeric columns, whole numbers as
   ``i`` (bigint, exact) and the others as ``d`` (double), is aggregated to distinct
   (value, count) pairs.  Partial aggregation collapses a hot value to one row per task.
   The pairs are pinned as a table, each with an order-preserving 64-bit image of its value;
   everything else reads them.
2. One aggregation: counts, extremes and sums, one row a column.
3. Exact quantiles by radix selection: the images of a column, counted from its smallest one, are
   cut into at most 65,536 digits by their leading bits; rows are counted by digit (the central
   moments are added up on the way), and running sums over these counters tell the digit that
   holds each wanted rank (10 a column).  Where it holds over ``FEW`` distinct values, its rows
   are counted again by the next 16 bits, at most four times in all.  Only counters are shuffled.
4. The at most ``FEW`` distinct values around each wanted rank are put in order.

Exact at any size: no step sorts a share of a column.  ``approx=True`` instead takes HyperLogLog++
distinct counts and Greenwald-Khanna quantiles in a single pass.  ``n`` profiles the first
``n`` rows only (L1), if a caller asks for it.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, SparkSession, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.functions.columns import col_of, numeric_columns, quote
from tidewater.session import pinned
from tidewater.sources.catalog import table_names
from tidewater.sources.tables import partition_columns, scan_table, shared_scan, table_details, table_location, table_name

# Bits of a digit of the radix selection, and distinct values that are few enough to be ordered.
DIGIT = 16
FEW = 1 << 16

# The quantiles reported, by output column.
QUANTILES = {"q05": 0.05, "q25": 0.25, "q50": 0.5, "q75": 0.75, "q95": 0.95}

COUNT_STATS = ("count", "n_missing", "n_distinct", "n_zeros", "n_negative")
VALUE_STATS = ("min", "max", "mean", "stddev", "variance", "sum", "range", "skewness",
               "kurtosis", "cv", *QUANTILES, "iqr")

PROFILE_SCHEMA = T.StructType(
    [T.StructField("column_name", T.StringType()), T.StructField("column_position", T.IntegerType())]
    + [T.StructField(s, T.LongType()) for s in ("count", "n_missing", "n_distinct")]
    + [T.StructField(s, T.DoubleType()) for s in VALUE_STATS]
    + [T.StructField(s, T.LongType()) for s in ("n_zeros", "n_negative", "min_int", "max_int")]
)

# Decimals kept in the shape statistics (skewness, kurtosis): they are dimensionless
# and a symmetric column's skewness is cancellation noise around 0.
SHAPE_DECIMALS = 8


def cap_rows(df: DataFrame, n: int) -> DataFrame:
    """L1: the first ``n`` rows (which rows is not defined, as in the reference)."""
    return df.limit(n)


def sig_round(name: str, digits: int) -> Column:
    """Round the double column ``name`` to ``digits`` significant digits (0, NULL and
    NaN pass through).

    Computed as round(x / 10^e) * 10^e with an exact power of ten, so the result is
    the same double in any IEEE engine that rounds the mantissa the same way.  Built
    as one SQL expression (one call into the JVM, not one per operator).
    """
    x = quote(name)
    e = f"floor(log10(abs({x})))"
    return F.expr(
        f"CASE WHEN {x} = 0 THEN 0.0D WHEN {x} IS NULL OR isnan({x}) THEN {x} "
        f"WHEN {e} >= 0 THEN round({x} / power(10.0D, {e}), {digits - 1}) * power(10.0D, {e}) "
        f"ELSE round({x} * power(10.0D, -{e}), {digits - 1}) / power(10.0D, -{e}) END")


def _long_form(df: DataFrame, names: list[str], base: int | str = 0) -> DataFrame:
    """(col_idx, i, d): one row per (row, numeric column), NaN counted as missing;
    column indices start at ``base``, a number or a column of ``df``."""
    whole = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
    pairs = []
    for k, name in enumerate(names):
        x = quote(name)
        if isinstance(df.schema[name].dataType, whole):
            pairs.append(f"CAST({base} + {k} AS INT), CAST({x} AS BIGINT), CAST(NULL AS DOUBLE)")
        else:
            pairs.append(f"CAST({base} + {k} AS INT), CAST(NULL AS BIGINT), nanvl(CAST({x} AS DOUBLE), CAST(NULL AS DOUBLE))")
    return df.select(F.expr(f"stack({len(names)}, {', '.join(pairs)}) AS (col_idx, i, d)"))


def _has_value() -> Column:
    return F.col("i").isNotNull() | F.col("d").isNotNull()


def _as_double() -> Column:
    return F.coalesce(F.col("d"), F.col("i").cast("double"))


def _column_stats(pairs: DataFrame) -> DataFrame:
    """Step 2: counts, extremes and sums, one row per column."""
    c = F.col("c")
    counted = lambda cond: F.coalesce(F.sum(F.when(cond, c)), F.lit(0))
    return pairs.groupBy("col_idx").agg(
        F.sum(c).alias("n_rows"),
        counted(_has_value()).alias("count"),
        F.count_if(_has_value()).alias("n_distinct"),
        counted((F.col("i") == 0) | (F.col("d") == 0)).alias("n_zeros"),
        counted((F.col("i") < 0) | (F.col("d") < 0)).alias("n_negative"),
        F.min("i").alias("min_int"), F.max("i").alias("max_int"), F.min("d").alias("min_d"), F.max("d").alias("max_d"),
        F.coalesce(F.sum(F.col("d") * c), F.sum(F.col("i").cast("decimal(19,0)") * c.cast("decimal(19,0)")).cast("double"))
        .alias("sum"),
        F.min("image").alias("low"), F.max("image").alias("high"),
    ).withColumn("mean", F.try_divide(F.col("sum"), F.col("count")))


def _with_image(pairs: DataFrame) -> DataFrame:
    """Adds ``image``: a bigint in the order of the values of a column.  A whole number is its own
    image; that of a double is its bits read as a number (its exponent and 52 bits of fraction,
    worked out by exact arithmetic), with its sign."""
    e, power = F.col("e_"), lambda x: F.pow(F.lit(2.0), x)
    size = F.abs("d")
    plain = size.between(2.0 ** -1022, sys.float_info.max)
    # the logarithm may be rounded over a whole number: one step back or forth mends it
    guess = pairs.withColumn("e_", F.when(plain, F.floor(F.log2(size)).cast("int")))
    part = size / power(e)
    sure = guess.withColumn("e_", F.when(part >= 2, e + 1).when(part < 1, e - 1).otherwise(e))
    one = 1 << 52
    bits = (F.when(plain, (e + 1023).cast("long") * one + ((size / power(e) - 1) * float(one)).cast("long"))
            .when(size > 1, F.lit(2047 * one)).otherwise((size * 2.0 ** 537 * 2.0 ** 537).cast("long")))
    return sure.withColumn("image", F.coalesce("i", F.when(F.col("d") < 0, -bits).otherwise(bits))).drop("e_")


def _digit(shift: str = "shift") -> Column:
    """The leading bits of an image counted from the column's smallest (``base``), in halves so
    that the difference of any two images fits."""
    return F.call_function("shiftright", F.shiftright("image", 1) - F.col("base"), F.col(shift))


def _wanted_ranks(n: int) -> list[int]:
    return sorted({r for q in QUANTILES.values() for r in (math.floor(q * (n - 1)), math.ceil(q * (n - 1)))}) if n else []


def _select(pairs: DataFrame, stats: list[Row], few: int) -> tuple[list[dict], dict[int, Row]]:
    """Step 3: for each column and wanted rank the digit that holds it (its column, shift, digit, the
    rank at which it starts and its distinct values), and each column's central moments."""
    spark = pairs.sparkSession
    columns = [(r["col_idx"], r["mean"], r["low"] >> 1, max(0, ((r["high"] >> 1) - (r["low"] >> 1)).bit_length() - DIGIT),
                _wanted_ranks(r["count"])) for r in stats if r["count"]]
    if not columns:
        return [], {}
    params = spark.createDataFrame(columns, "p_idx int, mean double, base long, shift int, ranks array<long>")
    off = _as_double() - F.col("mean")
    counters = (pairs.join(F.broadcast(params.drop("ranks")), F.col("col_idx") == F.col("p_idx"))
                .groupBy("col_idx", "base", "shift", _digit().alias("digit"))
                .agg(F.sum("c").alias("tot"), F.count(F.lit(1)).alias("values"),
                     *[F.sum(F.col("c") * F.pow(off, F.lit(k))).alias(f"m{k}") for k in (2, 3, 4)]))
    every = Window.partitionBy("col_idx")
    moments = [F.sum(f"m{k}").over(every).alias(f"m{k}") for k in (2, 3, 4)]
    held = (counters.select("col_idx", "base", "shift", "digit", "tot", "values", *moments, _before(every).alias("start"))
            .join(F.broadcast(params.select("p_idx", F.explode("ranks").alias("r"))),
                  (F.col("col_idx") == F.col("p_idx")) & (F.col("r") >= F.col("start")) & (F.col("r") < F.col("start") + F.col("tot")))
            .collect())  # 10 rows a column
    found = [{k: r[k] for k in ("col_idx", "r", "base", "shift", "digit", "start", "values")} for r in held]
    while wide := [f for f in found if f["values"] > few and f["shift"] > 0]:
        found = [f for f in found if f not in wide] + _narrowed(pairs, wide)
    return found, {r["col_idx"]: r for r in held}


def _before(group: WindowSpec) -> Column:
    """The rows counted under smaller digits."""
    return F.coalesce(F.sum("tot").over(group.orderBy("digit").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))


def _narrowed(pairs: DataFrame, wide: list[dict]) -> list[dict]:
    """One more pass: the next bits of the digits given."""
    spark = pairs.sparkSession
    rows = [(f["col_idx"], f["base"], f["shift"], max(0, f["shift"] - DIGIT), f["digit"], f["start"], f["r"]) for f in wide]
    wanted = spark.createDataFrame(rows, "p_idx int, base long, shift int, next int, outer long, from long, r long")
    digits = wanted.select("p_idx", "base", "shift", "next", "outer", "from").distinct()
    inner = pairs.join(F.broadcast(digits), (F.col("col_idx") == F.col("p_idx")) & (_digit() == F.col("outer")))
    group = Window.partitionBy("col_idx", "outer")
    counters = (inner.groupBy("col_idx", "outer", "from", "base", "next", _digit("next").alias("digit"))
                .agg(F.sum("c").alias("tot"), F.count(F.lit(1)).alias("values"))
                .withColumn("start", F.col("from") + _before(group)))
    ranks = wanted.select("p_idx", F.col("outer").alias("p_outer"), "r")
    held = counters.join(F.broadcast(ranks), (F.col("col_idx") == F.col("p_idx")) & (F.col("outer") == F.col("p_outer"))
                         & (F.col("r") >= F.col("start")) & (F.col("r") < F.col("start") + F.col("tot"))).collect()
    return [{**{k: r[k] for k in ("col_idx", "r", "base", "digit", "start", "values")}, "shift": r["next"]} for r in held]


def _exact_quantiles(pairs: DataFrame, stats: list[Row], found: list[dict]) -> DataFrame:
    """Step 4: the quantiles of every column, linear between order statistics."""
    spark = pairs.sparkSession
    digits = spark.createDataFrame(list({(f["col_idx"], f["base"], f["shift"], f["digit"], f["start"]) for f in found}),
                                   "p_idx int, base long, shift int, outer long, from long")
    inside = pairs.join(F.broadcast(digits), (F.col("col_idx") == F.col("p_idx")) & (_digit() == F.col("outer")))
    run = Window.partitionBy("col_idx", "shift", "outer").orderBy("image", "i", "d").rowsBetween(Window.unboundedPreceding, -1)
    ranked = inside.select("col_idx", "i", "d", "c", (F.col("from") + F.coalesce(F.sum("c").over(run), F.lit(0))).alias("r0"))
    rows = [(r["col_idx"], k, q * (r["count"] - 1)) for r in stats if r["count"] for k, q in QUANTILES.items()]
    wanted = (spark.createDataFrame(rows, "t_idx int, qname string, pos double")
              .select("*", F.explode(F.array_distinct(F.array(F.floor("pos"), F.ceil("pos")))).alias("r")))
    hits = ranked.join(F.broadcast(wanted), (F.col("col_idx") == F.col("t_idx"))
                       & (F.col("r") >= F.col("r0")) & (F.col("r") < F.col("r0") + F.col("c")))
    value = lambda edge: F.max(F.when(F.col("r") == edge("pos"), _as_double()))
    per_q = hits.groupBy("col_idx", "qname", "pos").agg(value(F.floor).alias("lo"), value(F.ceil).alias("hi"))
    part = F.col("pos") - F.floor("pos")
    at = F.when(F.col("lo") == F.col("hi"), F.col("lo")).otherwise(F.col("lo") + part * (F.col("hi") - F.col("lo")))
    return per_q.groupBy("col_idx").agg(*[F.max(F.when(F.col("qname") == k, at)).alias(k) for k in QUANTILES])


def _exact_stats(long: DataFrame, few: int = FEW) -> DataFrame:
    spark = long.sparkSession
    pairs = pinned(_with_image(long.groupBy("col_idx", "i", "d").agg(F.count(F.lit(1)).alias("c"))), "profile-pairs")
    summary = _column_stats(pairs)
    stats = summary.collect()  # a row for each column
    valued = pairs.where(_has_value())
    found, moments = _select(valued, stats, few)
    kinds = T.StructType([*summary.schema.fields, *[T.StructField(f"m{k}", T.DoubleType()) for k in (2, 3, 4)]])
    rows = [(*r, *([moments[r["col_idx"]][f"m{k}"] for k in (2, 3, 4)] if r["col_idx"] in moments else [None] * 3)) for r in stats]
    columns = spark.createDataFrame(rows, kinds).drop("low", "high")
    return columns.join(F.broadcast(_exact_quantiles(valued, stats, found)), "col_idx", "left")


def _approx_stats(long: DataFrame, accuracy: int) -> DataFrame:
    """One pass: sketches for distinct counts and quantiles."""
    v = _as_double()
    key = F.struct("i", "d")
    qs = F.array(*[F.lit(q) for q in QUANTILES.values()])
    out = long.groupBy("col_idx").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count(v).alias("count"),
        F.approx_count_distinct(F.when(_has_value(), F.xxhash64(key)), 0.01).alias("n_distinct"),
        F.count_if(v == 0).alias("n_zeros"), F.count_if(v < 0).alias("n_negative"),
        F.min("i").alias("min_int"), F.max("i").alias("max_int"), F.min("d").alias("min_d"), F.max("d").alias("max_d"),
        F.sum(v).alias("sum"), F.avg(v).alias("mean"), F.var_pop(v).alias("var_pop"), F.skewness(v).alias("g1"),
        F.kurtosis(v).alias("g2"), F.percentile_approx(v, qs, accuracy).alias("qs"))
    n = F.col("count")
    return out.select(
        "*", (F.col("var_pop") * n).alias("m2"), (F.col("g1") * n * F.pow("var_pop", F.lit(1.5))).alias("m3"),
        ((F.col("g2") + 3) * n * F.col("var_pop") * F.col("var_pop")).alias("m4"),
        *[F.col("qs")[i].alias(k) for i, k in enumerate(QUANTILES)])


def profile_tables(
    tables: Mapping[str, DataFrame],
    n: int | None = None,
    approx: bool = False,
    accuracy: int = 10000,
    digits: int | None = None,
) -> DataFrame | None:
    """Profiles of many tables in one pipeline: their long forms are united (a narrow
    union) under global column indices, so every aggregation and shuffle is shared.
    Output: table_name + PROFILE_SCHEMA; None when no table has a numeric column.
    ``digits`` rounds what depends on the order of floating-point additions, for reports."""
    entries: list[tuple[str, str, int]] = []
    longs = []
    for t, df in tables.items():
        names = numeric_columns(df)
        if not names:
            continue
        positions = {c: i for i, c in enumerate(df.columns)}
        sel = df.select(*[col_of(c) for c in names])
        longs.append(_long_form(cap_rows(sel, n) if n is not None else sel, names, base=len(entries)))
        entries += [(t, c, positions[c]) for c in names]
    return _profiles(longs, entries, approx, accuracy, digits)


def _profiles(longs: list[DataFrame], entries: list[tuple[str, str, int]], approx: bool, accuracy: int,
              digits: int | None) -> DataFrame | None:
    """The profiles of long forms whose column k is (table, column, position) ``entries[k]``."""
    if not longs:
        return None
    long = reduce(lambda a, b: a.unionByName(b), longs)
    stats = _approx_stats(long, accuracy) if approx else _exact_stats(long)
    names = long.sparkSession.createDataFrame(
        [(i, *e) for i, e in enumerate(entries)], "n_idx int, table_name string, column_name string, column_position int")

    cnt = F.col("count").cast("double")
    var_pop = F.col("m2") / cnt
    variance = F.when(cnt > 1, F.col("m2") / (cnt - 1))
    g1 = F.col("m3") / cnt / F.pow(var_pop, F.lit(1.5))
    g2 = F.col("m4") / cnt / (var_pop * var_pop) - 3
    skew = (F.when(F.col("count") < 3, F.lit(None).cast("double"))
            .when(var_pop == 0, F.lit(0.0))
            .otherwise(g1 * F.sqrt(cnt * (cnt - 1)) / (cnt - 2)))
    kurt = (F.when(F.col("count") < 4, F.lit(None).cast("double"))
            .when(var_pop == 0, F.lit(0.0))
            .otherwise(((cnt + 1) * g2 + 6) * (cnt - 1) / ((cnt - 2) * (cnt - 3))))
    low, high = (F.coalesce(f"{k}_d", F.col(f"{k}_int").cast("double")) for k in ("min", "max"))
    values = {
        "min": low, "max": high, "mean": F.col("mean"),
        "stddev": F.sqrt(variance), "variance": variance, "sum": F.col("sum"),
        "range": high - low,
        "skewness": F.round(skew, SHAPE_DECIMALS) if digits else skew,
        "kurtosis": F.round(kurt, SHAPE_DECIMALS) if digits else kurt,
        "cv": F.try_divide(F.sqrt(variance), F.col("mean")),
        **{k: F.col(k) for k in QUANTILES},
        "iqr": F.col("q75") - F.col("q25"),
    }
    raw = stats.join(names, F.col("col_idx") == F.col("n_idx")).select(
        "table_name", "column_name", "column_position",
        F.col("count").cast("long").alias("count"),
        (F.col("n_rows") - F.col("count")).cast("long").alias("n_missing"),
        F.coalesce(F.col("n_distinct"), F.lit(0)).cast("long").alias("n_distinct"),
        *[e.cast("double").alias(k) for k, e in values.items()],
        F.col("n_zeros").cast("long").alias("n_zeros"),
        F.col("n_negative").cast("long").alias("n_negative"),
        "min_int", "max_int",
    )
    if not digits:
        return raw
    # rounding in its own projection over plain columns keeps the expressions small
    return raw.withColumns({k: sig_round(k, digits) for k in values if k not in ("min", "max")})


def column_profile(
    df: DataFrame,
    n: int | None = None,
    approx: bool = False,
    accuracy: int = 10000,
    digits: int | None = None,
) -> DataFrame:
    """A4: one row per numeric column (P12) with the statistics of PROFILE_SCHEMA.

    Skewness and kurtosis are the sample-corrected (Fisher) estimates, 0 for a constant
    column, NULL below 3 / 4 values.  ``cv`` = stddev / mean.  Quantiles interpolate
    linearly between order statistics.  No numeric columns: an empty frame.
    """
    out = profile_tables({"": df}, n=n, approx=approx, accuracy=accuracy, digits=digits)
    if out is None:
        return df.sparkSession.createDataFrame([], PROFILE_SCHEMA)
    return out.drop("table_name")


def schema_profile(
    spark: SparkSession,
    zone: str,
    n: int | None = None,
    approx: bool = False,
    digits: int | None = None,
) -> DataFrame:
    """A5: A4 for every table of a zone, with ``schema`` and ``table_name`` columns,
    all tables in one Spark job.

    Parquet tables of the same numeric columns and layout are read by one scan over all their
    folders, so the plan grows with the different schemas of a zone and not with its tables.
    Tables without numeric columns (every raw-zone table: all text) add no rows; a zone
    without tables gives an empty frame.
    """
    entries: list[tuple[str, str, int]] = []
    longs: list[DataFrame] = []
    shared: dict[tuple, list[tuple[str, int, T.StructType]]] = {}
    for t in table_names(spark, zone):
        df = scan_table(spark, zone, t)
        names, positions = numeric_columns(df), {c: i for i, c in enumerate(df.columns)}
        if not names:
            continue
        base = len(entries)
        entries += [(t, c, positions[c]) for c in names]
        details = table_details(spark, table_name(zone, t))
        layout = partition_columns(spark, table_name(zone, t))
        if (n is None and details.get("Provider", "").lower() == "parquet" and details.get("Location")
                and details.get("Type") != "VIEW" and details.get("Partition Provider") != "Catalog"):
            fields = [df.schema[c] for c in names] + [df.schema[c] for c in layout if c not in names]
            key = (tuple((f.name.lower(), f.dataType.simpleString()) for f in fields), tuple(layout))
            shared.setdefault(key, []).append((t, base, T.StructType(fields)))
        else:
            sel = df.select(*[col_of(c) for c in names])
            longs.append(_long_form(cap_rows(sel, n) if n is not None else sel, names, base))
    for (_, layout), same in shared.items():
        (t, base, schema), names = same[0], numeric_columns(scan_table(spark, zone, same[0][0]))
        if len(same) == 1:
            longs.append(_long_form(scan_table(spark, zone, t).select(*[col_of(c) for c in names]), names, base))
        else:
            folders = {table_location(spark, table_name(zone, t)): base for t, base, _ in same}
            longs.append(_long_form(shared_scan(spark, schema, layout, folders, "base of it"), names, quote("base of it")))
    out = _profiles(longs, entries, approx, 10000, digits)
    if out is None:
        empty = T.StructType([T.StructField("schema", T.StringType()), T.StructField("table_name", T.StringType())]
                             + PROFILE_SCHEMA.fields)
        return spark.createDataFrame([], empty)
    return out.select(F.lit(zone).alias("schema"), "*")
