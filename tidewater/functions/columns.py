"""Column-level projections: renames, canonical spelling, typed projections.

Column lookups are case-insensitive, as they are under Spark's default analyser
settings, but resolved here explicitly so that a case-sensitive session behaves the
same way.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.functions.casts import to_float_lenient, to_int_lenient, to_ts_lenient

# Header renames applied when raw CSVs are ingested (green and yellow).
INGEST_RENAMES = {
    "Trip_type ": "trip_type",
    "lpep_pickup_datetime": "pickup_datetime",
    "Lpep_dropoff_datetime": "dropoff_datetime",
    "tpep_pickup_datetime": "pickup_datetime",
    "tpep_dropoff_datetime": "dropoff_datetime",
}

# Renames applied to the 2015+ yellow era before it joins the merge.
YELLOW_LATE_RENAMES = {"VendorID": "vendor_id", "RatecodeID": "rate_code"}

# Numeric types a profile keeps (what pandas calls a number after a fetch).
NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType)


def quote(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def col_of(name: str) -> Column:
    """Column by its exact name, safe for blanks and dots."""
    return F.col(quote(name))


def find_column(df: DataFrame, name: str) -> str | None:
    """Actual spelling of ``name`` in ``df`` (case-insensitive), or None."""
    lower = name.lower()
    for c in df.columns:
        if c.lower() == lower:
            return c
    return None


def resolve(df: DataFrame, name: str) -> Column:
    actual = find_column(df, name)
    if actual is None:
        raise KeyError(f"column {name!r} not in {df.columns}")
    return col_of(actual)


def resolve_or_null(df: DataFrame, name: str, dtype: str = "string") -> Column:
    actual = find_column(df, name)
    return col_of(actual) if actual is not None else F.lit(None).cast(dtype)


def rename_if_present(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename where the source column exists (case-insensitive); no-op otherwise.

    Raises when two columns would end up with the same name (case-insensitive),
    which a chain of ``withColumnRenamed`` would silently allow.
    """
    resolved: dict[str, str] = {}
    for src, dst in mapping.items():
        actual = find_column(df, src)
        if actual is not None and actual != dst:
            resolved[actual] = dst
    final = [resolved.get(c, c) for c in df.columns]
    seen: dict[str, str] = {}
    for name in final:
        key = name.lower()
        if key in seen:
            raise ValueError(f"rename collision: {seen[key]!r} and {name!r} in {final}")
        seen[key] = name
    return df.withColumnsRenamed(resolved) if resolved else df


def canonical_case(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Respell the listed columns exactly as given, keeping their positions."""
    wanted = {n.lower(): n for n in names}
    return df.select(*[col_of(c).alias(wanted.get(c.lower(), c)) for c in df.columns])


def pickup_year(ts: Column) -> Column:
    """P6."""
    return F.year(ts)


def pickup_month(ts: Column) -> Column:
    """P7."""
    return F.month(ts)


def tag_source(df: DataFrame, value: str, name: str = "data_source") -> DataFrame:
    """Constant column."""
    return df.withColumn(name, F.lit(value))


# Typed projection spec: (target name, source name, kind), kind one of
# ts | int | float | str | year:<source> | month:<source> | lit:<text>
Spec = Sequence[tuple[str, str | None, str]]


def _spec_expr(df: DataFrame, source: str | None, kind: str) -> Column:
    if kind.startswith("lit:"):
        return F.lit(kind[4:])
    if kind.startswith("year:"):
        return pickup_year(to_ts_lenient(resolve(df, kind[5:])))
    if kind.startswith("month:"):
        return pickup_month(to_ts_lenient(resolve(df, kind[6:])))
    c = resolve(df, source)
    if kind == "ts":
        return to_ts_lenient(c)
    if kind == "int":
        return to_int_lenient(c)
    if kind == "float":
        return to_float_lenient(c)
    if kind == "str":
        return c
    raise ValueError(f"unknown kind {kind!r}")


def project(df: DataFrame, spec: Spec) -> DataFrame:
    """One ``select`` for a whole typed spec (one projection, not a withColumn chain)."""
    return df.select(*[_spec_expr(df, src, kind).alias(dst) for dst, src, kind in spec])


def drop_columns(df: DataFrame, *names: str) -> DataFrame:
    """P10 (case-insensitive; missing names are ignored)."""
    actual = [a for a in (find_column(df, n) for n in names) if a is not None]
    return df.drop(*actual) if actual else df


def copy_column(df: DataFrame, src: str, dst: str) -> DataFrame:
    """Copy a column uncast."""
    return df.withColumn(dst, resolve(df, src))


def numeric_columns(df: DataFrame) -> list[str]:
    """Names of the numeric columns, in table order (decimal and boolean excluded)."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC_TYPES)]


def surcharge_fold(df: DataFrame, policy: str = "replace") -> Column:
    """The value ``improvement_surcharge`` takes in the clean yellow table.

    ``replace`` (the reference): float of ``surcharge``, even where that is NULL and an
    ``improvement_surcharge`` value exists.  ``coalesce``: fall back to the existing one.
    """
    if find_column(df, "surcharge") is None:
        if policy == "coalesce":
            return to_float_lenient(resolve_or_null(df, "improvement_surcharge"))
        raise KeyError("no column 'surcharge': replacing improvement_surcharge would wipe it (policy='coalesce' keeps it)")
    from_surcharge = to_float_lenient(resolve(df, "surcharge"))
    if policy == "replace":
        return from_surcharge
    if policy == "coalesce":
        return F.coalesce(from_surcharge, to_float_lenient(resolve_or_null(df, "improvement_surcharge")))
    raise ValueError(f"unknown surcharge policy {policy!r}")
