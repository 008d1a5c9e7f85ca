"""Low and high watermarks (min / max of a time column) per table and per zone.

A zone sweep reads no rows where it can: the smallest and largest value of a whole number, date or
timestamp column are in the footers of the Parquet files, which one job reads on the executors.
Tables with a text column, or with a file without such statistics, are read by one scan for each
type of column over all their folders, rows told apart by the file they come from.  Either way the
plan is as large for a thousand tables as for ten, and one row a file crosses the network.
(Tables that are no Parquet, or keep the column as their layout, get an aggregation of their own.)
"""

from __future__ import annotations

import re
import sys
from collections.abc import Callable, Iterable, Iterator, Mapping
from datetime import date, datetime, timezone
from functools import reduce

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.functions.casts import partition_label, value_text
from tidewater.functions.columns import col_of, find_column
from tidewater.sources.catalog import DEFAULT_CLUSTER, DEFAULT_DATABASE, table_names
from tidewater.sources.tables import partition_columns, scan_table, table_details, table_name

# Workers need no copy of this package: its functions travel with the job.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Types whose extremes Parquet footers hold exactly, and how the footers' numbers are read back.
FOOTER_TYPES: dict[type, Callable[[Column], Column]] = {
    T.ByteType: lambda x: x.cast("tinyint"), T.ShortType: lambda x: x.cast("smallint"),
    T.IntegerType: lambda x: x.cast("int"), T.LongType: lambda x: x,
    T.DateType: lambda x: F.date_from_unix_date(x.cast("int")), T.TimestampType: F.timestamp_micros,
    T.TimestampNTZType: lambda x: F.timestamp_add("MICROSECOND", x, F.lit(datetime(1970, 1, 1)).cast("timestamp_ntz")),
}
# Tasks that read footers at most, and files from which on a job for the footers alone is worth it.
FOOTER_TASKS = 4096
FOOTER_FILES = 64

# The two watermark kinds and the aggregate each one takes.
KINDS = {"high_watermark": "max", "low_watermark": "min"}
DEFAULT_TS_COL = "pickup_datetime"

WATERMARK_SCHEMA = T.StructType(
    [
        T.StructField("create_time", T.StringType()),
        T.StructField("database", T.StringType()),
        T.StructField("schema", T.StringType()),
        T.StructField("table_name", T.StringType()),
        T.StructField("part_name", T.StringType()),
        T.StructField("part_type", T.StringType()),
        T.StructField("cluster", T.StringType()),
    ]
)


def high_watermark(df: DataFrame, ts_col: str = DEFAULT_TS_COL) -> DataFrame:
    """A1: ``select max(ts) from t`` (lexical on a text column, as in the raw zone)."""
    return df.agg(F.max(col_of(find_column(df, ts_col) or ts_col)).alias("high_watermark"))


def low_watermark(df: DataFrame, ts_col: str = DEFAULT_TS_COL) -> DataFrame:
    """A2: ``select min(ts) from t``."""
    return df.agg(F.min(col_of(find_column(df, ts_col) or ts_col)).alias("low_watermark"))


def table_bounds(df: DataFrame, ts_col: str, table: str) -> DataFrame:
    """(table_name, low, high) as text for one table, in one aggregation over all rows of one
    column.  No partition is left out: the layout may not follow the column's order (text
    times, empty or NULL partitions)."""
    actual = find_column(df, ts_col)
    if actual is None:
        raise KeyError(f"table {table!r} has no column {ts_col!r}")
    b = df.agg(F.min(col_of(actual)).alias("lo"), F.max(col_of(actual)).alias("hi"))
    return _as_text(b.withColumn("table_name", F.lit(table)), df.schema[actual].dataType)


def _as_text(bounds: DataFrame, dtype: T.DataType) -> DataFrame:
    """(table_name, lo, hi) with both as text and as partition labels."""
    return bounds.select(
        "table_name",
        value_text(F.col("lo"), dtype).alias("low_watermark"),
        value_text(F.col("hi"), dtype).alias("high_watermark"),
        partition_label(F.col("lo"), dtype).alias("low_part"),
        partition_label(F.col("hi"), dtype).alias("high_part"),
    )


def watermarks_of(
    tables: Mapping[str, DataFrame],
    schema: str,
    ts_col: str | Mapping[str, str] = DEFAULT_TS_COL,
    kinds: Iterable[str] = ("high_watermark", "low_watermark"),
    cluster: str = DEFAULT_CLUSTER,
    database: str = DEFAULT_DATABASE,
    missing: str = "raise",
    spark: SparkSession | None = None,
) -> DataFrame:
    """A3 over given frames: one record per (table, kind).

    ``create_time`` is the watermark as text (tables differ in type); ``part_name`` is
    ``ds=<text>`` (``ds=None`` for an empty table).  ``missing="skip"`` leaves out
    tables without the time column instead of raising.
    """
    kinds = list(kinds)
    for k in kinds:
        if k not in KINDS:
            raise ValueError(f"unknown watermark kind {k!r}")
    branches = []
    for name, df in tables.items():
        col = ts_col.get(name, DEFAULT_TS_COL) if isinstance(ts_col, Mapping) else ts_col
        if find_column(df, col) is None:
            if missing == "skip":
                continue
            raise KeyError(f"table {name!r} has no column {col!r}")
        branches.append(table_bounds(df, col, name))
    if not branches:
        if spark is None:
            raise ValueError("no tables: pass spark to get an empty frame")
        return spark.createDataFrame([], WATERMARK_SCHEMA)
    return _records(reduce(lambda a, b: a.unionByName(b), branches), schema, kinds, cluster, database)


def _records(bounds: DataFrame, schema: str, kinds: list[str], cluster: str, database: str) -> DataFrame:
    # unpivot in the same pass (a union of per-kind selects would scan every table twice)
    side = {"high_watermark": "high", "low_watermark": "low"}
    records = F.array(*[
        F.struct(
            F.col(f"{side[k]}_watermark").alias("create_time"),
            F.col(f"{side[k]}_part").alias("part_name"),
            F.lit(k).alias("part_type"),
        )
        for k in kinds
    ])
    return bounds.select("table_name", F.inline(records)).select(
        "create_time",
        F.lit(database).alias("database"),
        F.lit(schema).alias("schema"),
        "table_name",
        "part_name",
        "part_type",
        F.lit(cluster).alias("cluster"),
    )


def _number(value) -> int | None:
    """An extreme as a footer keeps it: a number of days, microseconds or the whole number itself."""
    if isinstance(value, datetime):
        since = value - (datetime(1970, 1, 1, tzinfo=timezone.utc) if value.tzinfo else datetime(1970, 1, 1))
        return (since.days * 86_400 + since.seconds) * 1_000_000 + since.microseconds
    if isinstance(value, date):
        return (value - date(1970, 1, 1)).days
    return value if isinstance(value, int) and not isinstance(value, bool) else None


def footer_bounds(path: str, column: str) -> tuple[int | None, int | None, bool]:
    """(min, max, whether they are known) of a top-level column from the footer of one Parquet file."""
    from pyarrow import ArrowInvalid, ArrowNotImplementedError, fs
    from pyarrow import parquet as pq

    try:
        store, inner = (fs.LocalFileSystem(), re.sub(r"^file:/+", "/", path)) if path.startswith("file:") else fs.FileSystem.from_uri(path)
    except (ArrowInvalid, ArrowNotImplementedError):  # a store that pyarrow has no client for
        return None, None, False
    low: int | None = None
    high: int | None = None
    with store.open_input_file(inner) as f:
        meta = pq.ParquetFile(f).metadata
        names = [meta.schema.column(i).path for i in range(meta.num_columns)]
        at = [i for i, name in enumerate(names) if name.lower() == column.lower()]
        if not at and not any(name.lower().startswith(f"{column.lower()}.") for name in names):
            return None, None, True  # a file written before the column was added
        for g in range(meta.num_row_groups):
            chunk = meta.row_group(g).column(at[0]) if len(at) == 1 else None
            if chunk is None or chunk.physical_type not in ("INT32", "INT64") or chunk.statistics is None:
                return None, None, False
            stats = chunk.statistics
            if not stats.has_min_max:
                if stats.has_null_count and stats.null_count == meta.row_group(g).num_rows:
                    continue
                return None, None, False
            try:
                a, b = _number(stats.min), _number(stats.max)
            except ValueError:  # out of the range of Python's times
                return None, None, False
            if a is None or b is None or str(meta.schema.column(at[0]).logical_type).find("nanoseconds") >= 0:
                return None, None, False
            scale = 1000 if "milliseconds" in str(meta.schema.column(at[0]).logical_type) and not isinstance(stats.min, datetime) else 1
            low = a * scale if low is None else min(low, a * scale)
            high = b * scale if high is None else max(high, b * scale)
    return low, high, True


def read_footers(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows (table_name, path, ts) to (table_name, lo, hi, known)."""
    for batch in batches:
        found = [footer_bounds(p, c) for p, c in zip(batch["path"], batch["ts"], strict=True)]
        yield pd.DataFrame({"table_name": batch["table_name"], "lo": pd.array([f[0] for f in found], dtype="Int64"),
                            "hi": pd.array([f[1] for f in found], dtype="Int64"), "known": [f[2] for f in found]})


def _folders(spark: SparkSession, tables: Mapping[str, tuple[str, str]]) -> tuple[DataFrame, list[int]]:
    """(folder, table_name, ts) with the folder as a file's URI begins with it, and the folders' depths."""
    uri = lambda p: spark._jvm.org.apache.hadoop.fs.Path(p).toUri().toString()
    plain = [(re.sub(r"^file:/+", "/", uri(folder)).rstrip("/"), t, ts) for t, (folder, ts) in tables.items()]
    return spark.createDataFrame(plain, "folder string, table_name string, ts string"), sorted({x[0].count("/") + 1 for x in plain})


def _with_table(files: DataFrame, folders: DataFrame, depths: Iterable[int]) -> DataFrame:
    """Files (``file``, a URI) with the table whose folder they are below: an equi-join for each depth
    of folders, of which a zone has few."""
    plain = F.regexp_replace("file", "^file:/+", "/")
    parts = []
    for d in depths:
        at_depth = folders.where(F.size(F.split("folder", "/")) == d)
        parts.append(files.join(F.broadcast(at_depth), F.substring_index(plain, "/", d) == F.col("folder")))
    return reduce(lambda a, b: a.unionByName(b), parts)


def zone_bounds(spark: SparkSession, tables: Mapping[str, tuple[str, str]], dtype: T.DataType, footers: bool = True) -> DataFrame:
    """(table_name, lo, hi) of Parquet tables whose time columns are of one type: name -> (folder,
    column).  From footers where the type and every file of a table allow it, else from the rows,
    all such tables in one scan."""
    from tidewater.session import pinned

    folders, depths = _folders(spark, tables)
    names = folders.select("table_name")
    known, rest, parts = [], dict(tables), []
    if footers and type(dtype) in FOOTER_TYPES:
        listed = (spark.read.format("binaryFile").option("recursiveFileLookup", True).load([f for f, _ in tables.values()])
                  .select("path", F.col("_metadata.file_path").alias("file")).coalesce(FOOTER_TASKS))
        found = _with_table(listed, folders, depths).select("table_name", "path", "ts").mapInPandas(
            read_footers, "table_name string, lo long, hi long, known boolean")
        by_table = pinned(found.groupBy("table_name").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"),
                                                          F.bool_and("known").alias("known")), "footer-bounds")
        unknown = {r[0] for r in by_table.where("NOT known").select("table_name").collect()}
        rest = {t: x for t, x in tables.items() if t in unknown}
        back = FOOTER_TYPES[type(dtype)]
        known = [by_table.where("known").select("table_name", back(F.col("lo")).alias("lo"), back(F.col("hi")).alias("hi"))]
    for column in sorted({ts.lower() for _, ts in rest.values()}):
        some = [folder for folder, ts in rest.values() if ts.lower() == column]
        scan = (spark.read.schema(T.StructType([T.StructField(column, dtype)])).option("recursiveFileLookup", True).parquet(*some)
                .groupBy(F.col("_metadata.file_path").alias("file")).agg(F.min(col_of(column)).alias("lo"), F.max(col_of(column)).alias("hi")))
        parts.append(_with_table(scan, folders, depths).groupBy("table_name").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")))
    found = reduce(lambda a, b: a.unionByName(b), known + parts)
    return names.join(found, "table_name", "left")  # tables without a file have no extremes


def watermarks(
    spark: SparkSession,
    zone: str,
    ts_col: str | Mapping[str, str] = DEFAULT_TS_COL,
    kinds: Iterable[str] = ("high_watermark", "low_watermark"),
    cluster: str = DEFAULT_CLUSTER,
    database: str = DEFAULT_DATABASE,
    missing: str = "raise",
    footers: bool | None = None,
) -> DataFrame:
    """A3: watermarks of every table of a zone (``SHOW TABLES IN zone``), as :func:`watermarks_of`
    gives them, from footers and shared scans (see above).  ``footers`` False reads all rows; None
    does so for columns of one name and type that have fewer than ``FOOTER_FILES`` files in all."""
    kinds, branches, groups = list(kinds), {}, {}
    for t in table_names(spark, zone):
        df = scan_table(spark, zone, t)
        actual = find_column(df, ts_col.get(t, DEFAULT_TS_COL) if isinstance(ts_col, Mapping) else ts_col)
        details = table_details(spark, table_name(zone, t)) if actual else {}
        if (actual and details.get("Provider", "").lower() == "parquet" and details.get("Location") and details.get("Type") != "VIEW"
                and details.get("Partition Provider") != "Catalog"
                and actual.lower() not in [c.lower() for c in partition_columns(spark, table_name(zone, t))]):
            dtype = df.schema[actual].dataType
            group = groups.setdefault((dtype.simpleString(), actual.lower()), (dtype, {}, []))
            group[1][t] = (details["Location"], actual)
            group[2].append(df)
        else:
            branches[t] = df
    by_footers = {}
    for kind, (dtype, tables, frames) in list(groups.items()):
        by_footers[kind] = footers if footers is not None else sum(len(df._jdf.inputFiles()) for df in frames) >= FOOTER_FILES
        if not by_footers[kind] and len(tables) == 1:  # nothing to share
            branches[next(iter(tables))] = frames[0]
            del groups[kind]
    if any(k not in KINDS for k in kinds) or not groups:
        return watermarks_of(branches, zone, ts_col, kinds, cluster, database, missing, spark=spark)
    shared = [_records(_as_text(zone_bounds(spark, tables, dtype, by_footers[kind]), dtype), zone, kinds, cluster, database)
              for kind, (dtype, tables, _) in groups.items()]
    own = [watermarks_of(branches, zone, ts_col, kinds, cluster, database, missing, spark=spark)] if branches else []
    return reduce(lambda a, b: a.unionByName(b), shared + own)
