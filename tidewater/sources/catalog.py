"""Catalog reads: table lists, table and column metadata, schema filters.

The catalog is metadata (tables x columns), not data; it is read through the public
catalog API and turned into small DataFrames that the metadata jobs join and group.
"""

from __future__ import annotations

from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.functions.columns import quote

# Defaults the metadata jobs were configured with.
DEFAULT_CLUSTER = "my_delta_environment"
DEFAULT_DATABASE = "default"

# Catalog lookups in flight at once (the reference's extractor used 8 threads).
CATALOG_THREADS = 8

TABLE_LIST_SCHEMA = T.StructType(
    [
        T.StructField("database", T.StringType()),
        T.StructField("tableName", T.StringType()),
        T.StructField("isTemporary", T.BooleanType()),
    ]
)

METADATA_SCHEMA = T.StructType(
    [
        T.StructField("database", T.StringType()),
        T.StructField("cluster", T.StringType()),
        T.StructField("schema", T.StringType()),
        T.StructField("table_name", T.StringType()),
        T.StructField("table_type", T.StringType()),
        T.StructField("table_description", T.StringType()),
        T.StructField("column_name", T.StringType()),
        T.StructField("column_type", T.StringType()),
        T.StructField("column_description", T.StringType()),
        T.StructField("sort_order", T.IntegerType()),
        T.StructField("is_partition", T.BooleanType()),
    ]
)


def list_tables(spark: SparkSession, zone: str) -> DataFrame:
    """``SHOW TABLES IN zone`` as (database, tableName, isTemporary), catalog tables
    only (session temporary views are listed by Spark too, but are not zone tables)."""
    shown = spark.sql(f"SHOW TABLES IN {quote(zone)}")
    return shown.select(
        F.col("namespace").alias("database"), "tableName", "isTemporary"
    ).where(~F.col("isTemporary"))


def table_names(spark: SparkSession, zone: str) -> list[str]:
    """Names of the catalog tables of a zone, in catalog order (metadata only)."""
    return [t.name for t in spark.catalog.listTables(quote(zone)) if not t.isTemporary]


def schema_filter(
    df: DataFrame,
    include: Iterable[str] | None = None,
    exclude: Iterable[str] | None = None,
    col: str = "schema",
) -> DataFrame:
    """rows of the included schemas minus the excluded ones; ``None`` means all."""
    cond: Column = F.lit(True)
    if include:
        cond = cond & F.col(col).isin(list(include))
    if exclude:
        cond = cond & ~F.col(col).isin(list(exclude))
    return df.where(cond)


def _keep(name: str, include: Iterable[str] | None, exclude: Iterable[str] | None) -> bool:
    return (not include or name in set(include)) and not (exclude and name in set(exclude))


def table_metadata(
    spark: SparkSession,
    schemas: Iterable[str] | None = None,
    exclude: Iterable[str] | None = None,
    cluster: str = DEFAULT_CLUSTER,
    database: str = DEFAULT_DATABASE,
) -> DataFrame:
    """One row per column of every table in the selected schemas (databases).

    ``schemas`` / ``exclude`` follow F1 (``None`` = all).  The listing is catalog
    metadata gathered on the driver; its size is tables x columns, not data.
    """
    include = list(schemas) if schemas else None
    exclude = list(exclude) if exclude else None
    tables = [
        (db.name, t)
        for db in spark.catalog.listDatabases()
        if _keep(db.name, include, exclude)
        for t in spark.catalog.listTables(quote(db.name))
        if not t.isTemporary
    ]

    def columns(entry):
        db, t = entry
        cols = spark.catalog.listColumns(f"{quote(db)}.{quote(t.name)}")
        return [(database, cluster, db, t.name, t.tableType, t.description,
                 c.name, c.dataType, c.description, pos, bool(c.isPartition)) for pos, c in enumerate(cols)]

    # catalog calls are independent lookups; a few run at once, as the reference's
    # extractor ran its per-table queries
    with ThreadPoolExecutor(max_workers=CATALOG_THREADS) as pool:
        rows = [r for rs in pool.map(columns, tables) for r in rs]
    return spark.createDataFrame(rows, METADATA_SCHEMA)
