"""Taxi lakehouse pipelines.

In-memory steps are DataFrame -> DataFrame: ``raw_fix`` (ingest renames),
``clean_green``, ``clean_yellow`` and ``processed``.  The table-level functions below
run the same steps between zone tables: ``raw`` per schema era, the merged raw table
per cab colour, ``clean`` and ``processed``, each written once.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.functions.casts import to_float_lenient, to_int_lenient, to_ts_lenient
from tidewater.functions.columns import (
    INGEST_RENAMES,
    YELLOW_LATE_RENAMES,
    Spec,
    copy_column,
    drop_columns,
    find_column,
    project,
    rename_if_present,
    resolve,
    surcharge_fold,
)
from tidewater.operators.merge import merge_eras, union_sources
from tidewater.sources.files import scan_csv
from tidewater.sources.tables import (
    ensure_zone,
    scan_table,
    table_name,
    unsorted_writes,
    write_overwrite,
    write_partitioned,
    write_replace,
)

# The clean green table, exactly these 24 columns in this order, with
# the source column each is read from and how it is typed.
GREEN_CLEAN_SPEC: Spec = [
    ("data_source", None, "lit:green"),
    ("pickup_year", None, "year:pickup_datetime"),
    ("pickup_month", None, "month:pickup_datetime"),
    ("vendor_id", "VendorID", "str"),
    ("pickup_datetime", "pickup_datetime", "ts"),
    ("dropoff_datetime", "dropoff_datetime", "ts"),
    ("store_and_fwd_flag", "Store_and_fwd_flag", "str"),
    ("rate_code_id", "RateCodeID", "int"),
    ("pickup_longitude", "Pickup_longitude", "float"),
    ("pickup_latitude", "Pickup_latitude", "float"),
    ("dropoff_longitude", "Dropoff_longitude", "float"),
    ("dropoff_latitude", "Dropoff_latitude", "float"),
    ("passenger_count", "Passenger_count", "int"),
    ("trip_distance", "Trip_distance", "float"),
    ("fare_amount", "Fare_amount", "float"),
    ("extra", "Extra", "float"),
    ("mta_tax", "MTA_tax", "float"),
    ("tip_amount", "Tip_amount", "float"),
    ("tolls_amount", "Tolls_amount", "float"),
    ("ehail_fee", "Ehail_fee", "float"),
    ("total_amount", "Total_amount", "float"),
    ("payment_type", "Payment_type", "int"),
    ("trip_type", "trip_type", "int"),
    ("improvement_surcharge", "improvement_surcharge", "float"),
]

# Yellow columns typed in place (others keep their text).
YELLOW_INT_COLUMNS = ("passenger_count", "payment_type")
YELLOW_FLOAT_COLUMNS = (
    "trip_distance", "pickup_longitude", "pickup_latitude", "dropoff_longitude",
    "dropoff_latitude", "fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount",
    "total_amount",
)


def raw_fix(df: DataFrame) -> DataFrame:
    """Ingest renames (P1) applied to a freshly scanned raw CSV frame."""
    return rename_if_present(df, INGEST_RENAMES)


def clean_green(merged: DataFrame) -> DataFrame:
    """P1-P9 over the merged raw green table: one projection, 24 typed columns."""
    return project(merged, GREEN_CLEAN_SPEC)


def clean_yellow(merged: DataFrame, surcharge: str = "replace") -> DataFrame:
    """P3-P7, P10, P11, P14 over the merged raw yellow table.

    The table keeps whatever columns it has, typed in place; ``rate_code`` stays text
    and is copied uncast to ``rate_code_id``; ``improvement_surcharge`` is taken from
    ``surcharge`` (see :func:`surcharge_fold`), which is then dropped; ``pickup_year``
    and ``pickup_month`` are appended.  One ``withColumns`` projection.
    """
    typed = ["pickup_datetime", "dropoff_datetime", *YELLOW_INT_COLUMNS, *YELLOW_FLOAT_COLUMNS,
             "rate_code_id", "improvement_surcharge", "pickup_year", "pickup_month"]
    # withColumns replaces case-insensitively and takes the new spelling; respell
    # first so a case-sensitive session gives the same table
    respell = {a: n for n, a in ((n, find_column(merged, n)) for n in typed) if a and a != n}
    base = merged.withColumnsRenamed(respell) if respell else merged
    pickup = to_ts_lenient(resolve(base, "pickup_datetime"))
    updates = {
        "pickup_datetime": pickup,
        "dropoff_datetime": to_ts_lenient(resolve(base, "dropoff_datetime")),
    }
    for c in YELLOW_INT_COLUMNS:
        if find_column(base, c):
            updates[c] = to_int_lenient(resolve(base, c))
    for c in YELLOW_FLOAT_COLUMNS:
        if find_column(base, c):
            updates[c] = to_float_lenient(resolve(base, c))
    updates["improvement_surcharge"] = surcharge_fold(base, surcharge)
    updates["pickup_year"] = F.year(pickup)
    updates["pickup_month"] = F.month(pickup)
    return drop_columns(copy_column(base, "rate_code", "rate_code_id").withColumns(updates), "surcharge")


def processed(green_clean: DataFrame, yellow_clean: DataFrame, tag_yellow: bool = False) -> DataFrame:
    """W3 in memory: U1 of the two clean tables (green's ``rate_code_id`` as text)."""
    return union_sources(green_clean, yellow_clean, tag_yellow=tag_yellow)


# ---------------------------------------------------------------- table-level jobs


def ingest_raw(spark: SparkSession, paths: Sequence[str], zone: str, table: str,
               location: str | None = None, by_name: bool = False) -> None:
    """S1 -> P1 -> S7 -> S3: CSVs into one raw zone table (rows and schema replaced)."""
    ensure_zone(spark, zone, location)
    write_replace(raw_fix(scan_csv(spark, paths, by_name=by_name)), table_name(zone, table))


def merge_raw(spark: SparkSession, zone: str, eras: Sequence[str], target: str,
              renames: Mapping[int, Mapping[str, str]] | None = None) -> None:
    """U2 + S4: merge era tables of a zone into one table with a single union write; a
    merged table of other columns is not overwritten."""
    frames = []
    for i, era in enumerate(eras):
        df = scan_table(spark, zone, era)
        if renames and i in renames:
            df = rename_if_present(df, renames[i])
        frames.append(df)
    write_overwrite(merge_eras(*frames), table_name(zone, target))


def load_green(spark: SparkSession, raw_zone: str, eras: Sequence[str], clean_zone: str,
               clean_location: str | None = None, merged: str = "green_merged",
               target: str = "green_clean") -> None:
    """W1 after ingest: merge the green eras, clean, write partitioned."""
    merge_raw(spark, raw_zone, eras, merged)
    ensure_zone(spark, clean_zone, clean_location)
    write_partitioned(clean_green(scan_table(spark, raw_zone, merged)), table_name(clean_zone, target))


def load_yellow(spark: SparkSession, raw_zone: str, eras: Sequence[str], clean_zone: str,
                clean_location: str | None = None, merged: str = "yellow_merged",
                target: str = "yellow_clean", surcharge: str = "replace") -> None:
    """W2 after ingest: the late era gets the yellow renames, then merge, clean, write."""
    late = {i: YELLOW_LATE_RENAMES for i in range(1, len(eras))}
    merge_raw(spark, raw_zone, eras, merged, renames=late)
    ensure_zone(spark, clean_zone, clean_location)
    write_partitioned(clean_yellow(scan_table(spark, raw_zone, merged), surcharge),
                      table_name(clean_zone, target))


def load_processed(spark: SparkSession, clean_zone: str, processed_zone: str,
                   location: str | None = None, green: str = "green_clean",
                   yellow: str = "yellow_clean", target: str = "nyc_taxi_dataset",
                   tag_yellow: bool = False) -> None:
    """Union the clean tables and write the processed table partitioned.

    Both inputs are already laid out by (year, month), so no shuffle is added here; a task's
    rows aren't sorted either, since its input files are of few months.
    """
    ensure_zone(spark, processed_zone, location)
    writer = unsorted_writes(spark)
    out = processed(scan_table(writer, clean_zone, green), scan_table(writer, clean_zone, yellow), tag_yellow)
    write_partitioned(out, table_name(processed_zone, target), rebalance=False, spark=spark)


__all__ = [
    "GREEN_CLEAN_SPEC", "raw_fix", "clean_green", "clean_yellow", "processed", "ingest_raw",
    "merge_raw", "load_green", "load_yellow", "load_processed",
]
