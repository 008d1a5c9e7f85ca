"""Registered queries: one callable (spark, sf_dir) -> DataFrame per operator group.

Every query reads the driver's tables (whole tables, no row subsets) or data Spark
derives from them.  Queries that exercise sinks write below the shared scratch root
(``spark.checkpoint.dir``) and read their output back.  Timestamps leave the wrappers
as ``timestamp_ntz`` (wall clock of the session zone) so that they compare with an
engine whose timestamps carry no zone.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.functions.casts import to_float_lenient, to_int_lenient, to_ts_lenient
from tidewater.functions.columns import (
    INGEST_RENAMES,
    YELLOW_LATE_RENAMES,
    canonical_case,
    col_of,
    rename_if_present,
)
from tidewater.operators.merge import merge_eras
from tidewater.plans import taxi
from tidewater.plans.standins import read_table, standin
from tidewater.session import scratch_path
from tidewater.sources.files import scan_csv
from tidewater.sources.tables import (
    append_table,
    ensure_zone,
    scan_table,
    table_name,
    write_overwrite,
    write_partitioned,
    write_replace,
)

Query = Callable[[SparkSession, str], DataFrame]


def as_ntz(df: DataFrame) -> DataFrame:
    """Session timestamps -> timestamp_ntz (same wall clock), other columns untouched."""
    out = []
    for f in df.schema.fields:
        c = col_of(f.name)
        out.append(c.cast("timestamp_ntz").alias(f.name) if isinstance(f.dataType, T.TimestampType) else c)
    return df.select(*out)


def _unique(prefix: str) -> str:
    return f"{prefix}_{uuid.uuid4().hex[:10]}"


def _raw(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A stand-in era as it sits in the raw zone (ingest renames applied)."""
    return taxi.raw_fix(standin(spark, sf_dir, name))


GREEN_ERAS = ("g1", "g2", "g3")


def _green_merged(spark, sf_dir):
    return merge_eras(*[_raw(spark, sf_dir, era) for era in GREEN_ERAS])


def _yellow_merged(spark, sf_dir):
    y2 = rename_if_present(_raw(spark, sf_dir, "y2"), YELLOW_LATE_RENAMES)
    return merge_eras(_raw(spark, sf_dir, "y1"), y2)


# ------------------------------------------------------------------ taxi side


def q_csv_scan_rename(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S1 + P1: the green eras written as CSV folders (real ``Trip_type `` header; the second
    era has one more column, the third another order), every file's header checked, the
    header groups read on their own and united by name."""
    root = scratch_path(spark, "csv_green")
    folders = [write_standin_csv(spark, sf_dir, era, f"{root}/{era}") for era in GREEN_ERAS]
    return taxi.raw_fix(scan_csv(spark, folders, by_name=True))


def q_table_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The merged green eras replaced into a zone table, overwritten
    from itself, read back."""
    zone = _unique("tw_raw")
    ensure_zone(spark, zone, scratch_path(spark, zone))
    name = table_name(zone, "green_taxi_merged")
    write_replace(_green_merged(spark, sf_dir), name)
    write_overwrite(scan_table(spark, zone, "green_taxi_merged"), name)  # self-read overwrite
    return scan_table(spark, zone, "green_taxi_merged")


def q_table_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3, S4, S6 with readers: a partitioned clean table is written, overwritten with more eras (its
    layout stays), replaced by another schema and restored.  Trips by year as each reader sees them:
    frames held across the replacements, the first version read by name, and the table at last."""
    from tidewater.sources.tables import restore_version, scan_version, versions

    zone = _unique("tw_versions")
    ensure_zone(spark, zone, scratch_path(spark, zone))
    name = table_name(zone, "green_clean")
    write_partitioned(taxi.clean_green(_raw(spark, sf_dir, "g2")), name)
    first = scan_table(spark, zone, "green_clean")
    write_overwrite(taxi.clean_green(_green_merged(spark, sf_dir)), name)
    second = scan_table(spark, zone, "green_clean")
    write_replace(_raw(spark, sf_dir, "y1"), name)
    third = scan_table(spark, zone, "green_clean")
    newest, middle, oldest = (v["version"] for v in versions(spark, name))
    restore_version(spark, name, middle)
    views = {"held first": first, "held second": second, "read first": scan_version(spark, name, oldest),
             "restored": scan_table(spark, zone, "green_clean")}
    by_year = [df.groupBy("pickup_year").agg(F.count(F.lit(1)).alias("n_trips"), F.sum("passenger_count").alias("n_passengers"))
               .select(F.lit(k).alias("reader"), "*") for k, df in views.items()]
    other = third.agg(F.count(F.lit(1)).alias("n_trips")).select(
        F.lit("held third").alias("reader"), F.lit(None).cast("int").alias("pickup_year"), "n_trips",
        F.lit(None).cast("long").alias("n_passengers"))
    return reduce(lambda a, b: a.unionByName(b), [*by_year, other])


def q_rename_if_present(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ingest renames, then the late-yellow renames, applied to each yellow era
    (no-ops where a name is absent), the eras united by name."""
    def renamed(era):
        return rename_if_present(rename_if_present(standin(spark, sf_dir, era), INGEST_RENAMES),
                                 YELLOW_LATE_RENAMES)
    return merge_eras(renamed("y1"), renamed("y2"))


def q_canonical_case(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lower-case spelling of the mixed-case green columns (both eras)."""
    green = _green_merged(spark, sf_dir)
    return canonical_case(green, [c.lower() for c in green.columns])


def q_lenient_int(spark: SparkSession, sf_dir: str) -> DataFrame:
    green = _green_merged(spark, sf_dir)
    return green.select(
        to_int_lenient("RateCodeID").alias("rate_code_id"),
        to_int_lenient("Passenger_count").alias("passenger_count"),
        to_int_lenient("Payment_type").alias("payment_type"),
        to_int_lenient("trip_type").alias("trip_type"),
        to_int_lenient("Fare_amount").alias("fare_amount_int"),
    )


def q_lenient_float(spark: SparkSession, sf_dir: str) -> DataFrame:
    green = _green_merged(spark, sf_dir)
    return green.select(
        to_float_lenient("Fare_amount").alias("fare_amount"),
        to_float_lenient("Trip_distance").alias("trip_distance"),
        to_float_lenient("Pickup_longitude").alias("pickup_longitude"),
        to_float_lenient("Payment_type").alias("payment_type_float"),
        to_float_lenient("Ehail_fee").alias("ehail_fee"),
        to_float_lenient("improvement_surcharge").alias("improvement_surcharge"),
    )


def q_lenient_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    green = _green_merged(spark, sf_dir)
    return as_ntz(green.select(
        to_ts_lenient("pickup_datetime").alias("pickup_datetime"),
        to_ts_lenient("dropoff_datetime").alias("dropoff_datetime"),
    ))


def q_year_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    green = _green_merged(spark, sf_dir)
    ts = to_ts_lenient("pickup_datetime")
    return green.select(F.year(ts).alias("pickup_year"), F.month(ts).alias("pickup_month"))


def q_merge_green_eras(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three green eras united by name (g1 has no improvement_surcharge)."""
    return _green_merged(spark, sf_dir)


def q_append_evolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The early yellow era written as a table, the renamed late one appended to it with its
    new columns."""
    zone = _unique("tw_yellow")
    ensure_zone(spark, zone, scratch_path(spark, zone))
    name = table_name(zone, "yellow_merged")
    write_replace(_raw(spark, sf_dir, "y1"), name)
    append_table(rename_if_present(_raw(spark, sf_dir, "y2"), YELLOW_LATE_RENAMES), name)
    return scan_table(spark, zone, "yellow_merged")


def q_clean_green(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_ntz(taxi.clean_green(_green_merged(spark, sf_dir)))


def q_clean_yellow(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_ntz(taxi.clean_yellow(_yellow_merged(spark, sf_dir)))


def q_processed(spark: SparkSession, sf_dir: str) -> DataFrame:
    green = taxi.clean_green(_green_merged(spark, sf_dir))
    yellow = taxi.clean_yellow(_yellow_merged(spark, sf_dir))
    return as_ntz(taxi.processed(green, yellow))


def q_partitioned_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean green written partitioned by (year, month) and read back whole (the
    NULL-pickup rows land in the default partition and survive)."""
    zone = _unique("tw_clean")
    ensure_zone(spark, zone, scratch_path(spark, zone))
    name = table_name(zone, "green_clean")
    write_partitioned(taxi.clean_green(_green_merged(spark, sf_dir)), name)
    return as_ntz(scan_table(spark, zone, "green_clean"))


# ------------------------------------------------------------------ metadata side

# Fixed values for the metadata queries: zone names, the tables each zone holds, the
# time column per table, and a fixed "now" (2024-01-20T00:00:00Z) for expiry.
WATERMARK_ZONE = "tw_watermarks"
WATERMARK_COLUMNS = {"orders": "o_orderdate", "lineitem": "l_shipdate", "events": "ts"}
PROFILE_ZONE = "tw_profiles"
PROFILE_TABLES = ("part", "customer", "region")
EXPIRY_NOW_MS = 1705708800000
CAP_ROWS_N = 5000
# Sums of doubles depend on the order of addition in their last digits.
REPORT_DIGITS = 10


def external_zone(spark: SparkSession, zone: str, sf_dir: str, tables) -> str:
    """A zone whose tables are the driver's Parquet files, registered in place
    (external tables: no copy; dropping them never touches the files)."""
    ensure_zone(spark, zone, scratch_path(spark, zone))
    for t in tables:
        name = table_name(zone, t)
        location = f"{sf_dir.rstrip('/')}/{t}.parquet".replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        spark.sql(f"CREATE TABLE {name} USING parquet LOCATION '{location}'")
    return zone


# The zones of the metadata refresh and what the raw and clean ones hold.
REFRESH_RAW, REFRESH_CLEAN, REFRESH_OTHER = "tw_refresh_raw", "tw_refresh_clean", "tw_refresh_other"


def refresh_zones(spark: SparkSession, sf_dir: str) -> list[str]:
    """A raw zone (the first green era, all text), a clean zone (all green eras, typed and laid out
    by month) and a zone that the metadata filter leaves out."""
    for zone in (REFRESH_RAW, REFRESH_CLEAN, REFRESH_OTHER):
        ensure_zone(spark, zone, scratch_path(spark, zone))
    write_replace(_raw(spark, sf_dir, "g1"), table_name(REFRESH_RAW, "green_taxi_pre2015"))
    write_partitioned(taxi.clean_green(_green_merged(spark, sf_dir)), table_name(REFRESH_CLEAN, "green_clean"))
    write_replace(read_table(spark, sf_dir, "nation"), table_name(REFRESH_OTHER, "nation"))
    return [REFRESH_RAW, REFRESH_CLEAN]


def refreshed(spark: SparkSession, sf_dir: str, zones: list[str] | None = None) -> dict[str, DataFrame]:
    """W4 over these zones (loaded first, unless given), published into an old graph of the events'
    relations."""
    from tidewater.operators.graph import NODE_SCHEMA
    from tidewater.plans.refresh import metadata_refresh

    zones = zones or refresh_zones(spark, sf_dir)
    old = (spark.createDataFrame([], NODE_SCHEMA), _event_edges(spark, sf_dir))
    return metadata_refresh(spark, [*zones, REFRESH_OTHER], EXPIRY_NOW_MS, graph=old, include=zones,
                            profile_digits=REPORT_DIGITS)


def q_list_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S8 over the refreshed zones, with the rows that each listed table has."""
    from tidewater.sources.catalog import list_tables, table_names

    zones = refresh_zones(spark, sf_dir)
    listed = reduce(lambda a, b: a.unionByName(b), [list_tables(spark, z) for z in zones])
    counts = [scan_table(spark, z, t).agg(F.count(F.lit(1)).alias("n_rows"))
              .select(F.lit(z).alias("database"), F.lit(t).alias("tableName"), "n_rows")
              for z in zones for t in table_names(spark, z)]
    return listed.join(reduce(lambda a, b: a.unionByName(b), counts), ["database", "tableName"], "left")


def q_table_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S9 and F1 over three zones, one of which the filter drops."""
    from tidewater.sources.catalog import schema_filter, table_metadata

    zones = refresh_zones(spark, sf_dir)
    meta = table_metadata(spark, [*zones, REFRESH_OTHER])
    return schema_filter(meta, include=zones).select("schema", "table_name", "column_name", "column_type",
                                                     "sort_order", "is_partition")


def q_metadata_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidewater.operators.graph import metadata_graph
    from tidewater.sources.catalog import table_metadata

    nodes, _ = metadata_graph(table_metadata(spark, refresh_zones(spark, sf_dir)))
    return nodes.select("key", "label", "name", F.col("attrs")["type"].alias("column_type"),
                        F.col("attrs")["sort_order"].cast("int").alias("sort_order"))


def q_metadata_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W4's published relations: those of the metadata, the watermarks and the profile
    statistics, and the old ones that did not expire."""
    return refreshed(spark, sf_dir)["edges"].select(
        "start_key", "start_label", "end_key", "end_label", "type", "reverse_type", "publish_tag", "last_updated")


def q_search_documents(spark: SparkSession, sf_dir: str, zones: list[str] | None = None) -> DataFrame:
    """M4 over the metadata graph of the refreshed zones (loaded first, unless given)."""
    from tidewater.operators.graph import metadata_graph, search_documents
    from tidewater.sources.catalog import table_metadata

    docs = search_documents(*metadata_graph(table_metadata(spark, zones or refresh_zones(spark, sf_dir))))
    return docs.select("key", "database", "cluster", "schema", "name", "description",
                       F.array_join("column_names", ",").alias("column_names"), "column_count")


def _events(spark, sf_dir):
    return read_table(spark, sf_dir, "events")


def q_high_watermark(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidewater.functions.casts import partition_label
    from tidewater.operators.watermark import high_watermark

    ev = _events(spark, sf_dir)
    hw = high_watermark(ev, "ts")
    return hw.select("high_watermark", partition_label("high_watermark", ev.schema["ts"].dataType).alias("part_name"))


def q_low_watermark(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidewater.functions.casts import partition_label
    from tidewater.operators.watermark import low_watermark

    ev = _events(spark, sf_dir)
    lw = low_watermark(ev, "ts")
    return lw.select("low_watermark", partition_label("low_watermark", ev.schema["ts"].dataType).alias("part_name"))


def q_schema_watermarks(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidewater.operators.watermark import watermarks

    external_zone(spark, WATERMARK_ZONE, sf_dir, WATERMARK_COLUMNS)
    return watermarks(spark, WATERMARK_ZONE, ts_col=WATERMARK_COLUMNS)


CLEAN_WM_ZONE = "tw_clean_wm"


def q_partitioned_watermarks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A3 over a clean zone laid out by (year, month)."""
    from tidewater.operators.watermark import watermarks

    ensure_zone(spark, CLEAN_WM_ZONE, scratch_path(spark, CLEAN_WM_ZONE))
    write_partitioned(taxi.clean_green(_green_merged(spark, sf_dir)), table_name(CLEAN_WM_ZONE, "green_clean"))
    return watermarks(spark, CLEAN_WM_ZONE)


def q_column_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A4 over the whole lineitem table (no cap)."""
    from tidewater.operators.profile import column_profile

    return column_profile(read_table(spark, sf_dir, "lineitem"), digits=REPORT_DIGITS)


def q_schema_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidewater.operators.profile import schema_profile

    external_zone(spark, PROFILE_ZONE, sf_dir, PROFILE_TABLES)
    return schema_profile(spark, PROFILE_ZONE, digits=REPORT_DIGITS)


def q_cap_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L1: the row cap is the operator under test (which rows is undefined: count)."""
    from tidewater.operators.profile import cap_rows

    return cap_rows(_events(spark, sf_dir), CAP_ROWS_N).agg(F.count(F.lit(1)).alias("n_rows"))


def _customer_nodes(spark, sf_dir):
    """Customer rows as graph nodes: a target (balance below 5000) and an incoming set
    (balance from 0 up, names upper-cased) that overlap; together they cover the table."""
    c = read_table(spark, sf_dir, "customer")
    node = lambda df, name: df.select(
        F.col("c_custkey").cast("string").alias("key"), F.lit("Customer").alias("label"), name.alias("name"),
        F.create_map(F.lit("segment"), F.col("c_mktsegment")).alias("attrs"))
    target = node(c.where(F.col("c_acctbal") < 5000), F.col("c_name"))
    incoming = node(c.where(F.col("c_acctbal") >= 0), F.upper("c_name"))
    return target, incoming


def q_insert_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidewater.operators.graph import insert_only

    target, incoming = _customer_nodes(spark, sf_dir)
    return insert_only(target, incoming).select("key", "label", "name")


def q_upsert_tagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidewater.operators.graph import upsert_tagged

    target, incoming = _customer_nodes(spark, sf_dir)
    return upsert_tagged(target, incoming, "wm_test", EXPIRY_NOW_MS).select(
        "key", "label", "name", "publish_tag", "last_updated")


def _event_edges(spark, sf_dir):
    ev = _events(spark, sf_dir)
    rel = F.when(F.col("event_type") == "view", "READ").when(F.col("event_type") == "click", "READ_BY") \
        .otherwise(F.upper("event_type"))
    return ev.select(
        F.concat(F.lit("user/"), F.col("user_id").cast("string")).alias("start_key"),
        F.lit("User").alias("start_label"),
        F.concat(F.lit("event/"), F.col("event_id").cast("string")).alias("end_key"),
        F.lit("Event").alias("end_label"),
        rel.alias("type"),
        F.concat(rel, F.lit("_OF")).alias("reverse_type"),
        F.expr("timestampdiff(MILLISECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts)").alias("last_updated"),
    )


def q_expire_relations(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidewater.operators.graph import expire_relations

    return expire_relations(_event_edges(spark, sf_dir), EXPIRY_NOW_MS)


def q_graph_zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M5 over graph tables: the events' relations kept in a zone by type and day, expired by their
    layout, kept again as the next version, and read back."""
    from tidewater.operators.graph import NODE_SCHEMA, expire_relations, load_graph, save_graph

    zone = _unique("tw_graph")
    ensure_zone(spark, zone, scratch_path(spark, zone))
    save_graph(spark.createDataFrame([], NODE_SCHEMA), _event_edges(spark, sf_dir), zone)
    nodes, edges = load_graph(spark, zone)
    save_graph(nodes, expire_relations(edges, EXPIRY_NOW_MS), zone)
    return load_graph(spark, zone)[1]


def q_append_folder(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S5 on a bare folder: the early yellow era appended, then the renamed late one with its new
    columns, read back by the folder's notes."""
    from tidewater.sources.files import append_evolve, read_evolved

    path, early = scratch_path(spark, "yellow_folder"), _raw(spark, sf_dir, "y1")
    append_evolve(early, path)
    append_evolve(rename_if_present(_raw(spark, sf_dir, "y2"), YELLOW_LATE_RENAMES), path)
    return read_evolved(spark, path, order=early.columns)


def q_watermark_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidewater.operators.graph import watermark_records

    nodes, edges = watermark_records(q_schema_watermarks(spark, sf_dir))
    n = nodes.select("key", "label", "name", F.col("attrs")["partition_key"].alias("partition_key"),
                     F.col("attrs")["partition_value"].alias("partition_value"),
                     F.col("attrs")["create_time"].alias("create_time"))
    e = edges.select(F.col("end_key").alias("key"), F.col("start_key").alias("table_key"), "type")
    return n.join(e, "key")


def q_profile_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidewater.operators.graph import profile_records

    nodes, edges = profile_records(q_schema_profile(spark, sf_dir))
    n = nodes.select("key", "label", "name", F.col("attrs")["stat_val"].cast("double").alias("stat_val"))
    e = edges.select(F.col("end_key").alias("key"), F.col("start_key").alias("column_key"), "type")
    return n.join(e, "key")


def q_ensure_zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The zone exists once, whatever the number of calls; its tables listed."""
    zone = _unique("tw_zone")
    loc = scratch_path(spark, zone)
    ensure_zone(spark, zone, loc)
    ensure_zone(spark, zone, loc)
    write_replace(read_table(spark, sf_dir, "region"), table_name(zone, "region"))
    return scan_table(spark, zone, "region")


def q_write_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W4's graph as node files by label and relationship files by type, read back."""
    from tidewater.sources.files import read_graph, write_graph

    out = refreshed(spark, sf_dir)
    path = scratch_path(spark, "graph")
    write_graph(out["nodes"], out["edges"], path)
    nodes = read_graph(spark, path, "nodes").select("key", F.col("label").alias("kind"), F.col("name").alias("other"))
    edges = read_graph(spark, path, "relationships").select(F.col("start_key").alias("key"), F.col("type").alias("kind"),
                                                            F.col("end_key").alias("other"))
    return nodes.unionByName(edges)


def q_write_search_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidewater.sources.files import write_search_docs

    path = scratch_path(spark, "search")
    write_search_docs(refreshed(spark, sf_dir)["search_docs"], path)
    back = spark.read.json(path)
    return back.select("key", "name", F.array_join("column_names", ",").alias("column_names"),
                       F.col("column_count").cast("int").alias("column_count"))


def q_write_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidewater.operators.profile import column_profile
    from tidewater.sources.files import write_profile

    path = scratch_path(spark, "profile")
    write_profile(column_profile(read_table(spark, sf_dir, "part"), digits=REPORT_DIGITS), path)
    back = spark.read.json(path)
    return back.select("column_name", F.col("count").cast("long").alias("count"),
                       F.col("n_distinct").cast("long").alias("n_distinct"), F.col("mean").cast("double").alias("mean"))


def q_metadata_refresh(spark: SparkSession, sf_dir: str, zones: list[str] | None = None) -> DataFrame:
    """W4 end to end: the published nodes (key, label, name) and, for watermarks, the value."""
    return refreshed(spark, sf_dir, zones)["nodes"].select(
        "key", "label", "name", F.col("attrs")["partition_value"].alias("partition_value"))


# Rows of a compressed landing file, which one task reads: about 120 MB of text.
LANDING_ROWS = 1_000_000


def write_standin_csv(spark: SparkSession, sf_dir: str, name: str, path: str, compression: str = "none") -> str:
    """A stand-in era as CSV files with its real header (``Trip_type `` included)."""
    files = {} if compression == "none" else {"maxRecordsPerFile": LANDING_ROWS}
    (standin(spark, sf_dir, name).write.options(header=True, compression=compression, **files)
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))
    return path


def q_taxi_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W1-W3 end to end through tables: gzipped CSV eras -> raw zone (S1, P1, S3) -> merged
    raw tables (U2) -> clean zone (partitioned) -> processed zone (U1, partitioned)."""
    root = scratch_path(spark, "taxi_load")
    raw, clean, proc = _unique("tw_raw"), _unique("tw_clean"), _unique("tw_processed")
    eras = {"g1": "green_taxi_pre2015", "g2": "green_taxi_2015_h1", "g3": "green_taxi_2015_h2_2016_h1",
            "y1": "yellow_taxi_pre2015", "y2": "yellow_taxi_2015_2016_h1"}
    for era, table in eras.items():
        folder = write_standin_csv(spark, sf_dir, era, f"{root}/landing/{era}", compression="gzip")
        taxi.ingest_raw(spark, [folder], raw, table, location=f"{root}/raw")
    taxi.load_green(spark, raw, [eras[era] for era in GREEN_ERAS], clean, clean_location=f"{root}/clean")
    taxi.load_yellow(spark, raw, [eras["y1"], eras["y2"]], clean, clean_location=f"{root}/clean")
    taxi.load_processed(spark, clean, proc, location=f"{root}/processed")
    return as_ntz(scan_table(spark, proc, "nyc_taxi_dataset"))


def q_stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S1 + P1 as a file stream: each green era's CSVs land in their own folder and an
    ``availableNow`` stream per era appends them to a raw Parquet target.  Each stream
    runs twice on one checkpoint: the second run finds no new file and adds nothing.
    Both targets read back, united by name."""
    from tidewater.sources.files import read_header
    from tidewater.streaming.ingest import ingest_new_files

    root = scratch_path(spark, "stream_green")
    frames = []
    for era in GREEN_ERAS:
        folder = write_standin_csv(spark, sf_dir, era, f"{root}/landing/{era}")
        header = read_header(spark, folder)
        target, ckpt = f"{root}/raw/{era}", f"{root}/checkpoints/{era}"
        for _ in range(2):
            ingest_new_files(spark, folder, header, target, ckpt).awaitTermination()
        frames.append(spark.read.parquet(target))
    return merge_eras(*frames)


QUERIES: dict[str, Query] = {
    "csv_scan_rename": q_csv_scan_rename,
    "stream_ingest": q_stream_ingest,
    "table_roundtrip": q_table_roundtrip,
    "table_versions": q_table_versions,
    "rename_if_present": q_rename_if_present,
    "canonical_case": q_canonical_case,
    "lenient_int": q_lenient_int,
    "lenient_float": q_lenient_float,
    "lenient_timestamp": q_lenient_timestamp,
    "year_month": q_year_month,
    "merge_green_eras": q_merge_green_eras,
    "append_evolve": q_append_evolve,
    "append_folder": q_append_folder,
    "clean_green": q_clean_green,
    "clean_yellow": q_clean_yellow,
    "processed": q_processed,
    "partitioned_write": q_partitioned_write,
    "taxi_load": q_taxi_load,
    "list_tables": q_list_tables,
    "table_metadata": q_table_metadata,
    "metadata_graph": q_metadata_graph,
    "metadata_edges": q_metadata_edges,
    "search_documents": q_search_documents,
    "high_watermark": q_high_watermark,
    "low_watermark": q_low_watermark,
    "schema_watermarks": q_schema_watermarks,
    "partitioned_watermarks": q_partitioned_watermarks,
    "column_profile": q_column_profile,
    "schema_profile": q_schema_profile,
    "cap_rows": q_cap_rows,
    "insert_only": q_insert_only,
    "upsert_tagged": q_upsert_tagged,
    "expire_relations": q_expire_relations,
    "graph_zone": q_graph_zone,
    "watermark_records": q_watermark_records,
    "profile_records": q_profile_records,
    "ensure_zone": q_ensure_zone,
    "write_graph": q_write_graph,
    "write_search_docs": q_write_search_docs,
    "write_profile": q_write_profile,
    "metadata_refresh": q_metadata_refresh,
}


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return q_processed(spark, sf_dir)


__all__ = ["QUERIES", "flagship", "as_ntz", "read_table"]
