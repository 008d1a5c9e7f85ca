"""Oracle SQL (DuckDB dialect) for the registered queries.

Each text runs on the driver's tables as views and must give the same rows as the
Spark query of the same name.  Stand-ins enter as CTEs (same SQL text as in Spark).
Column names match the Spark side exactly; computed values are aliased alike.
"""

from __future__ import annotations

import re

from tidewater.plans.standins import STANDINS, cte

# Fixed values, stated here again so that a change of the library's shows.
INT_TEXT_PATTERN = "^([+-]?[0-9]+)([.][0-9]*)?$"
INGEST_RENAMES = {
    "Trip_type ": "trip_type",
    "lpep_pickup_datetime": "pickup_datetime",
    "Lpep_dropoff_datetime": "dropoff_datetime",
    "tpep_pickup_datetime": "pickup_datetime",
    "tpep_dropoff_datetime": "dropoff_datetime",
}
YELLOW_LATE_RENAMES = {"VendorID": "vendor_id", "RatecodeID": "rate_code"}

_ALIAS = re.compile(r"\bAS\s+([A-Za-z_]+)\s*(?:,|\n|$)")


def standin_columns(name: str) -> list[str]:
    """Output columns of a stand-in, in order (``Trip_type_`` is ``Trip_type ``)."""
    return [("Trip_type " if c == "Trip_type_" else c) for c in _ALIAS.findall(STANDINS[name])]


def sql_name(c: str) -> str:
    return "Trip_type_" if c == "Trip_type " else c


def q(c: str) -> str:
    return '"' + c + '"'


def renamed(cols: list[str], *mappings: dict[str, str]) -> list[tuple[str, str]]:
    """(source, output) pairs after case-insensitive renames, like P1."""
    out = []
    for c in cols:
        name = c
        for m in mappings:
            low = {k.lower(): v for k, v in m.items()}
            name = low.get(name.lower(), name)
        out.append((c, name))
    return out


def raw_select(name: str, *mappings: dict[str, str], src: str | None = None) -> str:
    pairs = renamed(standin_columns(name), INGEST_RENAMES, *mappings)
    items = ", ".join(f"{q(sql_name(s))} AS {q(o)}" for s, o in pairs)
    return f"SELECT {items} FROM {src or name}"


def INT(x: str) -> str:
    return f"TRY_CAST(regexp_extract(trim({x}), '{INT_TEXT_PATTERN}', 1) AS INTEGER)"


def FLT(x: str) -> str:
    return f"TRY_CAST({x} AS FLOAT)"


def TS(x: str) -> str:
    return f"TRY_CAST({x} AS TIMESTAMP)"


RAW_G1 = raw_select("g1")
RAW_G2 = raw_select("g2")
RAW_G3 = raw_select("g3")
RAW_Y1 = raw_select("y1")
RAW_Y2 = raw_select("y2", YELLOW_LATE_RENAMES)

GREEN_MERGED = f"({RAW_G1}) UNION ALL BY NAME ({RAW_G2}) UNION ALL BY NAME ({RAW_G3})"
# merged green columns: the first era's, then the second era's new ones
GREEN_MERGED_COLUMNS = [o for _, o in renamed(standin_columns("g1"), INGEST_RENAMES)]
GREEN_MERGED_COLUMNS += [o for _, o in renamed(standin_columns("g2"), INGEST_RENAMES)
                         if o.lower() not in {c.lower() for c in GREEN_MERGED_COLUMNS}]
YELLOW_MERGED = f"({RAW_Y1}) UNION ALL BY NAME ({RAW_Y2})"

CLEAN_GREEN_SELECT = f"""SELECT 'green' AS data_source,
  CAST(year({TS('pickup_datetime')}) AS INTEGER) AS pickup_year,
  CAST(month({TS('pickup_datetime')}) AS INTEGER) AS pickup_month,
  VendorID AS vendor_id, {TS('pickup_datetime')} AS pickup_datetime,
  {TS('dropoff_datetime')} AS dropoff_datetime, Store_and_fwd_flag AS store_and_fwd_flag,
  {INT('RateCodeID')} AS rate_code_id,
  {FLT('Pickup_longitude')} AS pickup_longitude, {FLT('Pickup_latitude')} AS pickup_latitude,
  {FLT('Dropoff_longitude')} AS dropoff_longitude, {FLT('Dropoff_latitude')} AS dropoff_latitude,
  {INT('Passenger_count')} AS passenger_count, {FLT('Trip_distance')} AS trip_distance,
  {FLT('Fare_amount')} AS fare_amount, {FLT('Extra')} AS extra, {FLT('MTA_tax')} AS mta_tax,
  {FLT('Tip_amount')} AS tip_amount, {FLT('Tolls_amount')} AS tolls_amount,
  {FLT('Ehail_fee')} AS ehail_fee, {FLT('Total_amount')} AS total_amount,
  {INT('Payment_type')} AS payment_type, {INT('trip_type')} AS trip_type,
  {FLT('improvement_surcharge')} AS improvement_surcharge
FROM green_merged"""

CLEAN_YELLOW_SELECT = f"""SELECT vendor_id, {TS('pickup_datetime')} AS pickup_datetime,
  {TS('dropoff_datetime')} AS dropoff_datetime, {INT('passenger_count')} AS passenger_count,
  {FLT('trip_distance')} AS trip_distance, {FLT('pickup_longitude')} AS pickup_longitude,
  {FLT('pickup_latitude')} AS pickup_latitude, rate_code,
  {FLT('dropoff_longitude')} AS dropoff_longitude, {FLT('dropoff_latitude')} AS dropoff_latitude,
  {INT('payment_type')} AS payment_type, {FLT('fare_amount')} AS fare_amount,
  {FLT('mta_tax')} AS mta_tax, {FLT('tip_amount')} AS tip_amount,
  {FLT('tolls_amount')} AS tolls_amount, {FLT('total_amount')} AS total_amount,
  {FLT('extra')} AS extra, {FLT('surcharge')} AS improvement_surcharge,
  rate_code AS rate_code_id,
  CAST(year({TS('pickup_datetime')}) AS INTEGER) AS pickup_year,
  CAST(month({TS('pickup_datetime')}) AS INTEGER) AS pickup_month
FROM yellow_merged"""

TAXI_CTE = (cte("g1", "g2", "g3", "y1", "y2").rstrip("\n")
            + f",\ngreen_merged AS ({GREEN_MERGED}),\nyellow_merged AS ({YELLOW_MERGED}),"
            + f"\ngreen_clean AS ({CLEAN_GREEN_SELECT}),\nyellow_clean AS ({CLEAN_YELLOW_SELECT})\n")

ORACLES: dict[str, str] = {
    "csv_scan_rename": cte("g1", "g2", "g3") + GREEN_MERGED,
    "stream_ingest": cte("g1", "g2", "g3") + GREEN_MERGED,
    "table_roundtrip": cte("g1", "g2", "g3") + GREEN_MERGED,
    "rename_if_present": cte("y1", "y2") + YELLOW_MERGED,
    "canonical_case": cte("g1", "g2", "g3") + "SELECT " + ", ".join(
        f"{q(o)} AS {q(o.lower())}" for o in GREEN_MERGED_COLUMNS) + f" FROM ({GREEN_MERGED})",
    "lenient_int": cte("g1", "g2", "g3") + f"""SELECT {INT('RateCodeID')} AS rate_code_id,
  {INT('Passenger_count')} AS passenger_count, {INT('Payment_type')} AS payment_type,
  {INT('trip_type')} AS trip_type, {INT('Fare_amount')} AS fare_amount_int FROM ({GREEN_MERGED})""",
    "lenient_float": cte("g1", "g2", "g3") + f"""SELECT {FLT('Fare_amount')} AS fare_amount,
  {FLT('Trip_distance')} AS trip_distance, {FLT('Pickup_longitude')} AS pickup_longitude,
  {FLT('Payment_type')} AS payment_type_float, {FLT('Ehail_fee')} AS ehail_fee,
  {FLT('improvement_surcharge')} AS improvement_surcharge FROM ({GREEN_MERGED})""",
    "lenient_timestamp": cte("g1", "g2", "g3") + f"""SELECT {TS('pickup_datetime')} AS pickup_datetime,
  {TS('dropoff_datetime')} AS dropoff_datetime FROM ({GREEN_MERGED})""",
    "year_month": cte("g1", "g2", "g3") + f"""SELECT CAST(year({TS('pickup_datetime')}) AS INTEGER) AS pickup_year,
  CAST(month({TS('pickup_datetime')}) AS INTEGER) AS pickup_month FROM ({GREEN_MERGED})""",
    "merge_green_eras": cte("g1", "g2", "g3") + GREEN_MERGED,
    "append_evolve": cte("y1", "y2") + YELLOW_MERGED,
    "append_folder": cte("y1", "y2") + YELLOW_MERGED,
    "clean_green": TAXI_CTE + "SELECT * FROM green_clean",
    "clean_yellow": TAXI_CTE + "SELECT * FROM yellow_clean",
    "processed": TAXI_CTE + """SELECT * REPLACE (CAST(rate_code_id AS VARCHAR) AS rate_code_id) FROM green_clean
UNION ALL BY NAME SELECT * FROM yellow_clean""",
    "taxi_load": TAXI_CTE + """SELECT * REPLACE (CAST(rate_code_id AS VARCHAR) AS rate_code_id) FROM green_clean
UNION ALL BY NAME SELECT * FROM yellow_clean""",
    "partitioned_write": TAXI_CTE + "SELECT * FROM green_clean",
    "table_versions": TAXI_CTE + f""", one_era AS (
  SELECT CAST(year({TS('pickup_datetime')}) AS INTEGER) AS pickup_year, {INT('Passenger_count')} AS passenger_count FROM ({RAW_G2})
), seen AS (
  SELECT reader, pickup_year, passenger_count FROM one_era, (SELECT unnest(['held first', 'read first']) AS reader)
  UNION ALL SELECT reader, pickup_year, passenger_count FROM green_clean, (SELECT unnest(['held second', 'restored']) AS reader)
)
SELECT reader, pickup_year, count(*) AS n_trips, CAST(sum(passenger_count) AS BIGINT) AS n_passengers FROM seen GROUP BY ALL
UNION ALL SELECT 'held third', NULL, count(*), NULL FROM ({RAW_Y1})""",
}


# ------------------------------------------------------------------ metadata side

WATERMARK_ZONE = "tw_watermarks"
WATERMARK_COLUMNS = {"orders": "o_orderdate", "lineitem": "l_shipdate", "events": "ts"}
PROFILE_ZONE = "tw_profiles"
PROFILE_TABLES = ("part", "customer", "region")
EXPIRY_NOW_MS = 1705708800000
CAP_ROWS_N = 5000
CLUSTER = "my_delta_environment"

# Numeric columns and their positions in the driver's tables (what a profile keeps).
NUMERIC_COLUMNS = {
    "lineitem": [("l_orderkey", 0), ("l_partkey", 1), ("l_suppkey", 2), ("l_linenumber", 3),
                 ("l_quantity", 4), ("l_extendedprice", 5), ("l_discount", 6), ("l_tax", 7)],
    "part": [("p_partkey", 0), ("p_size", 4), ("p_retailprice", 5)],
    "customer": [("c_custkey", 0), ("c_nationkey", 2), ("c_acctbal", 3)],
    "region": [("r_regionkey", 0)],
}
STAT_NAMES = ("count", "n_missing", "n_distinct", "n_zeros", "n_negative", "min", "max", "mean",
              "stddev", "variance", "sum", "range", "skewness", "kurtosis", "cv",
              "q05", "q25", "q50", "q75", "q95", "iqr")


def _in(names) -> str:
    return "(" + ", ".join(f"'{n}'" for n in names) + ")"


def TEXT(x: str) -> str:
    """Python-style text of a timestamp (fraction only when not zero)."""
    return (f"CASE WHEN strftime({x}, '%f') = '000000' THEN strftime({x}, '%Y-%m-%d %H:%M:%S') "
            f"ELSE strftime({x}, '%Y-%m-%d %H:%M:%S.%f') END")


def LABEL(x: str) -> str:
    return f"'ds=' || coalesce({TEXT(x)}, 'None')"


def SIG(x: str, digits: int = 10) -> str:
    e = f"floor(log10(abs({x})))"
    return (f"(CASE WHEN ({x}) = 0 THEN 0.0 WHEN ({x}) IS NULL OR isnan({x}) THEN ({x}) "
            f"WHEN {e} >= 0 THEN round(({x}) / pow(10, {e}), {digits - 1}) * pow(10, {e}) "
            f"ELSE round(({x}) * pow(10, -{e}), {digits - 1}) / pow(10, -{e}) END)")


def SHAPE(x: str) -> str:
    """Shape statistics (dimensionless) keep 8 decimals: cancellation noise near 0 goes."""
    return f"round({x}, 8)"


def profile_sql(table: str, column: str, position: int) -> str:
    x = "x"
    qs = {"q05": 0.05, "q25": 0.25, "q50": 0.5, "q75": 0.75, "q95": 0.95}
    parts = [
        f"'{column}' AS column_name", f"CAST({position} AS INTEGER) AS column_position",
        f"count({x}) AS count", f"count(*) - count({x}) AS n_missing", f"count(DISTINCT {x}) AS n_distinct",
        f"CAST(min({x}) AS DOUBLE) AS min", f"CAST(max({x}) AS DOUBLE) AS max", f"{SIG(f'avg({x})')} AS mean",
        f"{SIG(f'stddev_samp({x})')} AS stddev", f"{SIG(f'var_samp({x})')} AS variance",
        f"{SIG(f'sum({x})')} AS sum", f"{SIG(f'max({x}) - min({x})')} AS range",
        f"{SIG(SHAPE(f'CASE WHEN count({x}) < 3 THEN NULL WHEN var_pop({x}) = 0 THEN 0 ELSE skewness({x}) END'))} AS skewness",
        f"{SIG(SHAPE(f'CASE WHEN count({x}) < 4 THEN NULL WHEN var_pop({x}) = 0 THEN 0 ELSE kurtosis({x}) END'))} AS kurtosis",
        f"{SIG(f'CASE WHEN avg({x}) = 0 THEN NULL ELSE stddev_samp({x}) / avg({x}) END')} AS cv",
        *[f"{SIG(f'quantile_cont({x}, {q})')} AS {k}" for k, q in qs.items()],
        f"{SIG(f'quantile_cont({x}, 0.75) - quantile_cont({x}, 0.25)')} AS iqr",
        f"CAST(count(*) FILTER (WHERE {x} = 0) AS BIGINT) AS n_zeros",
        f"CAST(count(*) FILTER (WHERE {x} < 0) AS BIGINT) AS n_negative",
        *[f"CASE WHEN any_value(typeof({x})) IN ('BIGINT', 'INTEGER') THEN TRY_CAST({k}({x}) AS BIGINT) END AS {k}_int"
          for k in ("min", "max")],
    ]
    src = f"(SELECT CASE WHEN isnan(CAST({column} AS DOUBLE)) THEN NULL ELSE {column} END AS x FROM {table})"
    return "SELECT " + ",\n  ".join(parts) + f"\nFROM {src}"


def table_profile_sql(table: str, schema: str | None = None) -> str:
    head = f"'{schema}' AS schema, '{table}' AS table_name, " if schema else ""
    return "\nUNION ALL\n".join(
        f"SELECT {head}* FROM ({profile_sql(table, c, p)})" for c, p in NUMERIC_COLUMNS[table])


SCHEMA_PROFILE = "\nUNION ALL\n".join(table_profile_sql(t, PROFILE_ZONE) for t in PROFILE_TABLES)

SCHEMA_WATERMARKS = "\nUNION ALL\n".join(
    f"""SELECT {TEXT(f'{k}(x)')} AS create_time, 'default' AS database, '{WATERMARK_ZONE}' AS schema,
  '{t}' AS table_name, {LABEL(f'{k}(x)')} AS part_name, '{kind}' AS part_type, '{CLUSTER}' AS cluster
FROM (SELECT {c} AS x FROM {t})"""
    for t, c in WATERMARK_COLUMNS.items() for k, kind in (("max", "high_watermark"), ("min", "low_watermark")))

REFRESH_RAW, REFRESH_CLEAN = "tw_refresh_raw", "tw_refresh_clean"

# The columns of the refreshed tables, in catalog order (partition columns last).
RAW_GREEN_COLUMNS = (
    "VendorID pickup_datetime dropoff_datetime Store_and_fwd_flag RateCodeID Pickup_longitude Pickup_latitude "
    "Dropoff_longitude Dropoff_latitude Passenger_count Trip_distance Fare_amount Extra MTA_tax Tip_amount Tolls_amount "
    "Ehail_fee Total_amount Payment_type trip_type").split()
CLEAN_GREEN_COLUMNS = {
    "data_source": "string", "vendor_id": "string", "pickup_datetime": "timestamp", "dropoff_datetime": "timestamp",
    "store_and_fwd_flag": "string", "rate_code_id": "int", "pickup_longitude": "float", "pickup_latitude": "float",
    "dropoff_longitude": "float", "dropoff_latitude": "float", "passenger_count": "int", "trip_distance": "float",
    "fare_amount": "float", "extra": "float", "mta_tax": "float", "tip_amount": "float", "tolls_amount": "float",
    "ehail_fee": "float", "total_amount": "float", "payment_type": "int", "trip_type": "int",
    "improvement_surcharge": "float", "pickup_year": "int", "pickup_month": "int",
}


def _catalog_rows() -> str:
    rows = [(REFRESH_RAW, "green_taxi_pre2015", c, "string", i, "false") for i, c in enumerate(RAW_GREEN_COLUMNS)]
    rows += [(REFRESH_CLEAN, "green_clean", c, t, i, "true" if c in ("pickup_year", "pickup_month") else "false")
             for i, (c, t) in enumerate(CLEAN_GREEN_COLUMNS.items())]
    return ",\n  ".join(f"('{z}', '{t}', '{c}', '{k}', {i}, {part})" for z, t, c, k, i, part in rows)


CATALOG = f"""catalog(schema, table_name, column_name, column_type, sort_order, is_partition) AS (VALUES
  {_catalog_rows()}),
keyed AS (SELECT *, 'default://{CLUSTER}.' || schema AS sk, 'default://{CLUSTER}.' || schema || '/' || table_name AS tk,
                 'default://{CLUSTER}.' || schema || '/' || table_name || '/' || column_name AS ck FROM catalog)"""

CATALOG_NODES = """SELECT 'database://default' AS key, 'Database' AS label, 'default' AS name,
       CAST(NULL AS VARCHAR) AS column_type, CAST(NULL AS INTEGER) AS sort_order
UNION ALL SELECT 'default://%s', 'Cluster', '%s', NULL, NULL
UNION ALL SELECT DISTINCT sk, 'Schema', schema, NULL, NULL FROM keyed
UNION ALL SELECT DISTINCT tk, 'Table', table_name, NULL, NULL FROM keyed
UNION ALL SELECT ck, 'Column', column_name, column_type, sort_order FROM keyed""" % (CLUSTER, CLUSTER)

# raw: the time column is text there, its extremes are lexical
REFRESH_MARKS = f"""marks AS (
  SELECT '{REFRESH_RAW}' AS schema, 'green_taxi_pre2015' AS table_name, 'high_watermark' AS kind, max(lpep_pickup_datetime) AS v FROM g1
  UNION ALL SELECT '{REFRESH_RAW}', 'green_taxi_pre2015', 'low_watermark', min(lpep_pickup_datetime) FROM g1
  UNION ALL SELECT '{REFRESH_CLEAN}', 'green_clean', 'high_watermark', {TEXT('max(pickup_datetime)')} FROM green_clean
  UNION ALL SELECT '{REFRESH_CLEAN}', 'green_clean', 'low_watermark', {TEXT('min(pickup_datetime)')} FROM green_clean)"""

REFRESH_STATS = f"""stats AS (SELECT ck || '/' || s || '/' AS key, ck, s AS name
  FROM keyed, (SELECT unnest([{", ".join(f"'{s}'" for s in STAT_NAMES)}]) AS s)
  WHERE schema = '{REFRESH_CLEAN}' AND column_type IN ('int', 'float'))"""

REFRESH_CTE = TAXI_CTE.rstrip("\n") + f",\n{CATALOG},\n{REFRESH_MARKS},\n{REFRESH_STATS}"

SEARCH_DOCS = f"""{REFRESH_CTE}
SELECT tk AS key, 'default' AS database, '{CLUSTER}' AS cluster, schema, table_name AS name,
       CAST(NULL AS VARCHAR) AS description, string_agg(column_name, ',' ORDER BY sort_order) AS column_names,
       CAST(count(*) AS INTEGER) AS column_count
FROM keyed GROUP BY tk, schema, table_name"""

CUSTOMER_NODES = """t AS (SELECT CAST(c_custkey AS VARCHAR) AS key, 'Customer' AS label, c_name AS name
       FROM customer WHERE c_acctbal < 5000),
i AS (SELECT CAST(c_custkey AS VARCHAR) AS key, 'Customer' AS label, upper(c_name) AS name
       FROM customer WHERE c_acctbal >= 0)"""

EVENT_EDGES = """edges AS (
  SELECT 'user/' || CAST(user_id AS VARCHAR) AS start_key, 'User' AS start_label,
         'event/' || CAST(event_id AS VARCHAR) AS end_key, 'Event' AS end_label,
         CASE WHEN event_type = 'view' THEN 'READ' WHEN event_type = 'click' THEN 'READ_BY'
              ELSE upper(event_type) END AS type,
         (CASE WHEN event_type = 'view' THEN 'READ' WHEN event_type = 'click' THEN 'READ_BY'
              ELSE upper(event_type) END) || '_OF' AS reverse_type,
         epoch_us(ts) // 1000 AS last_updated
  FROM events)"""

PROFILE_RECORDS = f"""WITH p AS ({SCHEMA_PROFILE}),
pd AS (SELECT schema, table_name, column_name, {", ".join(f"CAST({s} AS DOUBLE) AS {s}" for s in STAT_NAMES)} FROM p),
longp AS (
  SELECT * FROM pd UNPIVOT INCLUDE NULLS (stat_val FOR stat_name IN ({", ".join(STAT_NAMES)})))
SELECT 'default://{CLUSTER}.' || schema || '/' || table_name || '/' || column_name || '/' || stat_name || '/' AS key,
       'Stat' AS label, stat_name AS name, stat_val,
       'default://{CLUSTER}.' || schema || '/' || table_name || '/' || column_name AS column_key,
       'STAT' AS type
FROM longp"""

ORACLES.update({
    "list_tables": TAXI_CTE + f"""SELECT '{REFRESH_RAW}' AS database, 'green_taxi_pre2015' AS tableName,
  false AS isTemporary, count(*) AS n_rows FROM g1
UNION ALL SELECT '{REFRESH_CLEAN}', 'green_clean', false, count(*) FROM green_clean""",
    "table_metadata": f"""WITH {CATALOG}
SELECT schema, table_name, column_name, column_type, sort_order, is_partition FROM catalog""",
    "metadata_graph": f"WITH {CATALOG}\n{CATALOG_NODES}",
    "metadata_edges": f"""{REFRESH_CTE},
{EVENT_EDGES},
own AS (
  SELECT 'database://default' AS start_key, 'Database' AS start_label, 'default://{CLUSTER}' AS end_key,
         'Cluster' AS end_label, 'CLUSTER' AS type, 'CLUSTER_OF' AS reverse_type, 'some_unique_tag' AS publish_tag
  UNION ALL SELECT DISTINCT 'default://{CLUSTER}', 'Cluster', sk, 'Schema', 'SCHEMA', 'SCHEMA_OF', 'some_unique_tag' FROM keyed
  UNION ALL SELECT DISTINCT sk, 'Schema', tk, 'Table', 'TABLE', 'TABLE_OF', 'some_unique_tag' FROM keyed
  UNION ALL SELECT tk, 'Table', ck, 'Column', 'COLUMN', 'COLUMN_OF', 'some_unique_tag' FROM keyed
  UNION ALL SELECT 'default://{CLUSTER}.' || schema || '/' || table_name, 'Table',
         'default://{CLUSTER}.' || schema || '/' || table_name || '/' || kind || '/', 'Watermark', 'WATERMARK',
         'BELONG_TO_TABLE', 'wm_test' FROM marks
  UNION ALL SELECT ck, 'Column', key, 'Stat', 'STAT', 'STAT_OF', 'wm_test' FROM stats)
SELECT *, CAST({EXPIRY_NOW_MS} AS BIGINT) AS last_updated FROM own
UNION ALL BY NAME SELECT * FROM edges
WHERE NOT (type IN ('READ', 'READ_BY') AND last_updated < {EXPIRY_NOW_MS} - 86400000 * 3)""",
    "search_documents": SEARCH_DOCS,
    "high_watermark": f"SELECT max(ts) AS high_watermark, {LABEL('max(ts)')} AS part_name FROM events",
    "low_watermark": f"SELECT min(ts) AS low_watermark, {LABEL('min(ts)')} AS part_name FROM events",
    "schema_watermarks": SCHEMA_WATERMARKS,
    "partitioned_watermarks": TAXI_CTE + "\nUNION ALL\n".join(
        f"""SELECT {TEXT(f'{k}(pickup_datetime)')} AS create_time, 'default' AS database,
  'tw_clean_wm' AS schema, 'green_clean' AS table_name, {LABEL(f'{k}(pickup_datetime)')} AS part_name,
  '{kind}' AS part_type, '{CLUSTER}' AS cluster FROM green_clean"""
        for k, kind in (("max", "high_watermark"), ("min", "low_watermark"))),
    "column_profile": table_profile_sql("lineitem"),
    "schema_profile": SCHEMA_PROFILE,
    "cap_rows": f"SELECT least(count(*), {CAP_ROWS_N}) AS n_rows FROM events",
    "insert_only": f"""WITH {CUSTOMER_NODES}
SELECT * FROM t UNION ALL SELECT * FROM i WHERE key NOT IN (SELECT key FROM t)""",
    "upsert_tagged": f"""WITH {CUSTOMER_NODES}
SELECT key, label, name, CAST(NULL AS VARCHAR) AS publish_tag, CAST(NULL AS BIGINT) AS last_updated
FROM t WHERE key NOT IN (SELECT key FROM i)
UNION ALL SELECT key, label, name, 'wm_test', CAST({EXPIRY_NOW_MS} AS BIGINT) FROM i""",
    "expire_relations": f"""WITH {EVENT_EDGES}
SELECT * FROM edges
WHERE NOT (type IN ('READ', 'READ_BY') AND last_updated < {EXPIRY_NOW_MS} - 86400000 * 3)""",
    "graph_zone": f"""WITH {EVENT_EDGES}
SELECT *, CAST(to_timestamp(last_updated // 1000) AT TIME ZONE 'UTC' AS DATE) AS updated_day FROM edges
WHERE NOT (type IN ('READ', 'READ_BY') AND last_updated < {EXPIRY_NOW_MS} - 86400000 * 3)""",
    "watermark_records": f"""WITH w AS ({SCHEMA_WATERMARKS})
SELECT 'default://{CLUSTER}.' || schema || '/' || table_name || '/' || part_type || '/' AS key,
       'Watermark' AS label, part_type AS name, split_part(part_name, '=', 1) AS partition_key,
       substr(part_name, strpos(part_name, '=') + 1) AS partition_value, create_time,
       'default://{CLUSTER}.' || schema || '/' || table_name AS table_key, 'WATERMARK' AS type
FROM w""",
    "profile_records": PROFILE_RECORDS,
    "ensure_zone": "SELECT * FROM region",
    "write_graph": f"""{REFRESH_CTE},
{EVENT_EDGES}
SELECT key, label AS kind, name AS other FROM ({CATALOG_NODES})
UNION ALL SELECT key, 'Stat', name FROM stats
UNION ALL SELECT 'default://{CLUSTER}.' || schema || '/' || table_name || '/' || kind || '/', 'Watermark', kind FROM marks
UNION ALL SELECT 'database://default', 'CLUSTER', 'default://{CLUSTER}'
UNION ALL SELECT DISTINCT 'default://{CLUSTER}', 'SCHEMA', sk FROM keyed
UNION ALL SELECT DISTINCT sk, 'TABLE', tk FROM keyed
UNION ALL SELECT tk, 'COLUMN', ck FROM keyed
UNION ALL SELECT 'default://{CLUSTER}.' || schema || '/' || table_name, 'WATERMARK',
       'default://{CLUSTER}.' || schema || '/' || table_name || '/' || kind || '/' FROM marks
UNION ALL SELECT ck, 'STAT', key FROM stats
UNION ALL SELECT start_key, type, end_key FROM edges
WHERE NOT (type IN ('READ', 'READ_BY') AND last_updated < {EXPIRY_NOW_MS} - 86400000 * 3)""",
    "write_search_docs": f"SELECT key, name, column_names, column_count FROM ({SEARCH_DOCS})",
    "write_profile": f"SELECT column_name, count, n_distinct, mean FROM ({table_profile_sql('part')})",
    "metadata_refresh": f"""{REFRESH_CTE}
SELECT key, label, name, CAST(NULL AS VARCHAR) AS partition_value FROM ({CATALOG_NODES})
UNION ALL SELECT key, 'Stat', name, NULL FROM stats
UNION ALL SELECT 'default://{CLUSTER}.' || schema || '/' || table_name || '/' || kind || '/', 'Watermark', kind, v FROM marks""",
})
