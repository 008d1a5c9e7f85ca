"""Deterministic raw-era stand-ins built from the driver's tables.

Each stand-in is one SQL text that runs unchanged in Spark SQL and in DuckDB, so the
same text serves the Spark query (via ``spark.sql(text, lineitem=df)``) and the
oracle (as a CTE).  They turn ``lineitem`` / ``orders`` rows into all-text trip
records with the header spellings of the real schema eras, and plant bad values:
an unparsable pickup (line 7), a non-numeric payment type (line 5) and a fractional
rate code (line 6).  ``Trip_type_`` stands for the header with a trailing blank.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

G1 = """SELECT CAST(l_suppkey % 2 + 1 AS STRING) AS VendorID,
       CASE WHEN l_linenumber = 7 THEN 'n/a' ELSE CAST(l_shipdate AS STRING) END AS lpep_pickup_datetime,
       CAST(l_shipdate + INTERVAL 1 DAY AS STRING) AS Lpep_dropoff_datetime,
       l_returnflag AS Store_and_fwd_flag,
       CASE WHEN l_linenumber = 6 THEN '1.5' ELSE CAST(l_linenumber AS STRING) END AS RateCodeID,
       CAST(l_tax AS STRING) AS Pickup_longitude, CAST(l_discount AS STRING) AS Pickup_latitude,
       CAST(l_discount AS STRING) AS Dropoff_longitude, CAST(l_tax AS STRING) AS Dropoff_latitude,
       CAST(l_linenumber AS STRING) AS Passenger_count, CAST(l_quantity AS STRING) AS Trip_distance,
       CAST(l_extendedprice AS STRING) AS Fare_amount, CAST(l_tax AS STRING) AS Extra,
       CAST(l_tax AS STRING) AS MTA_tax, CAST(l_discount AS STRING) AS Tip_amount,
       CAST(l_discount AS STRING) AS Tolls_amount, CAST(NULL AS STRING) AS Ehail_fee,
       CAST(l_extendedprice AS STRING) AS Total_amount,
       CASE WHEN l_linenumber = 5 THEN 'CRD' ELSE CAST(l_linenumber AS STRING) END AS Payment_type,
       CAST(l_linenumber % 2 + 1 AS STRING) AS Trip_type_
FROM lineitem WHERE l_shipdate < TIMESTAMP '1997-01-01 00:00:00'"""

G2 = """SELECT CAST(l_suppkey % 2 + 1 AS STRING) AS VendorID,
       CAST(l_shipdate AS STRING) AS lpep_pickup_datetime,
       CAST(l_shipdate + INTERVAL 1 DAY AS STRING) AS Lpep_dropoff_datetime,
       l_returnflag AS Store_and_fwd_flag, CAST(l_linenumber AS STRING) AS RateCodeID,
       CAST(l_tax AS STRING) AS Pickup_longitude, CAST(l_discount AS STRING) AS Pickup_latitude,
       CAST(l_discount AS STRING) AS Dropoff_longitude, CAST(l_tax AS STRING) AS Dropoff_latitude,
       CAST(l_linenumber AS STRING) AS Passenger_count, CAST(l_quantity AS STRING) AS Trip_distance,
       CAST(l_extendedprice AS STRING) AS Fare_amount, CAST(l_tax AS STRING) AS Extra,
       CAST(l_tax AS STRING) AS MTA_tax, CAST(l_discount AS STRING) AS Tip_amount,
       CAST(l_discount AS STRING) AS Tolls_amount, CAST(NULL AS STRING) AS Ehail_fee,
       CAST(l_discount AS STRING) AS improvement_surcharge,
       CAST(l_extendedprice AS STRING) AS Total_amount, CAST(l_linenumber AS STRING) AS Payment_type,
       CAST(l_linenumber % 2 + 1 AS STRING) AS Trip_type_
FROM lineitem WHERE l_shipdate >= TIMESTAMP '1997-01-01 00:00:00' AND l_shipdate < TIMESTAMP '1998-01-01 00:00:00'"""

# the third era holds the second one's columns in another order
G3 = """SELECT CAST(l_linenumber % 2 + 1 AS STRING) AS Trip_type_,
       CAST(l_shipdate AS STRING) AS lpep_pickup_datetime,
       CAST(l_shipdate + INTERVAL 1 DAY AS STRING) AS Lpep_dropoff_datetime,
       CAST(l_suppkey % 2 + 1 AS STRING) AS VendorID,
       CAST(l_linenumber AS STRING) AS Payment_type, CAST(l_extendedprice AS STRING) AS Total_amount,
       CAST(l_tax AS STRING) AS improvement_surcharge, CAST(NULL AS STRING) AS Ehail_fee,
       CAST(l_discount AS STRING) AS Tolls_amount, CAST(l_discount AS STRING) AS Tip_amount,
       CAST(l_tax AS STRING) AS MTA_tax, CAST(l_tax AS STRING) AS Extra,
       CAST(l_extendedprice AS STRING) AS Fare_amount, CAST(l_quantity AS STRING) AS Trip_distance,
       CAST(l_linenumber AS STRING) AS Passenger_count, CAST(l_tax AS STRING) AS Dropoff_latitude,
       CAST(l_discount AS STRING) AS Dropoff_longitude, CAST(l_discount AS STRING) AS Pickup_latitude,
       CAST(l_tax AS STRING) AS Pickup_longitude, CAST(l_linenumber AS STRING) AS RateCodeID,
       l_returnflag AS Store_and_fwd_flag
FROM lineitem WHERE l_shipdate >= TIMESTAMP '1998-01-01 00:00:00'"""

Y1 = """SELECT CAST(o_custkey % 2 + 1 AS STRING) AS vendor_id,
       CAST(o_orderdate AS STRING) AS pickup_datetime,
       CAST(o_orderdate + INTERVAL 1 DAY AS STRING) AS dropoff_datetime,
       CAST(o_custkey % 6 AS STRING) AS passenger_count, CAST(o_custkey % 50 AS STRING) AS trip_distance,
       '1.25' AS pickup_longitude, '2.5' AS pickup_latitude, o_orderstatus AS rate_code,
       '3.75' AS dropoff_longitude, '4.5' AS dropoff_latitude, o_orderpriority AS payment_type,
       CAST(o_totalprice AS STRING) AS fare_amount, '0.5' AS surcharge, '0.25' AS mta_tax,
       '1.0' AS tip_amount, '0.0' AS tolls_amount, CAST(o_totalprice AS STRING) AS total_amount
FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01 00:00:00'"""

Y2 = """SELECT CAST(o_custkey % 2 + 1 AS STRING) AS VendorID,
       CAST(o_orderdate AS STRING) AS tpep_pickup_datetime,
       CAST(o_orderdate + INTERVAL 1 DAY AS STRING) AS tpep_dropoff_datetime,
       CAST(o_custkey % 6 AS STRING) AS passenger_count, CAST(o_custkey % 50 AS STRING) AS trip_distance,
       '1.25' AS pickup_longitude, '2.5' AS pickup_latitude, CAST(o_custkey % 5 AS STRING) AS RatecodeID,
       '3.75' AS dropoff_longitude, '4.5' AS dropoff_latitude, CAST(o_custkey % 4 AS STRING) AS payment_type,
       CAST(o_totalprice AS STRING) AS fare_amount, '0.5' AS extra, '0.25' AS mta_tax,
       '1.0' AS tip_amount, '0.0' AS tolls_amount, '0.3' AS improvement_surcharge,
       CAST(o_totalprice AS STRING) AS total_amount
FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01 00:00:00'"""

STANDINS = {"g1": G1, "g2": G2, "g3": G3, "y1": Y1, "y2": Y2}
SOURCE_TABLE = {"g1": "lineitem", "g2": "lineitem", "g3": "lineitem", "y1": "orders", "y2": "orders"}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def standin(spark: SparkSession, sf_dir: str, name: str, trailing_blank: bool = True) -> DataFrame:
    """One raw-era stand-in as a Spark frame; ``Trip_type_`` becomes ``Trip_type ``."""
    src = SOURCE_TABLE[name]
    df = spark.sql(STANDINS[name].replace(f"FROM {src}", f"FROM {{{src}}}"),
                   **{src: read_table(spark, sf_dir, src)})
    if trailing_blank and "Trip_type_" in df.columns:
        df = df.withColumnRenamed("Trip_type_", "Trip_type ")
    return df


def cte(*names: str) -> str:
    """``WITH`` clause defining the named stand-ins for an oracle query."""
    return "WITH " + ",\n".join(f"{n} AS (\n{STANDINS[n]}\n)" for n in names) + "\n"
