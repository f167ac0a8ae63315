"""Raw telemetry as a view over the `events` test table, in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from voltrail import contract

# The agreed expressions of the raw view, valid in both engines.
_COLUMNS = (
    "CAST(CASE WHEN event_type = 'signup' THEN event_id % 180 + 1 ELSE 0 END AS INT) AS Charging_Time_Remain_Minute",
    "CAST(event_id % 60 AS INT) AS Extender_Starting_Point",
    "CAST(400 + event_id % 200 AS INT) AS Fuel_CLTC_Mileage",
    "CAST(380 + event_id % 200 AS INT) AS Fuel_WLTC_Mileage",
    "CAST(floor(value) AS INT) % 101 AS Fuel_Percentage",
    "CAST(event_id % 3 AS INT) AS Clean_Mode",
    "CAST(event_id % 4 AS INT) AS Road_Mode",
    "event_type = 'error' AS RESS_Power_Low_Flag",
    "CAST(50 + event_id % 51 AS INT) AS Target_SOC",
    "CAST(value AS FLOAT) AS DISPLAY_SPEED",
    "CAST(event_id % 8 AS INT) AS channel_id",
    "CAST(event_id % 2 AS INT) AS Endurance_Type",
    "ts",
    "event_id AS __sequence",
    "CAST(0 AS TINYINT) AS __op_type",
)

_RAW_SQL = (
    "SELECT 'VIN' || lpad(CAST(user_id AS VARCHAR), 6, '0') AS vin_id, "
    + ", ".join(_COLUMNS)
    + " FROM events"
)

_CLEAN_COLUMNS = ", ".join(
    f"{f.raw_name} AS {f.name}" for f in contract.FIELDS if f.name != contract.KEY
)

# `raw` and `cleaned` for SQL texts to start from.
WITH_RAW = f"WITH raw AS ({_RAW_SQL})"
WITH_CLEANED = (
    f"{WITH_RAW}, cleaned AS (SELECT vin_id || '_' || CAST(ts AS VARCHAR) AS __primary_key, "
    f"{_CLEAN_COLUMNS} FROM raw)"
)


# Columns of the test tables in use.
SCHEMAS = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "labels": "doc_id bigint, quality int, toxic int",
    "pages": "page_id bigint, url string, html string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Declared columns, so that opening a table runs no job."""
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def raw_telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr(
        "concat('VIN', lpad(CAST(user_id AS STRING), 6, '0')) AS vin_id", *_COLUMNS
    )
