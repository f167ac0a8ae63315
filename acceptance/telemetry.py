"""Cleaning, summaries, audits."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from acceptance.telemetry_view import WITH_CLEANED, WITH_RAW, raw_telemetry
from voltrail import contract
from voltrail.operators import audit, summaries
from voltrail.operators.clean import clean
from voltrail.sources.telemetry import SAMPLE_ROWS, sample_rows


def cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean(raw_telemetry(spark, sf_dir))


def vehicle_daily_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summaries.daily_summary(cleaned(spark, sf_dir))


def charging_behavior_analysis(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summaries.charging_behavior(cleaned(spark, sf_dir))


def driving_mode_analysis(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summaries.driving_modes(cleaned(spark, sf_dir))


def telemetry_primary_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaned(spark, sf_dir).select("vin_id", "ts", contract.KEY)


def row_count_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = raw_telemetry(spark, sf_dir)
    return audit.row_count_audit(raw, clean(raw))


def schema_contract_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One column of a wrong type, one missing, one extra."""
    odd = (
        raw_telemetry(spark, sf_dir)
        .withColumn("Road_Mode", F.col("Road_Mode") == 1)
        .withColumn("Target_SOC", F.col("Target_SOC").cast("bigint"))
        .drop("DISPLAY_SPEED")
        .withColumn("cabin_temp", F.when(F.col("RESS_Power_Low_Flag"), 21.5))
    )
    return contract.contract_report(odd)


def missing_column_null_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean(raw_telemetry(spark, sf_dir).drop("DISPLAY_SPEED"))


def telemetry_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.preview(cleaned(spark, sf_dir), [contract.KEY, "channel_id"], 10)


SAMPLE_TIME = dt.datetime(2024, 1, 1)


def sample_rows_added(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sample rows next to the telemetry, through the daily summary."""
    rows = cleaned(spark, sf_dir).unionByName(
        sample_rows(spark, SAMPLE_TIME, T.TimestampNTZType())
    )
    return summaries.daily_summary(rows)


def table_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the three summaries, from one scan."""
    return audit.summary_stats(summaries.mode_rollup(cleaned(spark, sf_dir)))


QUERIES = {
    "vehicle_daily_summary": vehicle_daily_summary,
    "charging_behavior_analysis": charging_behavior_analysis,
    "driving_mode_analysis": driving_mode_analysis,
    "clean_telemetry": cleaned,
    "telemetry_primary_key": telemetry_primary_key,
    "row_count_audit": row_count_audit,
    "schema_contract_report": schema_contract_report,
    "missing_column_null_fill": missing_column_null_fill,
    "telemetry_preview": telemetry_preview,
    "sample_rows": sample_rows_added,
    "table_stats": table_stats,
}

_COLUMN_LIST = ", ".join(contract.COLUMNS)

DAILY_BODY = """
SELECT vin_id, CAST(ts AS DATE) AS date,
       AVG(fuel_percentage) AS avg_fuel_percentage,
       MIN(fuel_percentage) AS min_fuel_percentage,
       MAX(fuel_percentage) AS max_fuel_percentage,
       AVG(display_speed) AS avg_display_speed,
       MAX(display_speed) AS max_display_speed,
       AVG(target_soc) AS avg_target_soc,
       COUNT(*) AS record_count,
       MIN(ts) AS first_record_time,
       MAX(ts) AS last_record_time
FROM {source} GROUP BY vin_id, CAST(ts AS DATE)
"""

CHARGING_BODY = """
SELECT vin_id, CAST(ts AS DATE) AS date,
       AVG(charging_time_remain_minute) AS avg_charging_time_remain,
       MAX(charging_time_remain_minute) AS max_charging_time_remain,
       COUNT(*) FILTER (WHERE charging_time_remain_minute > 0) AS charging_sessions,
       AVG(fuel_percentage) FILTER (WHERE charging_time_remain_minute > 0) AS avg_fuel_during_charging,
       COUNT(*) AS total_records
FROM {source} GROUP BY vin_id, CAST(ts AS DATE)
"""

DRIVING_BODY = """
SELECT vin_id, CAST(ts AS DATE) AS date, clean_mode, road_mode,
       COUNT(*) AS mode_usage_count,
       AVG(display_speed) AS avg_speed_in_mode,
       AVG(fuel_percentage) AS avg_fuel_in_mode,
       COUNT(*) FILTER (WHERE ress_power_low_flag) AS low_power_incidents
FROM {source} GROUP BY vin_id, CAST(ts AS DATE), clean_mode, road_mode
"""

DAILY_SQL = WITH_CLEANED + DAILY_BODY.format(source="cleaned")
CHARGING_SQL = WITH_CLEANED + CHARGING_BODY.format(source="cleaned")
DRIVING_SQL = WITH_CLEANED + DRIVING_BODY.format(source="cleaned")


def _sample_sql() -> str:
    vins = ", ".join(
        f"('{r[0]}_2024-01-01 00:00:00', "
        + ", ".join(repr(v) if isinstance(v, str) else str(v).lower() for v in r)
        + ", TIMESTAMP '2024-01-01 00:00:00')"
        for r in SAMPLE_ROWS
    )
    samples = f"SELECT * FROM (VALUES {vins}) AS s({_COLUMN_LIST})"
    typed = ", ".join(
        "CAST(display_speed AS FLOAT) AS display_speed" if c == "display_speed" else c
        for c in contract.COLUMNS
    )
    return (
        f"{WITH_CLEANED}, both_parts AS (SELECT {_COLUMN_LIST} FROM cleaned "
        f"UNION ALL SELECT {typed} FROM ({samples}))" + DAILY_BODY.format(source="both_parts")
    )


def _report_sql() -> str:
    lines = []
    for f in contract.FIELDS:
        if f.name == contract.KEY:
            continue
        expected = f"'{f.type.simpleString()}'"
        actual, status, count = expected, "ok", f'COUNT("{f.raw_name}")'
        if f.name == "road_mode":
            actual, status = "'boolean'", "incompatible"
        elif f.name == "target_soc":
            actual, status = "'bigint'", "cast"
        elif f.name == "display_speed":
            actual, status, count = "CAST(NULL AS VARCHAR)", "missing", "COUNT(NULL)"
        elif f.name == "ts":
            actual = "'timestamp_ntz'"
        lines.append((f"'{f.name}'", expected, actual, f"'{status}'", count))
    lines += [
        ("'__sequence'", "NULL", "'bigint'", "'system'", "COUNT(__sequence)"),
        ("'__op_type'", "NULL", "'tinyint'", "'system'", "COUNT(__op_type)"),
        ("'cabin_temp'", "NULL", "'double'", "'extra'", "COUNT(CASE WHEN RESS_Power_Low_Flag THEN 1 END)"),
    ]
    return WITH_RAW + " UNION ALL ".join(
        f' SELECT {c} AS "column", {e} AS expected, {a} AS actual, {s} AS status, '
        f"CAST({n} AS BIGINT) AS non_null FROM raw"
        for c, e, a, s, n in lines
    )


SQL = {
    "vehicle_daily_summary": DAILY_SQL,
    "charging_behavior_analysis": CHARGING_SQL,
    "driving_mode_analysis": DRIVING_SQL,
    "clean_telemetry": f"{WITH_CLEANED} SELECT {_COLUMN_LIST} FROM cleaned",
    "telemetry_primary_key": f"{WITH_CLEANED} SELECT vin_id, ts, __primary_key FROM cleaned",
    "row_count_audit": WITH_CLEANED
    + """, per_key AS (SELECT __primary_key AS k, COUNT(*) AS n FROM cleaned GROUP BY 1)
SELECT (SELECT COUNT(*) FROM raw) AS raw_rows,
       CAST(COALESCE(SUM(n), 0) AS BIGINT) AS cleaned_rows,
       COUNT(k) AS distinct_keys,
       COUNT(CASE WHEN k IS NOT NULL AND n > 1 THEN 1 END) AS duplicate_keys,
       CAST(COALESCE(SUM(CASE WHEN k IS NULL THEN n END), 0) AS BIGINT) AS null_key_rows
FROM per_key""",
    "schema_contract_report": _report_sql(),
    "missing_column_null_fill": f"{WITH_CLEANED} SELECT "
    + ", ".join(
        "CAST(NULL AS FLOAT) AS display_speed" if c == "display_speed" else c
        for c in contract.COLUMNS
    )
    + " FROM cleaned",
    "telemetry_preview": f"{WITH_CLEANED} SELECT {_COLUMN_LIST} FROM cleaned "
    "ORDER BY __primary_key, channel_id LIMIT 10",
    "sample_rows": _sample_sql(),
    "table_stats": f"""{WITH_CLEANED},
daily AS ({DAILY_BODY.format(source="cleaned")}),
charging AS ({CHARGING_BODY.format(source="cleaned")}),
driving AS ({DRIVING_BODY.format(source="cleaned")})
SELECT 'vehicle_daily_summary' AS table_name, COUNT(*) AS row_count FROM daily
UNION ALL SELECT 'charging_behavior_analysis', COUNT(*) FROM charging
UNION ALL SELECT 'driving_mode_analysis', COUNT(*) FROM driving""",
}
