"""Catalog work, table writes, refreshes and exports; each run uses fresh folders."""

from __future__ import annotations

import datetime as dt
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from acceptance.telemetry import CHARGING_BODY, CHARGING_SQL, DAILY_SQL, DRIVING_BODY, DRIVING_SQL, cleaned
from acceptance.telemetry import DAILY_BODY, SQL as TELEMETRY_SQL
from acceptance.telemetry_view import WITH_CLEANED, WITH_RAW, raw_telemetry, table
from voltrail import contract
from voltrail.__main__ import main as command_line
from voltrail.operators import summaries
from voltrail.operators.clean import with_day
from voltrail.plans import catalog, jobs, writes
from voltrail.session import new_workdir
from voltrail.sources.telemetry import scan

NTZ = T.TimestampNTZType()


def fresh_namespace(spark: SparkSession) -> str:
    location = new_workdir(spark, "namespace")
    name = "fleet_" + location.rsplit("-", 1)[-1]
    catalog.ensure_namespace(spark, name, location)
    return name


def loaded_table(spark: SparkSession, sf_dir: str, namespace: str | None = None) -> str:
    name = f"{namespace or fresh_namespace(spark)}.canbus01"
    catalog.ensure_telemetry_table(spark, name, NTZ)
    writes.load_telemetry(cleaned(spark, sf_dir), name, "first")
    return name


def append_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two time ranges appended with their columns in different orders."""
    name = f"{fresh_namespace(spark)}.canbus01"
    catalog.ensure_telemetry_table(spark, name, NTZ)
    rows = with_day(cleaned(spark, sf_dir)).withColumn(contract.LOAD, F.lit("appended"))
    early = F.col("ts") < F.lit("2024-01-16").cast(NTZ)
    writes.append_by_name(rows.where(early).select(*reversed(rows.columns)), name)
    writes.append_by_name(rows.where(~early).select(*sorted(rows.columns)), name)
    return (
        scan(spark, name)
        .groupBy("vin_id")
        .agg(
            F.count("*").alias("n"),
            F.sum("fuel_percentage").alias("fuel_total"),
            F.sum("extender_starting_point").alias("extender_total"),
            F.count(F.when(F.col("ress_power_low_flag"), 1)).alias("low_power"),
            F.min(contract.KEY).alias("first_key"),
        )
    )


def ctas_partitioned_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Summary written as a table partitioned by date, twice, and read back."""
    name = f"{fresh_namespace(spark)}.{summaries.DAILY}"
    daily = summaries.daily_summary(cleaned(spark, sf_dir))
    for _ in range(2):
        writes.create_table_as(daily, name, "date")
    return summaries.ordered(catalog.fresh_table(spark, name))


def day_pruned_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = loaded_table(spark, sf_dir)
    return scan(spark, name, dt.datetime(2024, 1, 10), dt.datetime(2024, 1, 13))


VEHICLES = ["VIN000003", "VIN000050", "VIN000111"]


def vehicle_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some vehicles over some days."""
    name = loaded_table(spark, sf_dir)
    return scan(spark, name, dt.datetime(2024, 1, 5), dt.datetime(2024, 1, 20), VEHICLES)


def catalog_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    namespace = fresh_namespace(spark)
    name = loaded_table(spark, sf_dir, namespace)
    jobs.refresh_summaries(spark, name, namespace)
    return catalog.catalog_report(spark, namespace)


def namespaces_and_drops(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two tables in a namespace, one of them dropped: what the catalog lists afterwards."""
    namespace = fresh_namespace(spark)
    name = loaded_table(spark, sf_dir, namespace)
    writes.create_table_as(summaries.daily_summary(cleaned(spark, sf_dir)), f"{namespace}.{summaries.DAILY}", "date")
    both = catalog.list_tables(spark, namespace).agg(F.count("*").alias("tables_before"))
    before = both.first()[0]
    catalog.drop_table(spark, f"{namespace}.{summaries.DAILY}")
    known = catalog.list_namespaces(spark).where(F.col("namespace") == namespace).count()
    gone = not catalog.table_exists(spark, f"{namespace}.{summaries.DAILY}")
    return catalog.catalog_report(spark, namespace).select(
        "table_name",
        "row_count",
        F.lit(known).cast("bigint").alias("namespaces"),
        F.lit(before).cast("bigint").alias("tables_before"),
        F.lit(gone).alias("dropped"),
    ).where(F.col("table_name") == name.rsplit(".", 1)[1])


def command_line_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The load job with its arguments as from the command line, and its summary."""
    namespace, landing = fresh_namespace(spark), new_workdir(spark, "landing")
    raw_telemetry(spark, sf_dir).withColumn("ts", F.col("ts").cast("timestamp")).write.parquet(landing)
    command_line(["load", landing, namespace, "--load-id", "from the command line"], spark)
    daily = jobs.read_summary(spark, namespace, summaries.DAILY)
    return daily.withColumns({c: F.col(c).cast(NTZ) for c in ("first_record_time", "last_record_time")})


def _refreshed(spark: SparkSession, sf_dir: str, summary: str) -> DataFrame:
    namespace = fresh_namespace(spark)
    name = loaded_table(spark, sf_dir, namespace)
    jobs.refresh_summaries(spark, name, namespace)
    return jobs.read_summary(spark, namespace, summary)


def refreshed_daily_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _refreshed(spark, sf_dir, summaries.DAILY)


def refreshed_charging_behavior(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _refreshed(spark, sf_dir, summaries.CHARGING)


def refreshed_driving_modes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _refreshed(spark, sf_dir, summaries.DRIVING)


def refreshed_summary_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Summaries of the early days first, then only the days a later load brought."""
    namespace = fresh_namespace(spark)
    name = f"{namespace}.canbus01"
    catalog.ensure_telemetry_table(spark, name, NTZ)
    rows = cleaned(spark, sf_dir)
    early = F.col("ts") < F.lit("2024-01-20 12:00:00").cast(NTZ)
    writes.load_telemetry(rows.where(early), name, "early")
    jobs.refresh_summaries(spark, name, namespace)
    writes.load_telemetry(rows.where(~early), name, "late")
    late = spark.table(name).where(F.col(contract.LOAD) == "late")
    days = [r[0] for r in late.select(contract.DAY).distinct().collect()]
    jobs.refresh_summary_days(spark, name, namespace, days)
    return jobs.read_summary(spark, namespace, summaries.DAILY)


def ingest_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ingest job run twice over the same landing folder."""
    landing = new_workdir(spark, "landing")
    raw_telemetry(spark, sf_dir).write.option("maxRecordsPerFile", 2_000).parquet(landing)
    name = f"{fresh_namespace(spark)}.canbus01"
    runs = [
        jobs.ingest(spark, landing, name, "load-1", NTZ).withColumn("run", F.lit(i))
        for i in (1, 2)
    ]
    return reduce(DataFrame.unionByName, runs).select(
        "run", "load_id", "rows_before", "rows_read", "rows_written", "null_keys", "rows_after"
    )


def ingest_mixed_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ingest job over files that differ in columns and in the case of names."""
    landing = new_workdir(spark, "landing")
    raw = raw_telemetry(spark, sf_dir).where("vin_id IS NOT NULL")
    parts = [
        raw.withColumnRenamed("Fuel_Percentage", "FUEL_PERCENTAGE"),
        raw.drop("Clean_Mode", "Endurance_Type"),
        raw.drop("vin_id"),
    ]
    for i, part in enumerate(parts):
        part.drop("Road_Mode").write.parquet(f"{landing}/{i}")
    name = f"{fresh_namespace(spark)}.canbus01"
    audit = jobs.ingest(spark, landing, name, "load-1", NTZ)
    counts = catalog.fresh_table(spark, name).agg(
        F.count("fuel_percentage").alias("fuel"), F.count("clean_mode").alias("clean"), F.count("endurance_type").alias("endurance")
    )
    audit = audit.withColumn("missing", F.array_join("missing_columns", ","))
    return audit.select("rows_read", "rows_written", "rows_rejected", "missing").crossJoin(counts)


def ingest_files_of_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ingest job over files whose types differ: a contract column as int, bigint, double
    and tinyint, an extra column and a system column as number and as text."""
    landing = new_workdir(spark, "landing")
    raw = raw_telemetry(spark, sf_dir)
    fuel = F.col("Fuel_Percentage")
    parts = [
        raw.withColumn("cabin", F.lit(21)),
        raw.withColumn("Fuel_Percentage", fuel.cast("bigint")).withColumn("cabin", F.lit("warm")),
        raw.withColumn("Fuel_Percentage", fuel.cast("double")).withColumn("__op_type", F.lit("insert")),
        raw.withColumn("Fuel_Percentage", fuel.cast("tinyint")).withColumn("DISPLAY_SPEED", F.col("DISPLAY_SPEED").cast("double")),
    ]
    for i, part in enumerate(parts):
        part.write.parquet(f"{landing}/{i}")
    name = f"{fresh_namespace(spark)}.canbus01"
    line = jobs.ingest(spark, landing, name, "load-1", NTZ).select("rows_read", "rows_written", "null_keys")
    sums = scan(spark, name).groupBy("vin_id").agg(
        F.count("*").alias("n"), F.sum("fuel_percentage").alias("fuel"), F.max("display_speed").alias("speed")
    )
    return sums.crossJoin(F.broadcast(line))


def ingest_evolving(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two loads that bring columns the table lacks, the second one other columns; rows of
    loads without a column have NULL there."""
    name = f"{fresh_namespace(spark)}.canbus01"
    raw = raw_telemetry(spark, sf_dir)
    level = (F.col("__sequence") % 5).cast("int")
    for load, rows in (
        ("plain", raw),
        ("one", raw.withColumn("Cabin_Level", level)),
        ("two", raw.withColumn("CABIN_LEVEL", level.cast("smallint")).withColumn("note", F.lit("n"))),
    ):
        landing = new_workdir(spark, "landing")
        rows.write.parquet(landing)
        jobs.ingest(spark, landing, name, load, NTZ, evolve=True)
    return catalog.fresh_table(spark, name).groupBy(contract.LOAD).agg(
        F.count("*").alias("n"), F.sum("cabin_level").alias("levels"), F.count("note").alias("notes")
    )


EXPORTED = ("copy", "snappy", "lz4", "deflate", "zstd", "bzip2")


def _repeated_load(spark: SparkSession, sf_dir: str) -> str:
    """All days under one load id with their summaries, then the same load with part of
    them; returns the namespace."""
    namespace = fresh_namespace(spark)
    landing = new_workdir(spark, "landing")
    raw = raw_telemetry(spark, sf_dir)
    for rows in (raw, raw.where(F.col("ts") < F.lit("2024-01-12 06:00:00").cast(NTZ))):
        rows.write.mode("overwrite").parquet(landing)
        jobs.ingest_and_summarize(spark, landing, namespace, "same", NTZ)
    return namespace


def repeated_load_shrinks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(spark, f"{_repeated_load(spark, sf_dir)}.canbus01")


def repeated_load_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.read_summary(spark, _repeated_load(spark, sf_dir), summaries.DAILY)


def repeated_load_charging(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.read_summary(spark, _repeated_load(spark, sf_dir), summaries.CHARGING)


def repeated_load_driving(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.read_summary(spark, _repeated_load(spark, sf_dir), summaries.DRIVING)


def compressed_export_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    # One file of rows is one task: spread them before they are compressed.
    orders = table(spark, sf_dir, "orders").repartition(spark.sparkContext.defaultParallelism)
    folder = new_workdir(spark, "export")
    with ThreadPoolExecutor(len(EXPORTED)) as pool:
        list(pool.map(lambda c: writes.export_compressed(orders, f"{folder}/{c}", c), EXPORTED))
    parts = []
    for codec in EXPORTED:
        back = writes.read_export(spark, f"{folder}/{codec}", codec, orders.schema)
        parts.append(back.withColumn("codec", F.lit(codec)))
    return reduce(DataFrame.unionByName, parts)


def split_export_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = table(spark, sf_dir, "lineitem")
    folder = new_workdir(spark, "split")
    writes.export_split(lineitem, folder, 5000)
    return spark.read.schema(lineitem.schema).parquet(folder)


QUERIES = {
    "append_by_name": append_by_name,
    "ctas_partitioned_daily": ctas_partitioned_daily,
    "day_pruned_scan": day_pruned_scan,
    "vehicle_scan": vehicle_scan,
    "catalog_report": catalog_report,
    "namespaces_and_drops": namespaces_and_drops,
    "command_line_load": command_line_load,
    "refreshed_daily_summary": refreshed_daily_summary,
    "refreshed_charging_behavior": refreshed_charging_behavior,
    "refreshed_driving_modes": refreshed_driving_modes,
    "refreshed_summary_days": refreshed_summary_days,
    "ingest_job": ingest_job,
    "ingest_mixed_files": ingest_mixed_files,
    "ingest_files_of_types": ingest_files_of_types,
    "ingest_evolving": ingest_evolving,
    "repeated_load_shrinks": repeated_load_shrinks,
    "repeated_load_daily": repeated_load_daily,
    "repeated_load_charging": repeated_load_charging,
    "repeated_load_driving": repeated_load_driving,
    "compressed_export_roundtrip": compressed_export_roundtrip,
    "split_export_roundtrip": split_export_roundtrip,
}

_CLEAN = TELEMETRY_SQL["clean_telemetry"]
_EARLY = "ts < TIMESTAMP '2024-01-12 06:00:00'"

SQL = {
    "append_by_name": f"""{WITH_CLEANED}
SELECT vin_id, COUNT(*) AS n, CAST(SUM(fuel_percentage) AS BIGINT) AS fuel_total,
       CAST(SUM(extender_starting_point) AS BIGINT) AS extender_total,
       COUNT(CASE WHEN ress_power_low_flag THEN 1 END) AS low_power,
       MIN(__primary_key) AS first_key
FROM cleaned GROUP BY vin_id""",
    "ctas_partitioned_daily": DAILY_SQL,
    "day_pruned_scan": f"{_CLEAN} WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-10' AND DATE '2024-01-12'",
    "vehicle_scan": f"""{_CLEAN} WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-19'
    AND vin_id IN ({", ".join(f"'{v}'" for v in VEHICLES)})""",
    "catalog_report": f"""{WITH_CLEANED},
days AS (SELECT COUNT(DISTINCT CAST(ts AS DATE)) AS n FROM cleaned),
daily AS ({DAILY_BODY.format(source="cleaned")}),
charging AS ({CHARGING_BODY.format(source="cleaned")}),
driving AS ({DRIVING_BODY.format(source="cleaned")})
SELECT 'canbus01' AS table_name, CAST(17 AS BIGINT) AS column_count,
       (SELECT n FROM days) AS partition_count, COUNT(*) AS row_count FROM cleaned
UNION ALL SELECT 'vehicle_daily_summary', 11, (SELECT n FROM days), COUNT(*) FROM daily
UNION ALL SELECT 'charging_behavior_analysis', 7, (SELECT n FROM days), COUNT(*) FROM charging
UNION ALL SELECT 'driving_mode_analysis', 8, (SELECT n FROM days), COUNT(*) FROM driving""",
    "namespaces_and_drops": f"""{WITH_CLEANED}
SELECT 'canbus01' AS table_name, COUNT(*) AS row_count, CAST(1 AS BIGINT) AS namespaces,
       CAST(2 AS BIGINT) AS tables_before, true AS dropped FROM cleaned""",
    "command_line_load": DAILY_SQL,
    "refreshed_daily_summary": DAILY_SQL,
    "refreshed_charging_behavior": CHARGING_SQL,
    "refreshed_driving_modes": DRIVING_SQL,
    "refreshed_summary_days": DAILY_SQL,
    "ingest_job": f"""{WITH_RAW}, n AS (SELECT COUNT(*) AS n FROM raw)
SELECT CAST(1 AS INT) AS run, 'load-1' AS load_id, CAST(0 AS BIGINT) AS rows_before, n AS rows_read,
       n AS rows_written, CAST(0 AS BIGINT) AS null_keys, n AS rows_after FROM n
UNION ALL SELECT 2, 'load-1', n, n, n, 0, n FROM n""",
    "ingest_mixed_files": f"""{WITH_CLEANED}
SELECT CAST(3 * COUNT(*) AS BIGINT) AS rows_read, CAST(2 * COUNT(*) AS BIGINT) AS rows_written,
       COUNT(*) AS rows_rejected, 'road_mode' AS missing, CAST(2 * COUNT(fuel_percentage) AS BIGINT) AS fuel,
       COUNT(clean_mode) AS clean, COUNT(endurance_type) AS endurance
FROM cleaned WHERE vin_id IS NOT NULL""",
    "ingest_files_of_types": f"""{WITH_CLEANED}, t AS (SELECT COUNT(*) AS n FROM cleaned WHERE vin_id IS NOT NULL)
SELECT vin_id, CAST(4 * COUNT(*) AS BIGINT) AS n, CAST(4 * SUM(fuel_percentage) AS BIGINT) AS fuel,
       MAX(display_speed) AS speed,
       (SELECT CAST(4 * COUNT(*) AS BIGINT) FROM cleaned) AS rows_read, CAST(4 * ANY_VALUE(t.n) AS BIGINT) AS rows_written,
       (SELECT CAST(4 * COUNT(*) FILTER (ts IS NULL) AS BIGINT) FROM cleaned) AS null_keys
FROM cleaned, t WHERE vin_id IS NOT NULL GROUP BY vin_id""",
    "ingest_evolving": f"""{WITH_RAW}, kept AS (SELECT * FROM raw WHERE vin_id IS NOT NULL)
SELECT 'plain' AS load_id, COUNT(*) AS n, CAST(NULL AS BIGINT) AS levels, CAST(0 AS BIGINT) AS notes FROM kept
UNION ALL SELECT 'one', COUNT(*), CAST(SUM(__sequence % 5) AS BIGINT), 0 FROM kept
UNION ALL SELECT 'two', COUNT(*), CAST(SUM(__sequence % 5) AS BIGINT), COUNT(*) FROM kept""",
    "repeated_load_shrinks": f"{_CLEAN} WHERE {_EARLY}",
    **{
        name: f"{WITH_CLEANED}, part AS (SELECT * FROM cleaned WHERE {_EARLY}) {body.format(source='part')}"
        for name, body in (
            ("repeated_load_daily", DAILY_BODY),
            ("repeated_load_charging", CHARGING_BODY),
            ("repeated_load_driving", DRIVING_BODY),
        )
    },
    "compressed_export_roundtrip": " UNION ALL ".join(
        f"SELECT *, '{c}' AS codec FROM orders" for c in EXPORTED
    ),
    "split_export_roundtrip": "SELECT * FROM lineitem",
}
