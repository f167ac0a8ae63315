"""Summaries put together from the rollups of loads."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltrail import contract
from voltrail.operators import summaries
from voltrail.operators.clean import clean
from voltrail.plans import catalog, compaction, jobs, ledger, rollups, writes
from voltrail.sources import telemetry

NTZ = T.TimestampNTZType()


def raw(spark, first, last, days=4, start="2024-03-01"):
    return spark.range(first, last).selectExpr(
        "concat('V', id % 5) AS vin_id",
        "cast(id % 3 AS int) AS Clean_Mode",
        "cast(if(id % 7 = 0, null, id % 2) AS int) AS Road_Mode",
        "cast(if(id % 11 = 0, null, id % 101) AS int) AS Fuel_Percentage",
        "cast(id % 60 AS float) AS DISPLAY_SPEED",
        "cast(id % 4 AS int) AS Charging_Time_Remain_Minute",
        "id % 13 = 0 AS RESS_Power_Low_Flag",
        f"if(id % 17 = 0, null, cast(date_add(date'{start}', cast(id % {days} AS int)) AS timestamp_ntz)) AS ts",
    )


def snapshot(df):
    return sorted(map(repr, df.collect()))


def check(spark, table, namespace):
    base = telemetry.scan(spark, table)
    for name, build in summaries.SUMMARIES.items():
        want, got = build(base), jobs.read_summary(spark, namespace, name)
        assert got.columns == want.columns and snapshot(got) == snapshot(want)


@pytest.fixture()
def load(spark, namespace, tmp_path):
    def run(load_id, rows):
        landing = str(tmp_path / "in")
        rows.write.mode("overwrite").parquet(landing)
        return jobs.ingest_and_summarize(spark, landing, namespace, load_id, NTZ).first()

    return run


def test_loads_repeats_and_lost_days(spark, namespace, load):
    table = f"{namespace}.canbus01"
    load("one", raw(spark, 0, 300))
    load("two", raw(spark, 300, 500, 6))
    check(spark, table, namespace)
    load("one", raw(spark, 0, 40, 2, "2024-03-03"))
    check(spark, table, namespace)
    load("two", raw(spark, 0, 0))
    check(spark, table, namespace)
    held = {p[contract.LOAD] for p in catalog.partition_values(spark, rollups.rollup_of(table))}
    assert held == {"one"}


def test_loads_without_the_job_are_rolled_up_too(spark, namespace, load):
    table = f"{namespace}.canbus01"
    load("one", raw(spark, 0, 100))
    writes.load_telemetry(clean(raw(spark, 100, 200)), table, "by hand")
    load("two", raw(spark, 200, 300))
    check(spark, table, namespace)


def test_packed_loads_keep_their_rollups(spark, namespace, load):
    table = f"{namespace}.canbus01"
    load("one", raw(spark, 0, 100))
    load("two", raw(spark, 100, 200))
    for i in range(3):
        writes.load_telemetry(clean(raw(spark, 200 + 50 * i, 250 + 50 * i)), table, ledger.batch_load_id("s", i))
    compaction.close_batches(spark, table, "s", 3)
    assert compaction.compact(spark, table, settled=("one",)) > 0
    compaction.recover(spark, table)
    load("two", raw(spark, 100, 130, 4))
    check(spark, table, namespace)


def test_a_load_reads_its_own_rows_only(spark, namespace, load):
    """The rollup of a later load scans the partitions of that load alone."""
    table = f"{namespace}.canbus01"
    load("one", raw(spark, 0, 5000))
    load("two", raw(spark, 5000, 5100))
    seen = []
    real = summaries.mode_rollup
    summaries.mode_rollup = lambda base, *more: seen.append(base) or real(base, *more)
    try:
        load("three", raw(spark, 5100, 5150))
    finally:
        summaries.mode_rollup = real
    files = {f for base in seen for f in base.inputFiles()}
    assert files and all("load_id=three" in f for f in files)
    check(spark, table, namespace)


def test_merging_parts_gives_the_whole(spark):
    rows = clean(raw(spark, 0, 2000)).withColumn("load_id", F.concat(F.lit("l"), F.xxhash64("ts", "fuel_percentage") % 5))
    parts = summaries.mode_rollup(rows, "load_id")
    assert parts.count() > summaries.mode_rollup(rows).count()
    whole = summaries.mode_rollup(rows)
    assert snapshot(summaries.merged_rollup(parts).select(whole.columns)) == snapshot(whole)
