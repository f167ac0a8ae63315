import datetime as dt
from collections import defaultdict

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltrail import contract
from voltrail.operators import audit, summaries
from voltrail.operators.clean import clean

RAW = (
    "vin_id string, Charging_Time_Remain_Minute int, Fuel_Percentage int, Clean_Mode int, "
    "Road_Mode int, RESS_Power_Low_Flag boolean, Target_SOC int, DISPLAY_SPEED float, ts timestamp_ntz"
)
DAY = dt.datetime(2024, 3, 1)
small = st.one_of(st.none(), st.integers(0, 3))
rows = st.lists(
    st.tuples(
        st.sampled_from(["A", "B"]),
        small,
        st.one_of(st.none(), st.integers(0, 100)),
        small,
        small,
        st.one_of(st.none(), st.booleans()),
        small,
        st.one_of(st.none(), st.integers(0, 200).map(float)),
        st.integers(0, 3 * 86400 - 1).map(lambda s: DAY + dt.timedelta(seconds=s)),
    ),
    min_size=1,
    max_size=30,
)
few = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))


def mean(values):
    values = [v for v in values if v is not None]
    return sum(values) / len(values) if values else None


def top(values, pick):
    values = [v for v in values if v is not None]
    return pick(values) if values else None


def by_key(df, keys):
    return {tuple(r[k] for k in keys): {c: r[c] for c in df.columns if c not in keys} for r in df.collect()}


@few
@given(rows)
def test_against_plain_python(spark, data):
    base = clean(spark.createDataFrame(data, RAW))
    groups, modes = defaultdict(list), defaultdict(list)
    for r in data:
        groups[r[0], r[8].date()].append(r)
        modes[r[0], r[8].date(), r[3], r[4]].append(r)
    daily = {
        k: {
            "avg_fuel_percentage": mean([r[2] for r in g]),
            "min_fuel_percentage": top([r[2] for r in g], min),
            "max_fuel_percentage": top([r[2] for r in g], max),
            "avg_display_speed": mean([r[7] for r in g]),
            "max_display_speed": top([r[7] for r in g], max),
            "avg_target_soc": mean([r[6] for r in g]),
            "record_count": len(g),
            "first_record_time": min(r[8] for r in g),
            "last_record_time": max(r[8] for r in g),
        }
        for k, g in groups.items()
    }
    charging = {
        k: {
            "avg_charging_time_remain": mean([r[1] for r in g]),
            "max_charging_time_remain": top([r[1] for r in g], max),
            "charging_sessions": sum(1 for r in g if r[1] is not None and r[1] > 0),
            "avg_fuel_during_charging": mean([r[2] for r in g if r[1] is not None and r[1] > 0]),
            "total_records": len(g),
        }
        for k, g in groups.items()
    }
    driving = {
        k: {
            "mode_usage_count": len(g),
            "avg_speed_in_mode": mean([r[7] for r in g]),
            "avg_fuel_in_mode": mean([r[2] for r in g]),
            "low_power_incidents": sum(1 for r in g if r[5]),
        }
        for k, g in modes.items()
    }
    rollup = summaries.mode_rollup(base)
    for direct, rolled, keys, want in (
        (summaries.daily_summary(base), summaries.daily_from_rollup(rollup), summaries.KEYS, daily),
        (summaries.charging_behavior(base), summaries.charging_from_rollup(rollup), summaries.KEYS, charging),
        (summaries.driving_modes(base), summaries.driving_from_rollup(rollup), summaries.MODE_KEYS, driving),
    ):
        assert direct.schema.names == rolled.schema.names
        assert [f.dataType for f in direct.schema] == [f.dataType for f in rolled.schema]
        assert by_key(direct, keys) == want
        assert by_key(rolled, keys) == want


@few
@given(rows)
def test_row_counts_are_kept(spark, data):
    raw = spark.createDataFrame(data, RAW)
    base = clean(raw)
    assert base.count() == len(data)
    daily, driving = summaries.daily_summary(base), summaries.driving_modes(base)
    assert daily.agg(F.sum("record_count")).first()[0] == len(data)
    assert driving.agg(F.sum("mode_usage_count")).first()[0] == len(data)
    line = audit.row_count_audit(raw, base).first()
    keys = [f"{r[0]}_{r[8]}" for r in data]
    assert line["raw_rows"] == line["cleaned_rows"] == len(data)
    assert line["distinct_keys"] == len(set(keys))
    assert line["duplicate_keys"] == sum(1 for k in set(keys) if keys.count(k) > 1)


def test_audit_counts_rows_without_key(spark):
    raw = spark.createDataFrame([(None, None, None, None, None, None, None, None, DAY)] * 3, RAW)
    line = audit.row_count_audit(raw, clean(raw)).first()
    assert (line["null_key_rows"], line["distinct_keys"], line["duplicate_keys"]) == (3, 0, 0)


def test_audit_of_no_rows(spark):
    raw = spark.createDataFrame([], RAW)
    assert list(audit.row_count_audit(raw, clean(raw)).first()) == [0, 0, 0, 0, 0]


def test_one_vehicle_with_a_third_of_all_rows(spark):
    """Tasks send one partial row per group, so the hot vehicle is no heavy partition."""
    base = clean(
        spark.range(0, 60_000, 1, 8).selectExpr(
            "CASE WHEN id % 3 = 0 THEN 'HOT' ELSE concat('V', id % 500) END AS vin_id",
            "cast(id % 2 AS int) AS Clean_Mode",
            "cast(id % 101 AS int) AS Fuel_Percentage",
            "timestamp_ntz'2024-03-01 00:00:00' AS ts",
        )
    )
    daily = summaries.daily_summary(base)
    plan = daily._jdf.queryExecution().executedPlan().toString()
    assert "partial_avg" in plan and plan.count("Exchange") == 1
    hot = daily.where("vin_id = 'HOT'").first()
    assert hot["record_count"] == 20_000
    assert daily.agg(F.sum("record_count")).first()[0] == 60_000


def test_rollup_is_one_shuffle(spark):
    base = clean(spark.createDataFrame([], RAW))
    plan = summaries.mode_rollup(base)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "partial_sum" in plan


@pytest.mark.parametrize("build", [summaries.daily_summary, summaries.charging_behavior])
def test_only_needed_columns_are_read(spark, tmp_path, build):
    path = str(tmp_path / "base")
    clean(spark.createDataFrame([], RAW)).write.parquet(path)
    plan = build(spark.read.schema(contract.table_schema(T.TimestampNTZType())).parquet(path))
    read = plan._jdf.queryExecution().executedPlan().toString().split("ReadSchema:")[1]
    assert "endurance_type" not in read and "__primary_key" not in read
