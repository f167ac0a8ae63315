"""The three per-vehicle summaries.

Each summary can be taken straight from the telemetry, or all three from one
rollup (`mode_rollup`) so that the telemetry is scanned and shuffled only once.
Every aggregate combines map-side, so a vehicle with very many rows costs each
task one partial row per day and mode.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEYS = ["vin_id", "date"]
MODE_KEYS = [*KEYS, "clean_mode", "road_mode"]

DAILY = "vehicle_daily_summary"
CHARGING = "charging_behavior_analysis"
DRIVING = "driving_mode_analysis"


def _dated(base: DataFrame) -> DataFrame:
    return base.withColumn("date", F.to_date("ts"))


def daily_summary(base: DataFrame) -> DataFrame:
    return (
        _dated(base)
        .groupBy(*KEYS)
        .agg(
            F.avg("fuel_percentage").alias("avg_fuel_percentage"),
            F.min("fuel_percentage").alias("min_fuel_percentage"),
            F.max("fuel_percentage").alias("max_fuel_percentage"),
            F.avg("display_speed").alias("avg_display_speed"),
            F.max("display_speed").alias("max_display_speed"),
            F.avg("target_soc").alias("avg_target_soc"),
            F.count("*").alias("record_count"),
            F.min("ts").alias("first_record_time"),
            F.max("ts").alias("last_record_time"),
        )
    )


def charging_behavior(base: DataFrame) -> DataFrame:
    """`charging_sessions` counts rows with remaining charging time, not sessions."""
    charging = F.col("charging_time_remain_minute") > 0
    return (
        _dated(base)
        .groupBy(*KEYS)
        .agg(
            F.avg("charging_time_remain_minute").alias("avg_charging_time_remain"),
            F.max("charging_time_remain_minute").alias("max_charging_time_remain"),
            F.count(F.when(charging, 1)).alias("charging_sessions"),
            F.avg(F.when(charging, F.col("fuel_percentage"))).alias("avg_fuel_during_charging"),
            F.count("*").alias("total_records"),
        )
    )


def driving_modes(base: DataFrame) -> DataFrame:
    return (
        _dated(base)
        .groupBy(*MODE_KEYS)
        .agg(
            F.count("*").alias("mode_usage_count"),
            F.avg("display_speed").alias("avg_speed_in_mode"),
            F.avg("fuel_percentage").alias("avg_fuel_in_mode"),
            F.sum(F.when(F.col("ress_power_low_flag"), 1).otherwise(0)).alias("low_power_incidents"),
        )
    )


def mode_rollup(base: DataFrame, *more: str) -> DataFrame:
    """Sums, counts and extremes per vehicle, day and mode: all the summaries need.

    With `more` keys, as the load, parts of it that `merged_rollup` puts together.
    """
    charging = F.col("charging_time_remain_minute") > 0
    charging_fuel = F.when(charging, F.col("fuel_percentage"))
    return (
        _dated(base)
        .groupBy(*MODE_KEYS, *more)
        .agg(
            F.count("*").alias("n"),
            F.sum("fuel_percentage").alias("fuel_sum"),
            F.count("fuel_percentage").alias("fuel_n"),
            F.min("fuel_percentage").alias("fuel_min"),
            F.max("fuel_percentage").alias("fuel_max"),
            F.sum("display_speed").alias("speed_sum"),
            F.count("display_speed").alias("speed_n"),
            F.max("display_speed").alias("speed_max"),
            F.sum("target_soc").alias("soc_sum"),
            F.count("target_soc").alias("soc_n"),
            F.sum("charging_time_remain_minute").alias("remain_sum"),
            F.count("charging_time_remain_minute").alias("remain_n"),
            F.max("charging_time_remain_minute").alias("remain_max"),
            F.count(F.when(charging, 1)).alias("charging_n"),
            F.sum(charging_fuel).alias("charging_fuel_sum"),
            F.count(charging_fuel).alias("charging_fuel_n"),
            F.sum(F.when(F.col("ress_power_low_flag"), 1).otherwise(0)).alias("low_power_n"),
            F.min("ts").alias("first_ts"),
            F.max("ts").alias("last_ts"),
        )
    )


def merged_rollup(parts: DataFrame) -> DataFrame:
    """One rollup of several, as of the loads of a day."""
    values = [c for c in parts.columns if c.endswith(("n", "_sum", "_min", "_max", "_ts")) and c not in MODE_KEYS]
    how = {"_min": F.min, "_max": F.max}
    how |= {"first_ts": F.min, "last_ts": F.max}

    def merge(name: str) -> Column:
        return how.get(name, how.get(name[-4:], F.sum))(name).alias(name)

    return parts.groupBy(*MODE_KEYS).agg(*[merge(c) for c in values])


def _mean(total: Column, count: Column) -> Column:
    return F.try_divide(total.cast("double"), count)


def _mean_of(name: str) -> Column:
    return _mean(F.sum(f"{name}_sum"), F.sum(f"{name}_n"))


def daily_from_rollup(rollup: DataFrame) -> DataFrame:
    return rollup.groupBy(*KEYS).agg(
        _mean_of("fuel").alias("avg_fuel_percentage"),
        F.min("fuel_min").alias("min_fuel_percentage"),
        F.max("fuel_max").alias("max_fuel_percentage"),
        _mean_of("speed").alias("avg_display_speed"),
        F.max("speed_max").alias("max_display_speed"),
        _mean_of("soc").alias("avg_target_soc"),
        F.sum("n").alias("record_count"),
        F.min("first_ts").alias("first_record_time"),
        F.max("last_ts").alias("last_record_time"),
    )


def charging_from_rollup(rollup: DataFrame) -> DataFrame:
    return rollup.groupBy(*KEYS).agg(
        _mean_of("remain").alias("avg_charging_time_remain"),
        F.max("remain_max").alias("max_charging_time_remain"),
        F.sum("charging_n").alias("charging_sessions"),
        _mean_of("charging_fuel").alias("avg_fuel_during_charging"),
        F.sum("n").alias("total_records"),
    )


def driving_from_rollup(rollup: DataFrame) -> DataFrame:
    return rollup.select(
        *MODE_KEYS,
        F.col("n").alias("mode_usage_count"),
        _mean(F.col("speed_sum"), F.col("speed_n")).alias("avg_speed_in_mode"),
        _mean(F.col("fuel_sum"), F.col("fuel_n")).alias("avg_fuel_in_mode"),
        F.col("low_power_n").alias("low_power_incidents"),
    )


SUMMARIES = {DAILY: daily_summary, CHARGING: charging_behavior, DRIVING: driving_modes}
FROM_ROLLUP = {
    DAILY: daily_from_rollup,
    CHARGING: charging_from_rollup,
    DRIVING: driving_from_rollup,
}


def ordered(summary: DataFrame) -> DataFrame:
    """Key columns first: tables give their partition column last."""
    keys = [k for k in MODE_KEYS if k in summary.columns]
    return summary.select(*keys, *[c for c in summary.columns if c not in keys])
