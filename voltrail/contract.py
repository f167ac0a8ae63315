"""The declared schema of the telemetry table and checks against it."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


class Field(NamedTuple):
    name: str
    type: T.DataType
    raw_name: str


class Finding(NamedTuple):
    column: str
    expected: str | None
    actual: str | None
    status: str


class ContractError(ValueError):
    """The input cannot be brought to the declared schema."""


KEY = "__primary_key"
DAY = "ts_day"
LOAD = "load_id"

# Column names, their order and the spellings found in raw files.
FIELDS = (
    Field("__primary_key", T.StringType(), "__primary_key"),
    Field("vin_id", T.StringType(), "vin_id"),
    Field("charging_time_remain_minute", T.IntegerType(), "Charging_Time_Remain_Minute"),
    Field("extender_starting_point", T.IntegerType(), "Extender_Starting_Point"),
    Field("fuel_cltc_mileage", T.IntegerType(), "Fuel_CLTC_Mileage"),
    Field("fuel_wltc_mileage", T.IntegerType(), "Fuel_WLTC_Mileage"),
    Field("fuel_percentage", T.IntegerType(), "Fuel_Percentage"),
    Field("clean_mode", T.IntegerType(), "Clean_Mode"),
    Field("road_mode", T.IntegerType(), "Road_Mode"),
    Field("ress_power_low_flag", T.BooleanType(), "RESS_Power_Low_Flag"),
    Field("target_soc", T.IntegerType(), "Target_SOC"),
    Field("display_speed", T.FloatType(), "DISPLAY_SPEED"),
    Field("channel_id", T.IntegerType(), "channel_id"),
    Field("endurance_type", T.IntegerType(), "Endurance_Type"),
    Field("ts", T.TimestampType(), "ts"),
)
SYSTEM_COLUMNS = ("__sequence", "__op_type")
MANDATORY = ("vin_id", "ts")

COLUMNS = tuple(f.name for f in FIELDS)


def table_schema(ts_type: T.DataType = T.TimestampType()) -> T.StructType:
    """The cleaned table; `ts` may be an instant or a zone-free timestamp."""
    return T.StructType(
        [T.StructField(f.name, ts_type if f.name == "ts" else f.type) for f in FIELDS]
    )


def raw_schema(ts_type: T.DataType = T.TimestampType()) -> T.StructType:
    """Landing files, for readers that may not infer (streams, empty folders)."""
    fields = [
        T.StructField(f.raw_name, ts_type if f.name == "ts" else f.type)
        for f in FIELDS
        if f.name != KEY
    ]
    system = [
        T.StructField("__sequence", T.LongType()),
        T.StructField("__op_type", T.ByteType()),
    ]
    return T.StructType(fields + system)


def assignable(actual: T.DataType, expected: T.DataType) -> bool:
    """Store-assignment rules: numbers among numbers, times among times."""
    times = (T.TimestampType, T.TimestampNTZType, T.DateType)
    if isinstance(expected, T.StringType):
        return isinstance(actual, T.AtomicType)
    if isinstance(expected, (T.IntegerType, T.FloatType)):
        return isinstance(actual, T.NumericType)
    if isinstance(expected, T.TimestampType):
        return isinstance(actual, times)
    return actual == expected


def _source_name(field: Field, names: set[str]) -> str | None:
    """Spelling of a contract column in the input; the test is case-sensitive."""
    found = [n for n in dict.fromkeys((field.raw_name, field.name)) if n in names]
    if len(found) > 1:
        raise ContractError(f"column {field.name} appears as {' and '.join(found)}")
    return found[0] if found else None


def source_names(schema: T.StructType) -> dict[str, str | None]:
    names = set(schema.names)
    return {f.name: _source_name(f, names) for f in FIELDS if f.name != KEY}


def findings(schema: T.StructType) -> list[Finding]:
    """One finding per contract column, then one per column outside the contract."""
    sources = source_names(schema)
    out = []
    for field in FIELDS:
        if field.name == KEY:
            continue
        source = sources[field.name]
        expected = field.type.simpleString()
        if source is None:
            out.append(Finding(field.name, expected, None, "missing"))
            continue
        actual = schema[source].dataType
        if not assignable(actual, field.type):
            status = "incompatible"
        elif actual == field.type or (field.name == "ts" and isinstance(actual, T.TimestampNTZType)):
            status = "ok"
        else:
            status = "cast"
        out.append(Finding(field.name, expected, actual.simpleString(), status))
    known = {s for s in sources.values() if s} | {KEY}
    for extra in schema.fields:
        if extra.name not in known:
            status = "system" if extra.name in SYSTEM_COLUMNS else "extra"
            out.append(Finding(extra.name, None, extra.dataType.simpleString(), status))
    return out


def require(schema: T.StructType) -> list[Finding]:
    """Fail before any work when a mandatory column or a usable type is absent."""
    found = findings(schema)
    absent = [f.column for f in found if f.status == "missing" and f.column in MANDATORY]
    wrong = [f"{f.column} ({f.actual} for {f.expected})" for f in found if f.status == "incompatible"]
    if absent or wrong:
        raise ContractError(f"mandatory columns missing: {absent}; unusable types: {wrong}")
    return found


def schema_report(df: DataFrame) -> DataFrame:
    """The findings as rows; reads no data."""
    rows = [tuple(f) for f in findings(df.schema)]
    return df.sparkSession.createDataFrame(
        rows, "`column` string, expected string, actual string, status string"
    )


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def contract_report(df: DataFrame) -> DataFrame:
    """The findings with the number of non-null values, in one pass over the data."""
    sources = source_names(df.schema)
    found = findings(df.schema)
    counted = df.agg(
        *[
            F.count(F.col(_quoted(sources.get(f.column) or f.column))).alias(f"n{i}")
            if f.status != "missing"
            else F.lit(0).cast("bigint").alias(f"n{i}")
            for i, f in enumerate(found)
        ]
    )
    text = lambda value: F.lit(value).cast("string")
    rows = F.array(
        *[
            F.struct(
                text(f.column).alias("column"),
                text(f.expected).alias("expected"),
                text(f.actual).alias("actual"),
                text(f.status).alias("status"),
                F.col(f"n{i}").alias("non_null"),
            )
            for i, f in enumerate(found)
        ]
    )
    return counted.select(F.inline(rows))
