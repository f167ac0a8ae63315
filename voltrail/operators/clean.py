"""Raw telemetry to the declared schema, as one projection."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltrail import contract


def _narrowed(source: str, actual: T.DataType, expected: T.DataType, name: str) -> str:
    """SQL of a cast that never wraps around, whatever the session's ANSI setting is."""
    value, target = f"`{source}`", expected.simpleString()
    if actual == expected:
        return value
    fits_always = (T.ByteType, T.ShortType)
    if isinstance(expected, T.IntegerType) and not isinstance(actual, fits_always):
        return (
            f"CASE WHEN {value} IS NULL OR {value} BETWEEN -2147483648 AND 2147483647 "
            f"THEN CAST({value} AS {target}) ELSE raise_error('{name} does not fit {target}') END"
        )
    return f"CAST({value} AS {target})"


def clean(df: DataFrame, ts_type: T.DataType | None = None, extras: T.StructType | None = None) -> DataFrame:
    """Drop system columns and stale keys, rename, rebuild the key, order columns.

    Columns the input lacks become typed NULLs; `vin_id` and `ts` must be there.
    `ts` keeps the kind of timestamp it has unless `ts_type` says otherwise. `extras` are
    columns outside the contract that stay, behind the others.
    """
    schema = df.schema
    contract.require(schema)
    sources = contract.source_names(schema)
    if ts_type is None:
        ts_actual = schema[sources["ts"]].dataType
        ts_type = T.TimestampType() if isinstance(ts_actual, T.DateType) else ts_actual
    values = {}
    for field in contract.FIELDS:
        if field.name == contract.KEY:
            continue
        expected = ts_type if field.name == "ts" else field.type
        source = sources[field.name]
        if source is None:
            values[field.name] = f"CAST(NULL AS {expected.simpleString()})"
        else:
            values[field.name] = _narrowed(source, schema[source].dataType, expected, field.name)
    values[contract.KEY] = f"concat({values['vin_id']}, '_', CAST({values['ts']} AS STRING))"
    more = []
    for field in extras or ():
        value = f"`{field.name}`" if field.name in schema.names else "NULL"
        more.append(f"CAST({value} AS {field.dataType.simpleString()}) AS `{field.name}`")
    return df.selectExpr(*[f"{values[c]} AS `{c}`" for c in contract.COLUMNS], *more)


def with_day(df: DataFrame) -> DataFrame:
    """Adds the day the table is partitioned by."""
    return df.withColumn(contract.DAY, F.to_date("ts"))


def with_vehicle(cleaned: DataFrame) -> DataFrame:
    """Rows a load takes: those that name their vehicle. Rows without time are kept."""
    return cleaned.where(F.col("vin_id").isNotNull())


def without_vehicle(cleaned: DataFrame) -> DataFrame:
    """Rows a load rejects."""
    return cleaned.where(F.col("vin_id").isNull())
