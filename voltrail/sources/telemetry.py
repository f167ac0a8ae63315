"""Telemetry readers: landing files, the cleaned table, sample rows."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltrail import contract
from voltrail.functions.columns import primary_key
from voltrail.operators.clean import clean
from voltrail.plans import compaction
from voltrail.sources import footers


def file_schema(
    spark: SparkSession, path: str, ts_type: T.DataType = T.TimestampType()
) -> T.StructType:
    """Contract columns that any of the landing files has, in the types that read them all.

    Names are matched without case and spelled as the contract does. A folder
    without files has the declared columns; a path that does not exist is an error, and so
    are files that no one schema reads.
    """
    found = footers.survey(footers.landing_files(spark, path))
    found.require()
    if len(found.groups) > 1:
        kinds = [f"{f.name} {f.dataType.simpleString()}" for g in found.groups for f in g.schema]
        raise contract.ContractError(f"no one schema: {sorted(set(kinds))}")
    return found.groups[0].schema if found.groups else contract.raw_schema(ts_type)


def _whole(schema: T.StructType, ts_type: T.DataType) -> T.StructType:
    """The schema with the contract columns it lacks, so their rows have NULL there."""
    seen = {name.lower() for name in schema.names}
    declared = [
        f
        for f in contract.raw_schema(ts_type)
        if f.name.lower() not in seen and f.name not in contract.SYSTEM_COLUMNS
    ]
    return T.StructType([*schema.fields, *declared])


def read_raw(
    spark: SparkSession,
    path: str,
    ts_type: T.DataType = T.TimestampType(),
    found: T.StructType | None = None,
) -> DataFrame:
    """Landing Parquet below `path`; `found` is its `file_schema` when already known.

    Files may differ in their columns and in the case of names. Contract columns that
    no file has are declared too, so the rows have NULL there.
    """
    schema = _whole(found or file_schema(spark, path, ts_type), ts_type)
    return spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(path)


def read_cleaned(
    spark: SparkSession,
    files: DataFrame,
    found: footers.Survey,
    ts_type: T.DataType = T.TimestampType(),
    places: list[str] | None = None,
    extras: T.StructType | None = None,
) -> DataFrame:
    """Cleaned rows of the surveyed `files`, each group read with its own schema.

    Where one schema reads them all, Spark is given their folder `places` if there is one;
    else the names of each group's files, as Spark's readers need them. `extras`
    are columns outside the contract that are kept, NULL where a group lacks them.
    """
    more = extras or T.StructType()
    if not found.groups:
        empty = spark.createDataFrame([], contract.raw_schema(ts_type))
        return clean(empty, ts_type, more)
    if len(found.groups) == 1 and places and not found.unusable:
        reader = spark.read.schema(_whole(found.groups[0].schema, ts_type))
        return clean(reader.option("recursiveFileLookup", "true").parquet(*places), ts_type, more)
    names = found.names
    if names is None:
        names = footers.paths_of(files, [s for g in found.groups for s in g.shapes], extras is not None)
    return reduce(
        DataFrame.unionByName,
        [
            clean(
                spark.read.schema(_whole(g.schema, ts_type)).parquet(
                    *[footers.literal_path(p) for s in g.shapes for p in names.get(s, [])]
                ),
                ts_type,
                more,
            )
            for g in found.groups
        ],
    )


def stream_raw(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    max_files_per_trigger: int | None = None,
    glob: str = "*.parquet",
) -> DataFrame:
    """Landing Parquet as it arrives; every file is read once per checkpoint.

    Archives may land other files too, so only names matching `glob` are read.
    """
    reader = (
        spark.readStream.schema(schema or contract.raw_schema())
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", glob)
    )
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path)


def scan(
    spark: SparkSession,
    table: str,
    start: dt.datetime | None = None,
    end: dt.datetime | None = None,
    vehicles: list[str] | None = None,
) -> DataFrame:
    """Contract columns of the table, `start <= ts < end`, of these vehicles.

    The bounds also go to the partition column, so other days are not opened. Files are
    ordered along the vehicle, so of the days that are, row groups of others are skipped.
    """
    df = compaction.live_rows(spark, table)
    ts_type = df.schema["ts"].dataType

    def at(time: dt.datetime) -> Column:
        return F.lit(time.isoformat(sep=" ")).cast(ts_type)

    if start is not None:
        df = df.where(F.col("ts") >= at(start))
    if end is not None:
        df = df.where(F.col("ts") < at(end))
    if vehicles is not None:
        df = df.where(F.col("vin_id").isin(vehicles))
    if contract.DAY in df.columns:
        if start is not None:
            df = df.where(F.col(contract.DAY) >= F.to_date(at(start)))
        if end is not None:
            last = end - dt.timedelta(microseconds=1)
            df = df.where(F.col(contract.DAY) <= F.to_date(at(last)))
    return df.select(*contract.COLUMNS)


# The two sample vehicles, in contract column order without key and ts.
SAMPLE_ROWS = (
    ("TEST001", 120, 50, 500, 480, 75, 1, 2, False, 80, 60.5, 1, 1),
    ("TEST002", 90, 30, 450, 430, 60, 0, 1, True, 70, 45.2, 2, 2),
)


def sample_rows(
    spark: SparkSession, now: dt.datetime, ts_type: T.DataType = T.TimestampType()
) -> DataFrame:
    """Two test rows, only on request: a failed job never writes them by itself."""
    schema = T.StructType([f for f in contract.table_schema(ts_type) if f.name != contract.KEY])
    rows = spark.createDataFrame([(*row, now) for row in SAMPLE_ROWS], schema)
    return rows.withColumn(contract.KEY, primary_key(F.col("vin_id"), F.col("ts"))).select(
        *contract.COLUMNS
    )
