"""Table and file writes."""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Iterator
from contextlib import contextmanager
from typing import NamedTuple

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltrail import contract
from voltrail.functions.columns import primary_key
from voltrail.plans import catalog
from voltrail.session import discard, new_workdir
from voltrail.sources import storage


@contextmanager
def stored(df: DataFrame, label: str) -> Iterator[DataFrame]:
    """The rows written to the shared folder and read from there, so they are computed once.

    The folder goes when the block ends.
    """
    spark = df.sparkSession
    path = new_workdir(spark, label)
    try:
        df.write.parquet(path)
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        discard(spark, path)


#: Rows of a load that one task sorts and writes as fast as several.
ONE_TASK_ROWS = 50_000

FILE_PROVIDERS = ("parquet", "orc", "json", "csv")


def add_missing_columns(df: DataFrame, table: str) -> list[str]:
    """Adds to the table the columns it lacks; existing rows read them as NULL."""
    spark = df.sparkSession
    have = {c.lower() for c in spark.table(table).columns}
    new = [f for f in df.schema if f.name.lower() not in have]
    if new:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in new)
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({columns})")
    return [f.name for f in new]


def append_by_name(df: DataFrame, table: str, evolve: bool = False) -> None:
    """Appends by column name; columns `df` lacks become NULL.

    With `evolve`, columns the table lacks are added first, else they are an error.
    """
    if evolve:
        add_missing_columns(df, table)
    df.sparkSession.sql(f"INSERT INTO {table} BY NAME SELECT * FROM {{rows}}", rows=df)


def _is_file_table(spark: SparkSession, table: str) -> bool:
    return _is_of_files(catalog.table_details(spark, table))


def _is_of_files(details: dict[str, str]) -> bool:
    return details.get("Provider", "").lower() in FILE_PROVIDERS


def _overwrites_dynamically(details: dict[str, str]) -> bool:
    return "partitionOverwriteMode=dynamic" in details.get("Storage Properties", "")


def replace_partitions(df: DataFrame, table: str, details: dict[str, str] | None = None) -> None:
    """Replaces the partitions `df` has rows for; a repeat leaves the same table.

    File tables must carry the option `partitionOverwriteMode=dynamic`, as those
    made here do: without it the statement would empty the whole table. `details` are the
    table's, where they are known.
    """
    spark = df.sparkSession
    details = details or catalog.table_details(spark, table)
    if not _is_of_files(details):
        df.writeTo(table).overwritePartitions()
        return
    if not _overwrites_dynamically(details):
        raise ValueError(f"{table} was created without partitionOverwriteMode=dynamic")
    spark.sql(f"INSERT OVERWRITE TABLE {table} BY NAME SELECT * FROM {{rows}}", rows=df)


def literal(value: str | None) -> str:
    return "null" if value is None else "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _specs(partitions: list[dict[str, str | None]]) -> list[str]:
    return ["PARTITION (" + ", ".join(f"`{k}`={literal(v)}" for k, v in p.items()) + ")" for p in partitions]


def drop_partitions(spark: SparkSession, table: str, partitions: list[dict[str, str | None]]) -> None:
    """Drops these partitions, all in one statement."""
    if partitions:
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {', '.join(_specs(partitions))}")


def add_partitions(spark: SparkSession, table: str, partitions: list[dict[str, str | None]]) -> None:
    """Shows the files in the folders of these partitions to readers, all in one statement."""
    if partitions:
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {' '.join(_specs(partitions))}")


#: The one file of a partition that a small load or a note put into the table's folder.
SMALL_FILE = "part-00000.parquet"
#: Folders that Arrow opens and names that a folder of Spark has as they are.
_OPENED = re.compile(r"(file|hdfs|s3|s3a|s3n|gs|abfs|abfss):/[\w.+@:/-]+", re.ASCII)
_AS_IT_IS = re.compile(r"[\w.+-]+", re.ASCII)
_CODECS = ("snappy", "gzip", "zstd", "none")
#: Days that Python can name, as days since 1970.
_FIRST_DAY, _LAST_DAY = ((d - dt.date(1970, 1, 1)).days for d in (dt.date.min, dt.date.max))


def _codec(spark: SparkSession, details: dict[str, str]) -> str | None:
    """Compression of a table whose folders small files can be put into, else None: of Parquet,
    where Arrow can open it, and with no options that Spark alone knows."""
    if details.get("Provider", "").lower() != "parquet" or not _OPENED.fullmatch(details.get("Location", "")):
        return None
    stated = details.get("Storage Properties", "").strip("[]").split(", ")
    options = dict(x.partition("=")[::2] for x in stated if x)
    codec = options.pop("compression", None) or spark.conf.get("spark.sql.parquet.compression.codec")
    if set(options) - {"partitionOverwriteMode", "serialization.format"} or codec.lower() not in _CODECS:
        return None
    try:
        storage.locate(details["Location"], {})
    except (OSError, pa.ArrowException):  # no driver of that store here
        return None
    return codec.lower()


def _folder(location: str, partition: dict[str, str | None]) -> str:
    return location + "".join(f"/{k}={catalog.NULL_PARTITION if v is None else v}" for k, v in partition.items())


def _put_file(uri: str, rows: pa.Table, codec: str, version: str, opened: dict) -> None:
    """A Parquet file as Spark of this version writes it: the calendar is told by the version."""
    sink = pa.BufferOutputStream()
    told = rows.replace_schema_metadata({"org.apache.spark.version": version})
    pq.write_table(told, sink, compression=codec, store_schema=False)
    storage.write_file(uri, [sink.getvalue()], opened)


def put_file(spark: SparkSession, table: str, folder: str, rows: pa.Table) -> bool:
    """Puts a few rows as a file into a fresh folder below the table's, without a job; False
    where that cannot be done."""
    details = catalog.table_details(spark, table)
    codec = _codec(spark, details)
    if codec is not None:
        _put_file(f"{details['Location']}/{folder}/{SMALL_FILE}", rows, codec, spark.version, {})
    return codec is not None


def put_note(spark: SparkSession, table: str, partition: dict[str, str], rows: pa.Table) -> bool:
    """Puts a few rows as a partition into a table of notes, without a job; False where that
    cannot be done, or something is there already."""
    details = catalog.table_details(spark, table)
    codec = _codec(spark, details)
    if codec is None or not all(_AS_IT_IS.fullmatch(v) for v in partition.values()):
        return False
    opened: dict = {}
    folder = _folder(details["Location"], partition)
    if storage.names(folder, opened):
        return False
    _put_file(f"{folder}/{SMALL_FILE}", rows, codec, spark.version, opened)
    add_partitions(spark, table, [partition])
    return True


class _Days(NamedTuple):
    """Writes the rows a task gets as one file for each day; a small load's rows in memory."""

    location: str
    load_id: str
    codec: str
    version: str

    def folder(self, day: dt.date | None) -> str:
        return _folder(self.location, {contract.DAY: day and str(day), contract.LOAD: self.load_id})

    def write(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened: dict = {}
        days: dict[dt.date | None, list[pa.RecordBatch]] = {}
        for batch in batches:
            inside = [c for c in batch.schema.names if c not in (contract.DAY, contract.LOAD)]
            ends = pc.min_max(batch.column(contract.DAY).cast(pa.int32())).as_py()
            if ends["min"] is not None and not _FIRST_DAY <= ends["min"] <= ends["max"] <= _LAST_DAY:
                yield pa.RecordBatch.from_pydict({"day": pa.array([None], pa.date32()), "rows": [-1]})
                return
            runs = pc.run_end_encode(batch.column(contract.DAY))
            start = 0
            for day, end in zip(runs.values.to_pylist(), runs.run_ends.to_pylist()):
                days.setdefault(day, []).append(batch.slice(start, end - start).select(inside))
                start = end
        for day, parts in days.items():
            rows = pa.Table.from_batches(parts)
            _put_file(f"{self.folder(day)}/{SMALL_FILE}", rows, self.codec, self.version, opened)
        if days:
            counts = [sum(p.num_rows for p in parts) for parts in days.values()]
            yield pa.RecordBatch.from_pydict({"day": pa.array(list(days), pa.date32()), "rows": counts})


def _load_small(
    whole: DataFrame, table: str, load_id: str, details: dict[str, str], codec: str
) -> tuple[int, int] | None:
    """Puts a small new load into the folders of its days, one file each, and then shows them
    all at once; returns its rows and how many have no key, or None and writes nothing
    where a day is beyond the years 1 to 9999.

    A commit of Spark makes and moves a dozen folders for it, which takes longer than the
    rows. A file has its name when it is complete, and a task tried again leaves the same one.
    """
    spark = whole.sparkSession
    days = _Days(details["Location"], load_id, codec, spark.version)
    put = whole.mapInArrow(days.write, "day date, rows bigint").collect()  # one row per day
    if any(r["rows"] < 0 for r in put):
        return None
    opened: dict = {}
    for r in put:
        folder = days.folder(r["day"])
        for name in storage.names(folder, opened):
            if name != SMALL_FILE:  # of a load that was cut short before readers saw it
                storage.remove(f"{folder}/{name}", opened)
    add_partitions(spark, table, [{contract.DAY: r["day"] and str(r["day"]), contract.LOAD: load_id} for r in put])
    return sum(r["rows"] for r in put), sum(r["rows"] for r in put if r["day"] is None)


def clustered(rows: DataFrame) -> DataFrame:
    """Rows of a day along vehicle and time within each task, so that row groups hold few
    vehicles and readers skip the others by their statistics. The write itself sorts
    by the partition columns; these come first here, so it has nothing left to sort."""
    return rows.sortWithinPartitions(contract.DAY, contract.LOAD, "vin_id", "ts")


def load_telemetry(
    cleaned: DataFrame,
    table: str,
    load_id: str,
    gather_days: bool = True,
    most_rows: int | None = None,
    count: bool = False,
) -> tuple[int, int] | None:
    """Writes cleaned rows as load `load_id`; the same load again replaces itself, days
    that it no longer has rows for included.

    Which days a load held before is in the catalog. Only where it held any, so for a
    repeat, the days of the new rows are read as well.

    `gather_days` brings rows of a day together before the write; a day larger
    than Spark's advisory partition size is spread over several tasks. Leave it
    out when each input file already covers few days: then nothing is shuffled. Of a load known
    to have `most_rows` or fewer, a small one is gathered by one task. With `count`, the rows
    that were written and how many of them have no key are returned.
    The key is derived from other columns, so it is built after the shuffle.
    """
    spark = cleaned.sparkSession
    day = F.to_date("ts")
    have = _columns(spark.table(table))
    made = {contract.KEY: primary_key(F.col("vin_id"), F.col("ts")), contract.LOAD: F.lit(load_id)}
    if contract.DAY in have:
        instant = cleaned.schema["ts"].dataType.simpleString() == "timestamp"
        zone = catalog.table_property(spark, table, "day.zone") if instant else None
        if zone and zone != spark.conf.get("spark.sql.session.timeZone"):
            raise ValueError(f"{table} counts days in {zone}; set the session to that zone")
        made[contract.DAY] = day
    small = gather_days and most_rows is not None and most_rows <= ONE_TASK_ROWS
    if small:
        whole = cleaned.coalesce(1).withColumns(made)
    else:
        rows = cleaned.drop(contract.KEY)
        if contract.DAY in have:
            rows, day = rows.withColumn(contract.DAY, made.pop(contract.DAY)), F.col(contract.DAY)
        if gather_days:
            rows = rows.hint("rebalance", day)
        whole = rows.withColumns(made)
    if contract.DAY in have:
        whole = clustered(whole)
    details = catalog.table_details(spark, table)
    of_files = _is_of_files(details)
    held = catalog.partition_values(spark, table, {contract.LOAD: load_id}) if of_files else []
    if small and not held and contract.DAY in have and _AS_IT_IS.fullmatch(load_id):
        codec = _codec(spark, details)
        fits = all(have.get(n) == t for n, t in _columns(whole).items())
        counts = _load_small(whole, table, load_id, details, codec) if codec and fits else None
        if counts:
            return counts
    seen = Observation() if count else None
    if seen:
        no_key = F.count(F.when(F.col("ts").isNull(), 1))
        whole = whole.observe(seen, F.count(F.lit(1)).alias("rows"), no_key.alias("null_keys"))
    if not of_files:
        whole.writeTo(table).overwrite(F.col(contract.LOAD) == load_id)
    else:
        replace_partitions(whole, table, details)
    if held:
        # One row per day.
        now = {r[0] for r in cleaned.select(F.to_date("ts").cast("string")).distinct().collect()}
        drop_partitions(spark, table, [p for p in held if p[contract.DAY] not in now])
    return (seen.get["rows"], seen.get["null_keys"]) if seen else None


_ARROW = {"bigint": pa.int64(), "string": pa.string()}


def _small_table(rows: list[tuple], columns: str) -> pa.Table:
    """Rows in memory; `columns` are names and types as in DDL."""
    named = [c.split() for c in columns.split(", ")]
    return pa.table({n: pa.array([r[i] for r in rows], _ARROW[t]) for i, (n, t) in enumerate(named)})


def _noted(spark: SparkSession, notes: str, rows: list[tuple], columns: str, load_id: str) -> None:
    """Notes of one load in a small table; a repeat replaces them, without rows they go."""
    known = catalog.table_exists(spark, notes)
    if rows and not known:
        spark.sql(
            f"CREATE TABLE {notes} ({columns}, `{contract.LOAD}` string) USING parquet "
            f"OPTIONS ('partitionOverwriteMode'='dynamic') PARTITIONED BY (`{contract.LOAD}`)"
        )
    if rows:
        if put_note(spark, notes, {contract.LOAD: load_id}, _small_table(rows, columns)):
            return
        schema = f"{columns}, {contract.LOAD} string"
        made = spark.createDataFrame([(*r, load_id) for r in rows], schema)
        replace_partitions(made.coalesce(1), notes)
    elif known and catalog.partition_values(spark, notes, {contract.LOAD: load_id}):
        drop_partitions(spark, notes, [{contract.LOAD: load_id}])


def note_rejected(spark: SparkSession, table: str, load_id: str, count: int) -> None:
    """Notes in `<table>_rejected` how many rows a load rejects; a repeat replaces the note."""
    _noted(spark, f"{table}_rejected", [(count,)] if count else [], "rows_rejected bigint", load_id)


def note_rejected_files(spark: SparkSession, table: str, load_id: str, unusable: list) -> None:
    """Notes in `<table>_rejected_files` the files that could not be loaded, by reason, with
    the name of one of them; a repeat replaces the notes."""
    rows = [(u.reason, u.files, u.rows, u.path) for u in unusable]
    columns = "reason string, files bigint, file_rows bigint, example string"
    _noted(spark, f"{table}_rejected_files", rows, columns, load_id)


def _columns(df: DataFrame) -> dict[str, T.DataType]:
    return {f.name: f.dataType for f in df.schema}


def iceberg_properties(compression: str) -> dict[str, str]:
    """Table properties that fix file format and codec."""
    return {"write.format.default": "parquet", "write.parquet.compression-codec": compression}


def create_table_as(
    df: DataFrame, table: str, partition_by: str, provider: str = "parquet", compression: str = "snappy"
) -> None:
    """Full refresh of a table partitioned by one column.

    The new rows are first completed in the shared folder; until then the old table
    stays as it is. If the columns are the same, the rows replace the partitions, and
    partitions without new rows are dropped; else the table is made anew from them.
    """
    spark = df.sparkSession
    exists = catalog.table_exists(spark, table)
    fits = exists and _columns(spark.table(table)) == _columns(df)
    if fits and not _is_file_table(spark, table):
        df.hint("rebalance", partition_by).writeTo(table).overwrite(F.lit(True))
        return

    def make(rows: DataFrame) -> None:
        if provider.lower() == "iceberg":
            made = rows.hint("rebalance", partition_by).writeTo(table).using(provider)
            for name, value in iceberg_properties(compression).items():
                made = made.tableProperty(name, value)
            made.partitionedBy(F.col(partition_by)).createOrReplace()
            return
        (
            rows.hint("rebalance", partition_by)
            .write.format(provider)
            .mode("overwrite")
            .option("compression", compression)
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(partition_by)
            .saveAsTable(table)
        )

    if not exists:
        make(df)
        return
    with stored(df, "refresh") as rows:
        if not fits or not _overwrites_dynamically(catalog.table_details(spark, table)):
            make(rows)
            return
        replace_partitions(rows.hint("rebalance", partition_by), table)
        now = {r[0] for r in rows.select(F.col(partition_by).cast("string")).distinct().collect()}
        held = catalog.partition_values(spark, table)
        drop_partitions(spark, table, [p for p in held if p[partition_by] not in now])


def replace_days(df: DataFrame, table: str, days: set, column: str = "date") -> None:
    """Replaces the partitions of these days; those that `df` has no rows for go."""
    spark = df.sparkSession
    if not _is_file_table(spark, table):
        on_day = F.col(column).isin([d for d in days if d is not None])
        df.writeTo(table).overwrite(on_day | F.col(column).isNull() if None in days else on_day)
        return
    now = {r[0] for r in df.select(column).distinct().collect()}
    replace_partitions(df.hint("rebalance", column), table)
    gone = {None if d is None else str(d) for d in days - now}
    drop_partitions(spark, table, [{column: d} for d in sorted(gone, key=str)])


# Archive codec names and the file format and codec that carry them.
EXPORT_CODECS = {
    "copy": ("parquet", "uncompressed"),
    "snappy": ("parquet", "snappy"),
    "lz4": ("parquet", "lz4"),
    "deflate": ("parquet", "gzip"),
    "zstd": ("parquet", "zstd"),
    "bzip2": ("json", "bzip2"),
}


def export_compressed(df: DataFrame, path: str, codec: str) -> None:
    if codec not in EXPORT_CODECS:
        raise ValueError(f"codec {codec} is not one of {sorted(EXPORT_CODECS)}")
    file_format, compression = EXPORT_CODECS[codec]
    df.write.format(file_format).mode("overwrite").option("compression", compression).save(path)


def read_export(spark: SparkSession, path: str, codec: str, schema) -> DataFrame:
    return spark.read.format(EXPORT_CODECS[codec][0]).schema(schema).load(path)


def export_split(df: DataFrame, path: str, max_rows_per_file: int) -> None:
    """Files of at most `max_rows_per_file` rows."""
    df.write.mode("overwrite").option("maxRecordsPerFile", max_rows_per_file).parquet(path)
