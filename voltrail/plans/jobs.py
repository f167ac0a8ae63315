"""The two batch jobs: landing files to table, table to summaries."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltrail import contract
from voltrail.operators import summaries
from voltrail.operators.clean import with_vehicle
from voltrail.plans import catalog, compaction, ledger, rollups, writes
from voltrail.sources import footers
from voltrail.sources.telemetry import read_cleaned, scan


# Fixed value: the table's name.
BASE_TABLE = "canbus01"


def ingest(
    spark: SparkSession,
    input_path: str,
    table: str,
    load_id: str,
    ts_type: T.DataType = T.TimestampType(),
    provider: str = "parquet",
    gather_days: bool = True,
    evolve: bool = False,
) -> DataFrame:
    """Reads, cleans and loads the landing files; returns the row-count audit.

    The data is read once, by the load. What was read is told by the landing files' footers,
    what was written by those of the load's own files, and what the table holds by its
    ledger, so tasks run twice cannot distort them and no file of another load is opened.
    Files whose columns differ in type are read in groups. Rows that name no vehicle, as from
    files without that column, are rejected and counted; a file that cannot be loaded stops
    the job before it writes. With `evolve`, plain columns outside the contract are loaded too:
    the table gets those it lacks, and rows of other loads have NULL there.
    """
    catalog.ensure_telemetry_table(spark, table, ts_type, provider)
    if not compaction.may_load(spark, table, load_id):
        raise ValueError(f"load {load_id} of {table} is closed: its rows may be packed with others")
    files = footers.landing_files(spark, input_path)
    found = footers.survey(files, extras=evolve)
    found.require()
    others, own = ledger.rows_by_load(spark, table, load_id)
    extras = found.extras if evolve else None
    cleaned = read_cleaned(spark, files, found, ts_type, [input_path], extras)
    if extras:
        writes.add_missing_columns(cleaned, table)
    writes.load_telemetry(with_vehicle(cleaned), table, load_id, gather_days)
    written, null_keys = ledger.own_rows(spark, table, load_id)
    ledger.note(spark, table, load_id, found.rows, written, null_keys)
    missing = [] if not found.groups else [c for c in contract.COLUMNS if c not in (*found.columns, contract.KEY)]
    row = (load_id, others + own, found.rows, written, found.rows - written, null_keys, others + written, missing)
    return spark.createDataFrame(
        [row],
        "load_id string, rows_before bigint, rows_read bigint, rows_written bigint, rows_rejected bigint, "
        "null_keys bigint, rows_after bigint, missing_columns array<string>",
    )


def _write_summaries(
    rollup: DataFrame, namespace: str, write: Callable[[DataFrame, str], None]
) -> list[str]:
    """Stores the rollup, then writes the three tables from it side by side."""
    targets = {f"{namespace}.{name}": build for name, build in summaries.FROM_ROLLUP.items()}
    with writes.stored(rollup, "mode-rollup") as rows, ThreadPoolExecutor(len(targets)) as pool:
        list(pool.map(lambda target: write(targets[target](rows), target), targets))
    return list(targets)


def refresh_summaries(spark: SparkSession, table: str, namespace: str, provider: str = "parquet") -> list[str]:
    """Rebuilds the three summary tables from one scan of the telemetry."""
    rollup = summaries.mode_rollup(scan(spark, table))
    return _write_summaries(
        rollup, namespace, lambda df, target: writes.create_table_as(df, target, "date", provider)
    )


def refresh_summary_days(
    spark: SparkSession, table: str, namespace: str, days: Iterable[dt.date | None]
) -> list[str]:
    """Replaces only the given days of the three summary tables.

    Reads only the partitions of those days; a day without rows left goes. The result
    equals a full rebuild when rows of other days did not change.
    """
    wanted = list(days)
    base = compaction.live_rows(spark, table)
    if contract.DAY in base.columns:
        base = base.where(rollups.on_days(F.col(contract.DAY), wanted))
    base = base.where(rollups.on_days(F.to_date("ts"), wanted)).select(*contract.COLUMNS)
    return _write_summaries(summaries.mode_rollup(base), namespace, _replacing(set(wanted)))


def _replacing(days: set) -> Callable[[DataFrame, str], None]:
    return lambda df, target: writes.replace_days(df, target, days)


def read_summary(spark: SparkSession, namespace: str, name: str) -> DataFrame:
    """A stored summary, with the columns in the order the builders give."""
    return summaries.ordered(catalog.fresh_table(spark, f"{namespace}.{name}"))


def loaded_days(spark: SparkSession, table: str, load_id: str) -> list[dt.date | None]:
    """Days a load has rows for: from the catalog, or for tables with hidden days from
    the rows."""
    if contract.DAY not in spark.table(table).columns:
        rows = catalog.fresh_table(spark, table).where(F.col(contract.LOAD) == load_id)
        return [r[0] for r in rows.select(F.to_date("ts")).distinct().collect()]
    held = catalog.partition_values(spark, table, {contract.LOAD: load_id})
    return [p[contract.DAY] and dt.date.fromisoformat(p[contract.DAY]) for p in held]


def ingest_and_summarize(
    spark: SparkSession,
    input_path: str,
    namespace: str,
    load_id: str,
    ts_type: T.DataType = T.TimestampType(),
    provider: str = "parquet",
    evolve: bool = False,
) -> DataFrame:
    """Both jobs in a row; returns the ingest audit.

    Summaries are built when absent, else only the days of this load are redone: those
    it has now and, for a repeat, those it had before. They are put together from the
    stored rollups of their loads, so of the telemetry only this load's rows are read.
    """
    table = f"{namespace}.{BASE_TABLE}"
    before = loaded_days(spark, table, load_id) if catalog.table_exists(spark, table) else []
    audit = ingest(spark, input_path, table, load_id, ts_type, provider, evolve=evolve)
    targets = [f"{namespace}.{name}" for name in summaries.SUMMARIES]
    if not all(catalog.table_exists(spark, t) for t in targets):
        refresh_summaries(spark, table, namespace, provider)
        return audit
    days = {*before, *loaded_days(spark, table, load_id)}
    if contract.DAY in spark.table(table).columns:
        rollups.store_missing(spark, table, replaced=load_id)
        _write_summaries(rollups.of_days(spark, table, days), namespace, _replacing(days))
    else:
        refresh_summary_days(spark, table, namespace, days)
    return audit
