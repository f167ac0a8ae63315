"""What each load brought, kept next to the table as `<table>_loads`.

One row per load: rows read, written, rejected, and written without key. A load counts
its own rows once, from the footers of the files it wrote (rows without key are those
without time, so the partitions tell them). Totals of the table are sums of this small
table, so an audit opens no file of another load.

Closed batches of a stream are folded into one note, `<stream>-<last batch>+`, so the ledger
does not grow with the number of batches. A note counts as soon as it is there, and those that it
covers stop counting at the same moment; taking them away is only cleaning.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltrail import contract
from voltrail.plans import catalog, writes

_COUNTS = ("rows_read", "rows_written", "rows_rejected", "null_keys")
_SCHEMA = ", ".join(f"{c} bigint" for c in _COUNTS) + f", {contract.LOAD} string"
#: Partitions that hold the rows of several closed loads have ids that begin so; their
#: rows are noted under the loads they came from.
PACKED = "packed-"


def ledger_of(table: str) -> str:
    return f"{table}_loads"


def batch_load_id(stream: str, batch_id: int) -> str:
    return f"{stream}-{batch_id:09d}"


def batch_of(load_id: str) -> tuple[str, int | None]:
    """Stream and batch of a stream's load; other loads have no batch."""
    stream, _, batch = load_id.rpartition("-")
    return (stream, int(batch)) if stream and batch.isdigit() else (load_id, None)


def _ensure(spark: SparkSession, table: str) -> str:
    name = ledger_of(table)
    if not catalog.table_exists(spark, name):
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} ({_SCHEMA}) USING parquet "
            f"OPTIONS ('partitionOverwriteMode'='dynamic') PARTITIONED BY (`{contract.LOAD}`)"
        )
    return name


def _notes(spark: SparkSession, name: str) -> tuple[set[str], dict[str, int]]:
    """Ids that have a note, and per stream the last batch that a folded note covers."""
    ids = {p[contract.LOAD] for p in catalog.partition_values(spark, name)}
    covered: dict[str, int] = {}
    for note_id in ids:
        if note_id.endswith("+"):
            stream, last = batch_of(note_id[:-1])
            covered[stream] = max(covered.get(stream, -1), last)
    return ids, covered


def _counts(note_id: str, covered: dict[str, int]) -> bool:
    """Whether a note counts, or a folded one stands for it."""
    stream, batch = batch_of(note_id.removesuffix("+"))
    last = covered.get(stream, -1)
    return batch is None or batch > last or (batch == last and note_id.endswith("+"))


def own_rows(spark: SparkSession, table: str, load_id: str) -> tuple[int, int]:
    """Rows a load has in the table and how many of them have no key, from the footers
    of its files."""
    own = catalog.fresh_table(spark, table).where(F.col(contract.LOAD) == load_id)
    if contract.DAY not in own.columns:
        counts = own.agg(F.count("*").alias("n"), F.count(contract.KEY).alias("keys")).first()
        return counts["n"], counts["n"] - counts["keys"]
    days = own.groupBy(contract.DAY).count().collect()  # one row per day of the load
    return sum(r["count"] for r in days), sum(r["count"] for r in days if r[contract.DAY] is None)


def note(spark: SparkSession, table: str, load_id: str, read: int, written: int, null_keys: int) -> None:
    """Notes a load; the same load again replaces its note."""
    _put(spark, _ensure(spark, table), load_id, (read, written, read - written, null_keys))


def _put(spark: SparkSession, name: str, note_id: str, counts: tuple) -> None:
    """One note, in a partition of its own; where there is one already, in one statement."""
    made = pa.table({c: pa.array([int(n)], pa.int64()) for c, n in zip(_COUNTS, counts)})
    if writes.put_note(spark, name, {contract.LOAD: note_id}, made):
        return
    values = ", ".join(f"{int(c)}L" for c in counts)
    place = f"PARTITION (`{contract.LOAD}`={writes.literal(note_id)})"
    spark.sql(f"INSERT OVERWRITE TABLE {name} {place} SELECT {values}")


def loads(spark: SparkSession, table: str) -> DataFrame:
    """The notes that count: one per load, or per stream and its folded batches."""
    name = _ensure(spark, table)
    ids, covered = _notes(spark, name)
    stale = [x for x in ids if not _counts(x, covered)]
    noted = catalog.fresh_table(spark, name)
    return noted.where(~F.col(contract.LOAD).isin(stale)) if stale else noted


def unnoted(spark: SparkSession, table: str) -> list[str]:
    """Loads that have rows but no note, as those written without a job."""
    ids, covered = _notes(spark, _ensure(spark, table))
    if contract.DAY in spark.table(table).columns:
        held = {p[contract.LOAD] for p in catalog.partition_values(spark, table)}
    else:
        rows = catalog.fresh_table(spark, table).select(contract.LOAD).distinct().collect()
        held = {r[0] for r in rows}
    return sorted(x for x in held - ids if x and not x.startswith(PACKED) and _counts(x, covered))


def rows_by_load(spark: SparkSession, table: str, load_id: str) -> tuple[int, int]:
    """Rows of the table by its ledger: of all other loads, and of this one.

    Loads without a note are counted from their own footers and noted first.
    """
    for other in unnoted(spark, table):
        written, null_keys = own_rows(spark, table, other)
        note(spark, table, other, written, written, null_keys)
    own = F.col(contract.LOAD) == load_id
    sums = [F.coalesce(F.sum(F.when(test, F.col("rows_written"))), F.lit(0)) for test in (~own, own)]
    return tuple(loads(spark, table).agg(*sums).first())


def fold(spark: SparkSession, table: str, stream: str, before: int) -> None:
    """Folds the notes of a stream's batches below `before` into one."""
    name = _ensure(spark, table)
    ids, covered = _notes(spark, name)
    mine = [x for x in ids if batch_of(x.removesuffix("+"))[0] == stream]
    batches = [batch_of(x.removesuffix("+"))[1] for x in mine if _counts(x, covered)]
    closed = [b for b in batches if b is not None and b < before]
    if len(closed) > 1:
        last = max(closed)
        counted = [x for x in mine if _counts(x, covered) and batch_of(x.removesuffix("+"))[1] <= last]
        whole = catalog.fresh_table(spark, name).where(F.col(contract.LOAD).isin(counted))
        sums = whole.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in _COUNTS]).first()
        _put(spark, name, batch_load_id(stream, last) + "+", tuple(sums[c] for c in _COUNTS))
        covered[stream] = last
    stale = [x for x in mine if not _counts(x, covered)]
    writes.drop_partitions(spark, name, [{contract.LOAD: x} for x in stale])
