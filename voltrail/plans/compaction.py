"""Many small loads of a day put together, while streams go on loading.

A load that will not be played again is closed: of a stream, every batch before the one in
work, since Spark starts a batch only when the last one is committed. The highest closed
batch of each stream is a property of the table, so a closed batch that is played again
all the same (from an older copy of a checkpoint) is known and skipped.

`compact` bins the closed partitions of a day by their bytes, writes each bin as one
partition `packed-<run>-<bin>`, ordered along vehicle and time, and takes the old ones away. What readers may see is one
property of the table, changed in one statement:

    writing:<run>   the packed partitions are not complete: `live_rows` leaves them out
    written:<run>   they are complete: `live_rows` leaves out the partitions they replace

Which partitions those are is a small table in the folder of the run. The old
partitions go at the next call, so readers that planned before still find their files.
A call that was cut short is taken up by the next one: half-written partitions go, complete ones
stay. One compaction at a time works on a table, told by a file that only one can make; a
second call does nothing. Loads may run beside it.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltrail import contract
from voltrail.plans import catalog, ledger, rollups, writes
from voltrail.session import claim, release

PACKED = ledger.PACKED
_STATE = "compaction"
_CLOSED = "closed."
#: Partitions of this many bytes or more are left as they are; bins are filled up to it.
TARGET_BYTES = 256 << 20
#: Bytes of a file of packed rows, about.
FILE_BYTES = 64 << 20
#: After so long a compaction that has not ended counts as lost.
STALE_SECONDS = 6 * 3600
_MEMBERS = f"`{contract.DAY}` date, `{contract.LOAD}` string, packed string"


def close_batches(spark: SparkSession, table: str, stream: str, before: int) -> None:
    """Notes that batches below `before` of a stream are committed."""
    if before > closed_before(spark, table, stream):
        catalog.set_property(spark, table, _CLOSED + stream, str(before))


def closed_before(spark: SparkSession, table: str, stream: str) -> int:
    """The first batch of a stream that is not closed."""
    return int(catalog.properties(spark, table).get(_CLOSED + stream, 0))


def _closed_streams(spark: SparkSession, table: str) -> dict[str, int]:
    found = catalog.properties(spark, table)
    return {k[len(_CLOSED) :]: int(v) for k, v in found.items() if k.startswith(_CLOSED)}


def _is_closed(load_id: str, streams: dict[str, int], settled: frozenset[str]) -> bool:
    if load_id.startswith(PACKED) or load_id in settled:
        return True
    stream, batch = ledger.batch_of(load_id)
    return batch is not None and batch < streams.get(stream, 0)


def _location(spark: SparkSession, table: str) -> str:
    return catalog.table_details(spark, table)["Location"]


def _members_path(spark: SparkSession, table: str, run: str) -> str:
    # Underscored folders hold no rows of the table.
    return f"{_location(spark, table)}/_compactions/{run}"


def _state(spark: SparkSession, table: str) -> tuple[str, str]:
    state, _, run = catalog.properties(spark, table).get(_STATE, "").partition(":")
    return state, run


def members(spark: SparkSession, table: str, run: str) -> DataFrame:
    return spark.read.schema(_MEMBERS).parquet(_members_path(spark, table, run))


def live_rows(spark: SparkSession, table: str) -> DataFrame:
    """The table as readers should see it, whatever a compaction is doing."""
    df = catalog.fresh_table(spark, table)
    if contract.DAY not in df.columns:
        return df
    state, run = _state(spark, table)
    if state == "writing":
        return df.where(~F.col(contract.LOAD).startswith(f"{PACKED}{run}-"))
    if state == "written":
        a, b = df.alias("a"), F.broadcast(members(spark, table, run).alias("b"))
        replaced = F.col(f"a.{contract.DAY}").eqNullSafe(F.col(f"b.{contract.DAY}")) & (
            F.col(f"a.{contract.LOAD}") == F.col(f"b.{contract.LOAD}")
        )
        return a.join(b, replaced, "left_anti")
    return df


def partition_sizes(spark: SparkSession, table: str) -> dict[tuple[str | None, str], int]:
    """Bytes per (day, load), from a listing of the table's folder; one row per partition."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    listed = files.option("pathGlobFilter", "*.parquet").load(_location(spark, table)).select("path", "length")
    place = f"/{contract.DAY}=([^/]+)/{contract.LOAD}=([^/]+)/[^/]+$"
    sizes = (
        listed.select(*[F.regexp_extract("path", place, i).alias(n) for i, n in ((1, "day"), (2, "load"))], "length")
        .where("day <> ''")
        .groupBy("day", "load")
        .agg(F.sum("length").alias("bytes"))
    )
    null = "__HIVE_DEFAULT_PARTITION__"
    return {
        (None if r["day"] == null else unquote(r["day"]), unquote(r["load"])): r["bytes"] for r in sizes.collect()
    }


def grown(sizes: dict[str, int], growth: float) -> dict[str, int]:
    """Loads without the large ones that the smaller ones together do not reach `growth` times.
    So a row is written again a few times only, however often its day is packed."""
    ordered = sorted(sizes.items(), key=lambda x: (x[1], x[0]))
    kept, below = 0, 0
    for i, (_, size) in enumerate(ordered):
        if below >= growth * size:
            kept = i + 1
        below += size
    return dict(ordered[:kept])


def bins(sizes: dict[str, int], target: int) -> list[list[str]]:
    """Loads smaller than `target` in bins of at most that many bytes, largest first; bins of
    one load are left out."""
    packed: list[list] = []
    for load, size in sorted(sizes.items(), key=lambda x: (-x[1], x[0])):
        if size >= target:
            continue
        fits = next((b for b in packed if b[0] + size <= target), None)
        if fits is None:
            packed.append([size, [load]])
        else:
            fits[0] += size
            fits[1].append(load)
    return [loads for _, loads in packed if len(loads) > 1]


@contextmanager
def _alone(spark: SparkSession, table: str) -> Iterator[bool]:
    """Whether no other compaction works on the table while the block runs."""
    place = f"{_location(spark, table)}/_compactions/working"
    mine = claim(spark, place, STALE_SECONDS)
    try:
        yield mine
    finally:
        if mine:
            release(spark, place)


def recover(spark: SparkSession, table: str) -> None:
    """Takes away what the last compaction left: replaced partitions, or half-written ones."""
    with _alone(spark, table) as mine:
        if mine:
            _recover(spark, table)


def _recover(spark: SparkSession, table: str) -> None:
    state, run = _state(spark, table)
    if not state:
        return
    if state == "writing":
        held = catalog.partition_values(spark, table)
        gone = [p for p in held if p[contract.LOAD].startswith(f"{PACKED}{run}-")]
    else:
        rows = members(spark, table, run).collect()  # one row per replaced partition
        gone = [{contract.DAY: r[0] and str(r[0]), contract.LOAD: r[1]} for r in rows]
    writes.drop_partitions(spark, table, gone)
    catalog.set_property(spark, table, _STATE, None)


def compact(
    spark: SparkSession,
    table: str,
    settled: tuple[str, ...] = (),
    target_bytes: int = TARGET_BYTES,
    least_loads: int = 2,
    file_bytes: int = FILE_BYTES,
    growth: float = 0.0,
    least_new: int = 0,
) -> int:
    """Packs the closed loads of days that have `least_loads` of them or more; returns how
    many partitions were replaced.

    Closed are batches of streams below the noted one and the batch loads named in `settled`,
    which must not be loaded again. With `growth`, loads much larger than the others of their
    day wait until these have grown; with `least_new`, days wait until they have so many loads
    that were not packed yet.
    """
    details = catalog.table_details(spark, table)
    if details.get("Provider", "").lower() not in writes.FILE_PROVIDERS or contract.DAY not in spark.table(table).columns:
        raise ValueError(f"{table} is no table that loads partition by day")
    with _alone(spark, table) as mine:
        if not mine:
            return 0
        return _compact(spark, table, settled, target_bytes, least_loads, file_bytes, growth, least_new)


def _listed(chosen: list[tuple[str | None, str, str]]) -> pa.Table:
    days = [None if day is None else dt.date.fromisoformat(day) for day, _, _ in chosen]
    loads, packed = [load for _, load, _ in chosen], [into for _, _, into in chosen]
    return pa.table({contract.DAY: pa.array(days, pa.date32()), contract.LOAD: loads, "packed": packed})


def _compact(
    spark: SparkSession,
    table: str,
    settled: tuple[str, ...],
    target_bytes: int,
    least_loads: int,
    file_bytes: int,
    growth: float,
    least_new: int,
) -> int:
    _recover(spark, table)
    streams, named = _closed_streams(spark, table), frozenset(settled)
    for load in named:
        catalog.set_property(spark, table, f"settled.{load}", "true")
    by_day: dict[str | None, dict[str, int]] = {}
    for (day, load), size in partition_sizes(spark, table).items():
        if _is_closed(load, streams, named):
            by_day.setdefault(day, {})[load] = size
    if catalog.table_exists(spark, rollups.rollup_of(table)):
        # Rows of a packed partition do not tell their load any more.
        rollups.store_missing(spark, table)
    run = uuid.uuid4().hex[:12]
    chosen, bin_bytes = [], []
    for day, sizes in sorted(by_day.items(), key=lambda x: str(x[0])):
        new = sum(not load.startswith(PACKED) for load in sizes)
        if len(sizes) >= least_loads and new >= least_new:
            for i, loads in enumerate(bins(grown(sizes, growth), target_bytes)):
                chosen += [(day, load, f"{PACKED}{run}-{i}") for load in loads]
                bin_bytes.append(sum(sizes[load] for load in loads))
    if catalog.table_exists(spark, ledger.ledger_of(table)):
        for stream, before in streams.items():
            ledger.fold(spark, table, stream, before)
    if not chosen:
        return 0
    if not writes.put_file(spark, table, f"_compactions/{run}", _listed(chosen)):
        listed = spark.createDataFrame(chosen, "day string, load string, packed string").select(
            F.col("day").cast("date").alias(contract.DAY), F.col("load").alias(contract.LOAD), "packed"
        )
        listed.coalesce(1).write.parquet(_members_path(spark, table, run))
    catalog.set_property(spark, table, _STATE, f"writing:{run}")
    replaced = members(spark, table, run)
    # Static filters, so only the folders of chosen days and loads are listed and read.
    days = sorted({d for d, _, _ in chosen if d is not None})
    on_days = F.col(contract.DAY).isin([F.lit(d).cast("date") for d in days])
    if any(d is None for d, _, _ in chosen):
        on_days = on_days | F.col(contract.DAY).isNull()
    rows = catalog.fresh_table(spark, table).where(on_days).alias("a")
    same = F.col(f"a.{contract.DAY}").eqNullSafe(F.col(f"b.{contract.DAY}")) & (
        F.col(f"a.{contract.LOAD}") == F.col(f"b.{contract.LOAD}")
    )
    joined = rows.join(F.broadcast(replaced.alias("b")), same)
    kept = [F.col(f"a.{c}") for c in rows.columns if c != contract.LOAD]
    packed = joined.select(*kept, F.col("b.packed").alias(contract.LOAD))
    if max(bin_bytes) <= file_bytes:
        # A file for each bin, written by several tasks.
        tasks = min(len(bin_bytes), spark.sparkContext.defaultParallelism)
        dealt = packed.repartition(tasks, contract.DAY, contract.LOAD)
    else:
        # Files of a day hold neighbouring vehicles, each of its own.
        dealt = packed.repartitionByRange(-(-sum(bin_bytes) // file_bytes), contract.DAY, contract.LOAD, "vin_id")
    writes.replace_partitions(writes.clustered(dealt), table)
    if _state(spark, table) != ("writing", run):
        raise RuntimeError(f"another compaction of {table} took over; its rows stay as they are")
    catalog.set_property(spark, table, _STATE, f"written:{run}")
    return len(chosen)


def may_load(spark: SparkSession, table: str, load_id: str) -> bool:
    """Whether a load may be written: a closed one may be in a packed partition already."""
    stream, batch = ledger.batch_of(load_id)
    found = catalog.properties(spark, table)
    if f"settled.{load_id}" in found:
        return False
    return batch is None or batch >= int(found.get(_CLOSED + stream, 0))
