"""Archive files as DataFrames of members.

Listing and reading are apart. `list_members` reads only what names the members
(for ZIP the directory at the end of the file) and gives one small row each, so
selecting, renaming, deduplicating and checking names are plain DataFrame work.
`read_members` then opens just the members that are left. Members carry a slice
number of their archive, and slices are spread over tasks, so one very large
archive is read by many tasks. Data comes in chunks, so a member of any size
keeps memory bounded.
"""

from __future__ import annotations

import bz2
import datetime as dt
import gzip
import lzma
import zipfile
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltrail.functions.columns import MAGIC, base_name, file_kind, member_output_name
from voltrail.session import task_count
from voltrail.sources import storage, zip_directory

CHUNK_BYTES = 32 << 20
SLICE_BYTES = 128 << 20
# The largest member that is read as one value.
WHOLE_BYTES = (1 << 31) - (1 << 16)
# Bytes of a ZIP directory that one task reads.
DIRECTORY_BYTES = 8 << 20
_BATCH_BYTES = 32 << 20
_BATCH_ROWS = 4096
_TASK_BYTES = 32 << 20
_TASK_FILES = 16

INVENTORY = (
    "path string, archive_bytes bigint, archive_modified timestamp, kind string, position int, "
    "member string, occurrence int, method string, compressed_size bigint, uncompressed_size bigint, "
    "is_directory boolean, modified timestamp_ntz, crc32 bigint, slice int, header_offset bigint, error string"
)

_INVENTORY_ARROW = pa.schema(
    [
        ("path", pa.string()),
        ("archive_bytes", pa.int64()),
        ("archive_micros", pa.int64()),
        ("kind", pa.string()),
        ("position", pa.int32()),
        ("member", pa.string()),
        ("occurrence", pa.int32()),
        ("method", pa.string()),
        ("compressed_size", pa.int64()),
        ("uncompressed_size", pa.int64()),
        ("is_directory", pa.bool_()),
        ("modified", pa.timestamp("us")),
        ("crc32", pa.int64()),
        ("slice", pa.int32()),
        ("header_offset", pa.int64()),
        ("error", pa.string()),
    ]
)
_INVENTORY_DDL = INVENTORY.replace("archive_modified timestamp", "archive_micros bigint")

# ZIP compression method numbers and their names.
ZIP_METHODS = {0: "COPY", 8: "DEFLATE", 9: "DEFLATE64", 12: "BZip2", 14: "LZMA", 93: "ZStandard"}
_ZIP_NUMBERS = {name: number for number, name in ZIP_METHODS.items()}
# One-member containers, their file suffix and method name.
STREAMS = {
    "gzip": (".gz", "DEFLATE"),
    "bzip2": (".bz2", "BZip2"),
    "xz": (".xz", "LZMA2"),
    "zstd": (".zst", "ZStandard"),
}
_READ_ERRORS = (zipfile.BadZipFile, zlib.error, lzma.LZMAError, EOFError, OSError, ValueError,
                RuntimeError, NotImplementedError)


class BadArchive(ValueError):
    """The file is not an archive that can be opened here."""


def read_archives(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """Archive files below `path`: `path, modificationTime, length`; content is not read.

    Spark's file sources pass over files of no bytes.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path).select("path", "modificationTime", "length")


def stream_archives(
    spark: SparkSession, path: str, glob: str | None = None, max_files_per_trigger: int | None = None
) -> DataFrame:
    """Archive files as they arrive, each once per checkpoint."""
    reader = (
        spark.readStream.format("binaryFile")
        .schema("path string, modificationTime timestamp, length bigint, content binary")
        .option("recursiveFileLookup", "true")
    )
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path).select("path", "modificationTime", "length")


def join_volumes(archives: DataFrame) -> DataFrame:
    """Archives kept as volumes `name.0001`, `name.0002`, …, one row per set.

    Files without a volume number stay as they are, and so do those of a set that does
    not begin at volume 1 (`drive.2024` is a name of its own). A set with a gap gets no
    length and is reported as not there.
    """
    number = F.regexp_extract("path", "\\.(\\d{4,})$", 1)
    base = F.regexp_replace("path", "\\.\\d{4,}$", "")
    parts = archives.withColumn("number", number).withColumn("base", base)
    least = F.min(F.col("number").try_cast("bigint")).over(Window.partitionBy("base"))
    parts = parts.withColumn("volume", F.when(least == 1, F.col("number")).otherwise(""))
    sets = (
        parts.groupBy("base", F.when(F.col("volume") == "", F.col("path")).alias("single"))
        .agg(
            F.max("modificationTime").alias("modificationTime"),
            F.sum("length").alias("bytes"),
            F.count("*").alias("volumes"),
            F.min(F.struct(F.col("volume").try_cast("bigint").alias("n"), "volume")).alias("first"),
            F.max(F.struct(F.col("volume").try_cast("bigint").alias("n"), "volume")).alias("last"),
        )
    )
    whole = F.col("last.n") == F.col("volumes")
    joined = F.format_string("%s.{%s..%s}", "base", "first.volume", "last.volume")
    # As for locate_archives: a small shuffle before file work.
    sets = sets.repartition(task_count(archives.sparkSession), "base")
    return sets.select(
        F.coalesce("single", joined).alias("path"),
        "modificationTime",
        F.when(F.col("single").isNotNull() | whole, F.col("bytes")).alias("length"),
    )


def locate_archives(keys: DataFrame, root: str, key: str = "key") -> DataFrame:
    """Archive files named by a table of object keys below `root`.

    A key named several times counts once; one that is not there gets no length.
    """
    found = "path string, modified_micros bigint, length bigint"

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened: dict = {}
        for batch in batches:
            rows = []
            for path in batch.column(0).to_pylist():
                there = storage.stat(path, opened)
                rows.append({"path": path, "modified_micros": there and there[1], "length": there and there[0]})
            yield pa.RecordBatch.from_pylist(
                rows, pa.schema([("path", pa.string()), ("modified_micros", pa.int64()), ("length", pa.int64())])
            )

    paths = keys.select(F.concat(F.lit(root.rstrip("/") + "/"), F.col(key)).alias("path")).distinct()
    # Few bytes that stand for much work: left alone they would end up in one task.
    paths = paths.repartition(task_count(keys.sparkSession), "path")
    return paths.mapInArrow(look_up, found).select(
        "path", F.timestamp_micros("modified_micros").alias("modificationTime"), "length"
    )


def partition_count(archives: DataFrame) -> int:
    """Tasks to read these archives with, from a small job over their sizes."""
    total = archives.agg(F.sum("length").alias("bytes"), F.count("*").alias("files")).first()
    return int(max((total["bytes"] or 0) // _TASK_BYTES, total["files"] // _TASK_FILES, 1))


def _kind(head: bytes) -> str:
    for name, magic in MAGIC:
        if head.startswith(bytes.fromhex(magic)):
            return name
    return "unknown"


def _chunks(stream, chunk_bytes: int) -> Iterator[bytes]:
    while chunk := stream.read(chunk_bytes):
        yield chunk


def _measured(chunks: Iterable[bytes]) -> tuple[int, int]:
    size = crc = 0
    for chunk in chunks:
        size += len(chunk)
        crc = zlib.crc32(chunk, crc)
    return size, crc


def _decoder(kind: str, source):
    if kind == "gzip":
        return gzip.GzipFile(fileobj=source)
    if kind == "bzip2":
        return bz2.BZ2File(source)
    if kind == "xz":
        return lzma.LZMAFile(source)
    import zstandard

    return zstandard.ZstdDecompressor().stream_reader(source, read_across_frames=True)


def _open_kind(path: str, opened: dict):
    source = storage.open_input(path, opened)
    kind = _kind(source.read(8))
    source.seek(0)
    return source, kind


def _zip_entry(info: zipfile.ZipInfo, position: int, piece: int) -> dict:
    try:
        modified = dt.datetime(*info.date_time)
    except ValueError:
        modified = None
    return {
        "position": position,
        "member": info.filename,
        "method": ZIP_METHODS.get(info.compress_type, str(info.compress_type)),
        "compressed_size": info.compress_size,
        "uncompressed_size": info.file_size,
        "is_directory": info.is_dir(),
        "modified": modified,
        "crc32": info.CRC,
        "slice": piece,
    }


def _zip_entries(source, slice_bytes: int) -> Iterator[dict]:
    seen: dict[str, int] = {}
    packed_before = 0
    with zipfile.ZipFile(source) as archive:
        for position, info in enumerate(archive.infolist()):
            occurrence = seen.get(info.filename, 0)
            seen[info.filename] = occurrence + 1
            yield {**_zip_entry(info, position, packed_before // slice_bytes), "occurrence": occurrence}
            packed_before += info.compress_size


def _stream_entry(kind: str, path: str, length: int, source, measure: bool) -> dict:
    """Size and checksum of a one-member container are known only after decoding it."""
    suffix, method = STREAMS[kind]
    size = crc = None
    if measure:
        with _decoder(kind, source) as stream:
            size, crc = _measured(_chunks(stream, 1 << 20))
    return {
        "position": 0,
        "member": path.rsplit("/", 1)[-1].removesuffix(suffix),
        "occurrence": 0,
        "method": method,
        "compressed_size": length,
        "uncompressed_size": size,
        "is_directory": False,
        "crc32": crc,
        "slice": 0,
    }


def _entries(
    path: str, length: int | None, slice_bytes: int, measure: bool, directory_bytes: int, opened: dict
) -> Iterator[dict]:
    """One dict per member, one without position for an empty archive, or an error."""
    if length is None:
        yield {"error": "no such file"}
        return
    kind = None
    try:
        source, kind = _open_kind(path, opened)
        with source:
            if kind == "zip":
                found = zip_directory.find(source)
                if found.end - found.start > directory_bytes:
                    return  # listed by ranges
                source.seek(0)
                count = 0
                for entry in _zip_entries(source, slice_bytes):
                    count += 1
                    yield {"kind": kind, **entry}
                if not count:
                    yield {"kind": kind}
            elif kind in STREAMS:
                yield {"kind": kind, **_stream_entry(kind, path, length, source, measure)}
            elif kind == "7z":
                raise BadArchive("no reader for 7z")
            else:
                raise BadArchive("not an archive")
    except (BadArchive, *_READ_ERRORS) as error:
        yield {"kind": kind, "error": f"{type(error).__name__}: {error}"}


def inventory(
    archives: DataFrame,
    slice_bytes: int = SLICE_BYTES,
    measure: bool = True,
    directory_bytes: int = DIRECTORY_BYTES,
) -> DataFrame:
    """Every member of every archive, and one row with `error` per unreadable one.

    An archive without members gives one row without position. Containers of one
    member (gzip and the like) do not state its size; without `measure` they are
    not decoded for it, and size and checksum are NULL.

    A ZIP directory of more than `directory_bytes` is cut into ranges of that size, which
    different tasks read; its members carry the place of their header, so reading them takes
    no directory. No task holds all names: which of equal names is which is settled by a
    window over archive and name. A range is no smaller than the longest record, so one begins
    in each.
    """
    if directory_bytes < zip_directory.RECORD_MOST:
        raise ValueError(f"ranges of less than {zip_directory.RECORD_MOST} bytes")

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened: dict = {}
        rows: list[dict] = []
        for batch in batches:
            for archive in batch.to_pylist():
                entries = _entries(
                    archive["path"], archive["archive_bytes"], slice_bytes, measure, directory_bytes, opened
                )
                for entry in entries:
                    rows.append({**archive, **entry})
                    if len(rows) >= _BATCH_ROWS:
                        yield pa.RecordBatch.from_pylist(rows, _INVENTORY_ARROW)
                        rows = []
        if rows:
            yield pa.RecordBatch.from_pylist(rows, _INVENTORY_ARROW)

    described = archives.select(
        "path",
        F.col("length").alias("archive_bytes"),
        F.unix_micros("modificationTime").alias("archive_micros"),
    )
    columns = [f.name for f in T.StructType.fromDDL(_INVENTORY_DDL)]
    listed = described.mapInArrow(expand, _INVENTORY_DDL)
    return listed.unionByName(_ranged(described, slice_bytes, directory_bytes)).select(
        *[
            F.timestamp_micros("archive_micros").alias("archive_modified") if c == "archive_micros" else c
            for c in columns
        ]
    )


_RANGES = (
    "path string, archive_bytes bigint, archive_micros bigint, start bigint, stop bigint, "
    "dir_start bigint, dir_end bigint, shift bigint"
)
_COUNTED = _RANGES + ", first bigint, after bigint, records bigint, packed bigint, error string"
_CHECKED = _COUNTED + ", border bigint"


def _by_archive(batches, opened: dict) -> Iterator[tuple]:
    """Rows of sorted batches with the source of their archive, opened once."""
    path = source = None
    try:
        for batch in batches:
            for row in batch.to_pylist():
                if row["path"] != path:
                    if source is not None:
                        source.close()
                    path, source = row["path"], storage.open_input(row["path"], opened)
                yield row, source
    finally:
        if source is not None:
            source.close()


def _in_batches(rows: Iterator[dict], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held: list[dict] = []
    for row in rows:
        held.append(row)
        if len(held) >= _BATCH_ROWS:
            yield pa.RecordBatch.from_pylist(held, schema)
            held = []
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


def _arrow(ddl: str) -> pa.Schema:
    names = {"string": pa.string(), "bigint": pa.int64(), "int": pa.int32()}
    return pa.schema([(n, names[t]) for n, t in (f.split() for f in ddl.split(", "))])


def _ranged(described: DataFrame, slice_bytes: int, directory_bytes: int) -> DataFrame:
    """Members of the ZIP files whose directory is larger than one range."""

    def cut(batches):
        opened: dict = {}

        def ranges() -> Iterator[dict]:
            for batch in batches:
                for archive in batch.to_pylist():
                    if archive["archive_bytes"] is None:
                        continue
                    try:
                        source, kind = _open_kind(archive["path"], opened)
                        with source:
                            if kind != "zip":
                                continue
                            found = zip_directory.find(source)
                    except _READ_ERRORS:
                        continue  # the other listing tells why
                    if found.end - found.start <= directory_bytes:
                        continue
                    for start in range(found.start, found.end, directory_bytes):
                        yield {
                            **archive,
                            "start": start,
                            "stop": min(start + directory_bytes, found.end),
                            "dir_start": found.start,
                            "dir_end": found.end,
                            "shift": found.shift,
                        }

        yield from _in_batches(ranges(), _arrow(_RANGES))

    def count(batches):
        def counted() -> Iterator[dict]:
            for row, source in _by_archive(batches, {}):
                place = zip_directory.Directory(row["dir_start"], row["dir_end"], row["shift"])
                try:
                    yield {**row, **zip_directory.count(source, row["start"], row["stop"], place)._asdict()}
                except zipfile.BadZipFile as error:
                    yield {**row, "error": f"BadZipFile: {error}"}

        yield from _in_batches(counted(), _arrow(_COUNTED))

    def check(batches):
        """Counts again where a range did not begin at its neighbour's border."""

        def checked() -> Iterator[dict]:
            opened: dict = {}
            for batch in batches:
                for row in batch.to_pylist():
                    border = row["border"]
                    # A range may lie within one record: none begins in it.
                    agrees = border is None or row["first"] == border or (not row["records"] and border >= row["stop"])
                    if row["error"] is not None or not agrees:
                        place = zip_directory.Directory(row["dir_start"], row["dir_end"], row["shift"])
                        with storage.open_input(row["path"], opened) as source:
                            try:
                                again = zip_directory.count(source, row["start"], row["stop"], place, border)
                                if row["records"] and again.after != row["after"]:
                                    raise zipfile.BadZipFile("records of the directory do not follow each other")
                                row |= {**again._asdict(), "error": None}
                            except zipfile.BadZipFile as error:
                                row["error"] = f"BadZipFile: {error}"
                    yield row

        yield from _in_batches(checked(), _arrow(_CHECKED))

    def read(batches):
        def members() -> Iterator[dict]:
            for row, source in _by_archive(batches, {}):
                kept = {c: row[c] for c in ("path", "archive_bytes", "archive_micros")} | {"kind": "zip"}
                if row["error"] is not None:
                    yield {**kept, "error": row["error"]}
                    continue
                position, packed = row["position_before"], row["packed_before"]
                for info in zip_directory.entries(source, row["first"], row["after"]):
                    entry = _zip_entry(info, position, packed // slice_bytes)
                    yield {**kept, **entry, "header_offset": info.header_offset + row["shift"]}
                    position += 1
                    packed += info.compress_size

        yield from _in_batches(members(), _INVENTORY_ARROW)

    tasks = task_count(described.sparkSession)
    ranges = described.mapInArrow(cut, _RANGES)
    # Rows that stand for much work each: dealt out, a few to a task.
    counted = ranges.repartition(tasks, "path", "start").sortWithinPartitions("path", "start").mapInArrow(count, _COUNTED)
    before = Window.partitionBy("path").orderBy("start")
    sums = before.rowsBetween(Window.unboundedPreceding, -1)
    all_of = Window.partitionBy("path")
    border = F.last(F.when(F.col("records") > 0, F.col("after")), True).over(sums)
    checked = counted.withColumn("border", border).mapInArrow(check, _CHECKED)
    placed = (
        checked.withColumns(
            {
                "position_before": F.coalesce(F.sum("records").over(sums), F.lit(0)),
                "packed_before": F.coalesce(F.sum("packed").over(sums), F.lit(0)),
                "whole_error": F.min("error").over(all_of),
                "row": F.row_number().over(before),
            }
        )
        # A directory that is damaged anywhere is told once, and none of it is listed.
        .where(F.when(F.col("whole_error").isNull(), F.col("records") > 0).otherwise(F.col("row") == 1))
        .withColumn("error", F.col("whole_error"))
        .drop("whole_error", "row", "border")
    )
    listed = placed.repartition(tasks, "path", "start").sortWithinPartitions("path", "start").mapInArrow(read, _INVENTORY_DDL)
    same_name = Window.partitionBy("path", "member").orderBy("position")
    number = F.when(F.col("position").isNotNull(), F.row_number().over(same_name) - 1)
    return listed.withColumn("occurrence", number.cast("int"))


def members_of(listed: DataFrame) -> DataFrame:
    """The inventory without unreadable and empty archives."""
    return listed.where(F.col("position").isNotNull())


def quarantine_of(listed: DataFrame) -> DataFrame:
    """Archives or members that could not be read, with the reason."""
    return listed.where(F.col("error").isNotNull()).select("path", "member", "error")


def list_members(
    archives: DataFrame, slice_bytes: int = SLICE_BYTES, measure: bool = True
) -> DataFrame:
    return members_of(inventory(archives, slice_bytes, measure))


def summarize(listed: DataFrame) -> DataFrame:
    """One row per archive: size, methods, blocks, members and total bytes."""
    data = ~F.col("is_directory") & (F.col("uncompressed_size") > 0)
    return listed.groupBy("path").agg(
        F.first("kind").alias("kind"),
        F.first("archive_bytes").alias("archive_bytes"),
        F.array_join(F.array_sort(F.collect_set(F.when(data, F.col("method")))), ", ").alias("methods"),
        F.lit(False).alias("solid"),
        F.count(F.when(data, 1)).alias("blocks"),
        F.count("position").alias("members"),
        F.coalesce(F.sum("uncompressed_size"), F.lit(0)).alias("total_uncompressed"),
        F.max("error").alias("error"),
    )


def select_members(
    members: DataFrame,
    names: Iterable[str] | DataFrame = (),
    prefixes: Iterable[str] = (),
) -> DataFrame:
    """Members of exactly these names, or starting with one of the prefixes.

    `names` may be a DataFrame with a `member` column when there are very many.
    """
    if isinstance(names, DataFrame):
        if prefixes:
            raise ValueError("give either a table of names or prefixes")
        return members.join(names.select("member").distinct(), "member", "left_semi")
    wanted = F.col("member").isin(list(names))
    for prefix in prefixes:
        wanted = wanted | F.col("member").startswith(prefix)
    return members.where(wanted)


def with_output_names(members: DataFrame) -> DataFrame:
    """`output_name`: repeated names within an archive get `_0`, `_1`, … from the second on."""
    return members.withColumn(
        "output_name", member_output_name(F.col("member"), F.col("occurrence"))
    )


def last_by_base_name(members: DataFrame) -> DataFrame:
    """One member per base name: that of the newest archive, by path and position after."""
    files = members.where(~F.col("is_directory"))
    order = F.struct("archive_modified", "path", "position")
    rest = [c for c in files.columns if c not in ("archive_modified", "path", "position")]
    newest = files.groupBy(base_name(F.col("member")).alias("base_name")).agg(
        F.max(F.struct(order.alias("order"), F.struct(*rest).alias("rest"))).alias("last")
    )
    return newest.select("base_name", "last.order.*", "last.rest.*").select("base_name", *files.columns)


def data_members(listed: DataFrame) -> DataFrame:
    """Members that hold data: no directories, no unreadable archives."""
    return listed.where(F.col("position").isNotNull() & ~F.col("is_directory"))


def _spread(rows: DataFrame, partitions: int | None) -> DataFrame:
    """Slices over tasks, members of a slice in order so its archive is opened once."""
    count = partitions or task_count(rows.sparkSession)
    return rows.repartition(count, "path", "slice").sortWithinPartitions("path", "position")


_READ_BY = ["path", "kind", "position", "method", "compressed_size", "uncompressed_size", "crc32", "header_offset"]


class _Members:
    """Opens the members of consecutive rows, one archive at a time."""

    def __init__(self, chunk_bytes: int):
        self.chunk_bytes = chunk_bytes
        self.opened: dict = {}
        self.path = self.source = self.archive = None

    def close(self) -> None:
        for held in (self.archive, self.source):
            if held is not None:
                held.close()
        self.path = self.source = self.archive = None

    def chunks(self, row: dict) -> Iterator[bytes]:
        path, kind = row["path"], row["kind"]
        if row["header_offset"] is not None:
            if path != self.path:
                self.close()
                self.source, self.path = storage.open_input(path, self.opened), path
            method = _ZIP_NUMBERS.get(row["method"]) or int(row["method"] if row["method"].isdigit() else 0)
            sizes = row["compressed_size"], row["uncompressed_size"], row["crc32"]
            with zip_directory.open_member(self.source, row["header_offset"], method, *sizes) as stream:
                yield from _chunks(stream, self.chunk_bytes)
            return
        if kind != "zip":
            self.close()
            with storage.open_input(path, self.opened) as source, _decoder(kind, source) as stream:
                yield from _chunks(stream, self.chunk_bytes)
            return
        if path != self.path or self.archive is None:
            self.close()
            self.source = storage.open_input(path, self.opened)
            self.archive = zipfile.ZipFile(self.source)
            self.path = path
        with self.archive.open(self.archive.infolist()[row["position"]]) as stream:
            yield from _chunks(stream, self.chunk_bytes)


def _extended(batch: pa.RecordBatch, rows: list[int], added: dict[str, pa.Array]) -> pa.RecordBatch:
    kept = batch.take(pa.array(rows, pa.int64()))
    return pa.RecordBatch.from_arrays(
        [*kept.columns, *added.values()], [*kept.schema.names, *added.keys()]
    )


def _read_batches(batches, chunk_bytes: int) -> Iterator[pa.RecordBatch]:
    reader = _Members(chunk_bytes)
    try:
        for batch in batches:
            keys = batch.select(_READ_BY).to_pylist()
            directory = batch.column("is_directory").to_pylist()
            out: list[tuple[int, int | None, bytes | None, str | None]] = []
            held = 0

            def flush() -> pa.RecordBatch:
                return _extended(
                    batch,
                    [o[0] for o in out],
                    {
                        "chunk": pa.array([o[1] for o in out], pa.int32()),
                        "data": pa.array([o[2] for o in out], pa.binary()),
                        "read_error": pa.array([o[3] for o in out], pa.string()),
                    },
                )

            for row, key in enumerate(keys):
                if key["position"] is None or directory[row]:
                    out.append((row, None, None, None))
                    continue
                number = 0
                try:
                    for chunk in reader.chunks(key):
                        out.append((row, number, chunk, None))
                        number += 1
                        held += len(chunk)
                        if held >= _BATCH_BYTES:
                            yield flush()
                            out, held = [], 0
                    if not number:
                        out.append((row, 0, b"", None))
                except _READ_ERRORS as error:
                    reader.close()
                    out.append((row, number, None, f"{type(error).__name__}: {error}"))
            if out:
                yield flush()
    finally:
        reader.close()


def read_members(
    members: DataFrame, partitions: int | None = None, chunk_bytes: int = CHUNK_BYTES
) -> DataFrame:
    """The columns of `members` with `chunk, data, read_error`.

    A member of up to `chunk_bytes` is one row, a larger one several. The stored
    checksum is verified on the way; a bad member ends in a row with `read_error`.
    Directories are left out.
    """
    return read_inventory(data_members(members), partitions, chunk_bytes)


def read_whole(members: DataFrame, partitions: int | None = None) -> DataFrame:
    """As `read_members`, each member in one row, for data that may not be cut anywhere.

    What does not fit one value (2 GB) ends in `read_error`; read such members in
    chunks, or land them and let Spark's readers split the files.
    """
    read = read_members(members, partitions, WHOLE_BYTES)
    cut = F.col("uncompressed_size") > WHOLE_BYTES
    return read.where(F.col("chunk").isNull() | (F.col("chunk") == 0)).withColumns(
        {
            "data": F.when(~F.coalesce(cut, F.lit(False)), F.col("data")),
            "read_error": F.when(cut, F.lit("larger than one value")).otherwise(F.col("read_error")),
        }
    )


def read_inventory(
    listed: DataFrame, partitions: int | None = None, chunk_bytes: int = CHUNK_BYTES
) -> DataFrame:
    """As `read_members`, with directories and unreadable archives kept as rows without data."""
    placed = _spread(listed, partitions)
    schema = T.StructType(
        [
            *placed.schema.fields,
            T.StructField("chunk", T.IntegerType()),
            T.StructField("data", T.BinaryType()),
            T.StructField("read_error", T.StringType()),
        ]
    )
    return placed.mapInArrow(lambda batches: _read_batches(batches, chunk_bytes), schema)


def _visit_batches(batches, chunk_bytes: int, visit) -> Iterator[pa.RecordBatch]:
    """One output row per member, from what `visit` makes of its chunks."""
    reader = _Members(chunk_bytes)
    try:
        for batch in batches:
            results = []
            for row in batch.to_pylist():
                if row["position"] is None or row["is_directory"] or row.get("target", "") is None:
                    results.append((None, None, None))
                    continue
                try:
                    chunks = reader.chunks(row)
                    results.append((*visit(row, chunks, reader.opened), None))
                except _READ_ERRORS as error:
                    reader.close()
                    results.append((None, None, f"{type(error).__name__}: {error}"))
            yield _extended(
                batch,
                list(range(batch.num_rows)),
                {
                    "bytes_read": pa.array([r[0] for r in results], pa.int64()),
                    "data_crc32": pa.array([r[1] for r in results], pa.int64()),
                    "read_error": pa.array([r[2] for r in results], pa.string()),
                },
            )
    finally:
        reader.close()


def _measure(row: dict, chunks: Iterable[bytes], opened: dict) -> tuple[int, int]:
    return _measured(chunks)


def _store(row: dict, chunks: Iterable[bytes], opened: dict) -> tuple[int, int]:
    return storage.write_file(row["target"], chunks, opened)


def _visited(rows: DataFrame, partitions: int | None, chunk_bytes: int, visit) -> DataFrame:
    placed = _spread(rows, partitions)
    schema = T.StructType(
        [
            *placed.schema.fields,
            T.StructField("bytes_read", T.LongType()),
            T.StructField("data_crc32", T.LongType()),
            T.StructField("read_error", T.StringType()),
        ]
    )
    return placed.mapInArrow(lambda batches: _visit_batches(batches, chunk_bytes, visit), schema)


def _verified(rows: DataFrame, partitions: int | None) -> DataFrame:
    visited = _visited(rows, partitions, 1 << 20, _measure)
    intact = (
        F.col("read_error").isNull()
        & (F.col("bytes_read") == F.coalesce("uncompressed_size", "bytes_read"))
        & (F.col("data_crc32") == F.coalesce("crc32", "data_crc32"))
    )
    return visited.withColumn("intact", F.coalesce(intact, F.lit(False)))


def verify_members(members: DataFrame, partitions: int | None = None) -> DataFrame:
    """Reads every member and compares sizes and checksums; no data leaves the tasks."""
    return _verified(data_members(members), partitions)


def integrity(listed: DataFrame, partitions: int | None = None) -> DataFrame:
    """Per archive of an inventory: `ok`, `bad` with the first bad member, or `unreadable`."""
    is_data = F.col("position").isNotNull() & ~F.col("is_directory")
    bad = is_data & ~F.col("intact")
    per_archive = (
        _verified(listed, partitions)
        .groupBy("path")
        .agg(
            F.max(F.col("position").isNull() & F.col("error").isNotNull()).alias("unreadable"),
            F.min(F.when(bad, F.struct("position", "member"))).alias("first"),
            F.count(F.when(is_data, 1)).alias("members_read"),
        )
    )
    status = F.when(F.col("unreadable"), "unreadable").when(F.col("first").isNotNull(), "bad").otherwise("ok")
    return per_archive.select(
        "path", status.alias("status"), F.col("first.member").alias("first_bad"), "members_read"
    )


def land_members(
    rows: DataFrame, partitions: int | None = None, chunk_bytes: int = 4 << 20
) -> DataFrame:
    """Writes each member to the file its `target` column names; returns the manifest.

    Tasks copy straight from archive to file; rows without target pass through.
    Work happens when the manifest is written or counted. Targets must be unique:
    use `last_by_base_name` where several members would share one.
    """
    return _visited(rows, partitions, chunk_bytes, _store)


def with_head(archives: DataFrame, size: int = 8) -> DataFrame:
    """Adds `head`, the first bytes of each file, without reading the rest."""

    def read_heads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened: dict = {}
        for batch in batches:
            heads = []
            for path in batch.column("path").to_pylist():
                fs, name = storage.locate(path, opened)
                with fs.open_input_file(name) as source:
                    heads.append(source.read(size))
            yield _extended(batch, list(range(batch.num_rows)), {"head": pa.array(heads, pa.binary())})

    schema = T.StructType([*archives.schema.fields, T.StructField("head", T.BinaryType())])
    return archives.mapInArrow(read_heads, schema)


def sniff(archives: DataFrame) -> DataFrame:
    """File type of every file by its leading bytes."""
    return with_head(archives).withColumn("kind", file_kind(F.col("head"))).drop("head")
