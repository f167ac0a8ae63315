"""Rows to ZIP volumes and to plain files."""

from __future__ import annotations

import io
import warnings
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltrail.session import task_count
from voltrail.sources import storage

VOLUME_BYTES = 10 << 20
SHARD_BYTES = 1 << 30
_LISTED_ARCHIVES = 10_000

# Method names and the ZIP methods that carry them.
METHODS = {
    "COPY": zipfile.ZIP_STORED,
    "DEFLATE": zipfile.ZIP_DEFLATED,
    "BZip2": zipfile.ZIP_BZIP2,
    "LZMA": zipfile.ZIP_LZMA,
}

VOLUMES = "archive string, shard int, volume int, members int, content binary"
_VOLUMES_ARROW = pa.schema(
    [
        ("archive", pa.string()),
        ("shard", pa.int32()),
        ("volume", pa.int32()),
        ("members", pa.int32()),
        ("content", pa.binary()),
    ]
)


class _Volume:
    def __init__(self, archive: str, shard: int, number: int, method: int):
        self.key = (archive, shard)
        self.number = number
        self.members = self.size = 0
        self.buffer = io.BytesIO()
        self.zip = zipfile.ZipFile(self.buffer, "w", method)
        self.method = method

    def add(self, member: str, data: bytes) -> None:
        info = zipfile.ZipInfo(member)
        info.compress_type = self.method
        self.zip.writestr(info, data)
        self.members += 1
        self.size += len(data)

    def finish(self) -> pa.RecordBatch:
        self.zip.close()
        archive, shard = self.key
        row = {
            "archive": archive,
            "shard": shard,
            "volume": self.number,
            "members": self.members,
            "content": self.buffer.getvalue(),
        }
        return pa.RecordBatch.from_pylist([row], _VOLUMES_ARROW)


def _volumes(batches, volume_bytes: int, method: int) -> Iterator[pa.RecordBatch]:
    """Cuts sorted rows into volumes; holds one volume at a time."""
    warnings.filterwarnings("ignore", "Duplicate name")  # repeated names are allowed
    current: _Volume | None = None
    for batch in batches:
        for i in range(batch.num_rows):
            key = (batch.column(0)[i].as_py(), batch.column(1)[i].as_py())
            member, data = batch.column(2)[i].as_py(), batch.column(3)[i].as_py() or b""
            if current is not None and current.key != key:
                yield current.finish()
                current = None
            elif current is not None and current.size + len(data) > volume_bytes:
                yield current.finish()
                current = _Volume(*key, current.number + 1, method)
            if current is None:
                current = _Volume(*key, 0, method)
            current.add(member, data)
    if current is not None:
        yield current.finish()


def _shards(df: DataFrame, order: list[str], shard_bytes: int) -> DataFrame:
    """Adds `shard`: archives above `shard_bytes` are dealt out over several shards.

    Only the names of such archives are looked up. Their number is checked: up
    to a fixed count they are broadcast, beyond it an ordinary join is used.
    """
    sizes = df.groupBy("archive").agg(F.sum(F.octet_length("data")).alias("bytes"))
    large = sizes.where(F.col("bytes") > shard_bytes).select(
        "archive", F.ceil(F.col("bytes") / shard_bytes).cast("int").alias("shards")
    )
    listed = large.limit(_LISTED_ARCHIVES + 1).collect()
    if not listed:
        return df.withColumn("shard", F.lit(0))
    if len(listed) <= _LISTED_ARCHIVES:
        large = F.broadcast(df.sparkSession.createDataFrame(listed, large.schema))
    return df.join(large, "archive", "left").withColumn(
        "shard", F.coalesce(_dealt(order, F.col("shards")), F.lit(0))
    )


def _dealt(order: list[str], shards: Column) -> Column:
    return F.pmod(F.xxhash64("member", *order), shards).cast("int")


def pack(
    df: DataFrame,
    archive: Column,
    member: Column,
    data: Column,
    order: list[str],
    method: str = "DEFLATE",
    volume_bytes: int = VOLUME_BYTES,
    shard_bytes: int = SHARD_BYTES,
    shards: int | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """ZIP volumes `archive, shard, volume, members, content`.

    Rows of an archive are packed in `order`, which must be unique within it, and
    a new volume begins when the data would exceed `volume_bytes`. Archives larger
    than `shard_bytes` are split over tasks first. Finding them reads all sizes once;
    give `shards` to split every archive alike instead and read the data only once.
    Volumes depend on the rows only, so a repeated run gives the same ones.
    """
    rows = df.select(
        archive.cast("string").alias("archive"),
        member.alias("member"),
        data.cast("binary").alias("data"),
        *order,
    )
    if shards is None:
        sharded = _shards(rows, order, shard_bytes)
    else:
        sharded = rows.withColumn("shard", _dealt(order, F.lit(shards)))
    count = partitions or task_count(df.sparkSession)
    number = METHODS[method]
    return (
        sharded.repartition(count, "archive", "shard")
        .sortWithinPartitions("archive", "shard", *order)
        .select("archive", "shard", "member", "data")
        .mapInArrow(lambda batches: _volumes(batches, volume_bytes, number), VOLUMES)
    )


def volume_name() -> Column:
    """File name of a packed volume."""
    return F.format_string("%s-%05d-%05d.zip", "archive", "shard", "volume")


def split_volumes(files: DataFrame, volume_bytes: int = VOLUME_BYTES) -> DataFrame:
    """Files `target, content` cut into volumes `target.0001`, `target.0002`, …

    Every volume but the last of a file has exactly `volume_bytes`.
    """
    count = F.greatest(F.ceil(F.length("content") / volume_bytes), F.lit(1)).cast("int")
    numbered = files.select("target", "content", F.explode(F.sequence(F.lit(1), count)).alias("n"))
    start = (F.col("n") - 1) * volume_bytes + 1
    return numbered.select(
        F.format_string("%s.%04d", "target", "n").alias("target"),
        F.substring(F.col("content"), start, F.lit(volume_bytes)).alias("content"),
    )


def write_files(df: DataFrame, target: Column, content: Column) -> DataFrame:
    """Writes one file per row; returns the manifest `target, bytes, crc32`.

    Work happens when the manifest is written or counted. Targets must be unique.
    """

    def write(batches) -> Iterator[pa.RecordBatch]:
        opened: dict = {}
        for batch in batches:
            targets = batch.column(0).to_pylist()
            sizes = []
            for i, name in enumerate(targets):
                data = batch.column(1)[i].as_py()
                sizes.append(storage.write_file(name, [data], opened))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(targets, pa.string()),
                    pa.array([s[0] for s in sizes], pa.int64()),
                    pa.array([s[1] for s in sizes], pa.int64()),
                ],
                ["target", "bytes", "crc32"],
            )

    rows = df.select(target.cast("string").alias("target"), content.cast("binary").alias("content"))
    return rows.mapInArrow(write, "target string, bytes bigint, crc32 bigint")


class _VolumeFiles(io.RawIOBase):
    """A stream that goes to `target.0001`, `target.0002`, …, each of exactly `volume_bytes`
    but the last. Nothing is held: bytes go on as they come."""

    def __init__(self, target: str, volume_bytes: int, opened: dict):
        self.target, self.volume_bytes, self.opened = target, volume_bytes, opened
        self.done: list[tuple[str, int, int]] = []
        self.lost = False
        self.writer = storage.Writer(self._name(1), opened)

    def _name(self, number: int) -> str:
        return f"{self.target}.{number:04d}"

    def writable(self) -> bool:
        return True

    def write(self, data) -> int:
        rest = memoryview(data)
        while rest.nbytes and not self.lost:
            if self.writer.size == self.volume_bytes:
                self._next()
            part = rest[: self.volume_bytes - self.writer.size]
            self.writer.write(bytes(part))
            rest = rest[part.nbytes :]
        return len(data)

    def _finish(self) -> None:
        self.writer.finish()
        self.done.append((self._name(len(self.done) + 1), self.writer.size, self.writer.crc))

    def _next(self) -> None:
        self._finish()
        self.writer = storage.Writer(self._name(len(self.done) + 1), self.opened)

    def abandon(self) -> None:
        """Takes the open volume away; what the archive still writes when it goes is dropped."""
        self.lost = True
        self.writer.abandon()

    def finish(self) -> None:
        self._finish()
        # Volumes of an earlier, longer run would be read as part of this one.
        number = len(self.done) + 1
        while storage.remove(self._name(number), self.opened):
            number += 1


class _Archive:
    """A ZIP file written member by member, and each member chunk by chunk."""

    def __init__(self, target: str, volume_bytes: int, method: int, opened: dict):
        self.target, self.method, self.members = target, method, 0
        self.files = _VolumeFiles(target, volume_bytes, opened)
        self.zip = zipfile.ZipFile(self.files, "w", method)
        self.member = self.stream = None

    def add(self, member: tuple, data: bytes) -> None:
        if member != self.member:
            self._end_member()
            info = zipfile.ZipInfo(member[0])
            info.compress_type = self.method
            self.member, self.stream = member, self.zip.open(info, "w", force_zip64=True)
            self.members += 1
        self.stream.write(data)

    def _end_member(self) -> None:
        if self.stream is not None:
            self.stream.close()
        self.member = self.stream = None

    def finish(self) -> list[dict]:
        self._end_member()
        self.zip.close()
        self.files.finish()
        return [
            {"target": self.target, "volume": i, "path": path, "bytes": size, "crc32": crc, "members": self.members}
            for i, (path, size, crc) in enumerate(self.files.done, 1)
        ]


_WRITTEN = "target string, volume int, path string, bytes bigint, crc32 bigint, members int"
_WRITTEN_ARROW = pa.schema(
    [
        ("target", pa.string()),
        ("volume", pa.int32()),
        ("path", pa.string()),
        ("bytes", pa.int64()),
        ("crc32", pa.int64()),
        ("members", pa.int32()),
    ]
)


def _write_archives(batches, volume_bytes: int, method: int) -> Iterator[pa.RecordBatch]:
    """Archives from rows sorted by target, member and chunk."""
    warnings.filterwarnings("ignore", "Duplicate name")
    opened: dict = {}
    current: _Archive | None = None
    try:
        for batch in batches:
            targets, names, keys = (batch.column(i) for i in range(3))
            for i in range(batch.num_rows):
                target = targets[i].as_py()
                if current is not None and current.target != target:
                    yield pa.RecordBatch.from_pylist(current.finish(), _WRITTEN_ARROW)
                    current = None
                if current is None:
                    current = _Archive(target, volume_bytes, method, opened)
                current.add((names[i].as_py(), keys[i].as_py()), batch.column(3)[i].as_py() or b"")
        if current is not None:
            done, current = current.finish(), None
            yield pa.RecordBatch.from_pylist(done, _WRITTEN_ARROW)
    finally:
        if current is not None:
            current.files.abandon()


def write_volumes(
    df: DataFrame,
    target: Column,
    member: Column,
    data: Column,
    order: list[str],
    chunk: str | None = None,
    method: str = "DEFLATE",
    volume_bytes: int = VOLUME_BYTES,
    partitions: int | None = None,
) -> DataFrame:
    """One ZIP file per target, written straight to volumes `target.0001`, `target.0002`, …
    of exactly `volume_bytes` (the last one less); returns the manifest of the volumes.

    Members stand in `order`, which must tell them apart. A member may come in several rows,
    numbered by the column `chunk`, as archives are read: no row, value or buffer holds a
    whole member or a whole file, so both may be of any size. A ZIP file is one stream, so one
    task writes it; `pack` deals a large archive out over several files instead. Work happens
    when the manifest is written; the same rows again replace the same volumes.
    """
    rows = df.select(
        target.cast("string").alias("target"),
        member.alias("member"),
        F.to_json(F.struct(*order)).alias("place"),
        data.cast("binary").alias("data"),
        *[F.col(c).alias(f"order_{i}") for i, c in enumerate(order)],
        (F.col(chunk) if chunk else F.lit(0)).alias("chunk"),
    )
    count, number = partitions or task_count(df.sparkSession), METHODS[method]
    return (
        rows.repartition(count, "target")
        .sortWithinPartitions("target", *[f"order_{i}" for i in range(len(order))], "chunk")
        .select("target", "member", "place", "data")
        .mapInArrow(lambda batches: _write_archives(batches, volume_bytes, number), _WRITTEN)
    )
