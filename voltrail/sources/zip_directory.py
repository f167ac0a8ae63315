"""ZIP directories read in byte ranges, and members read without a directory.

A ZIP directory is a run of records of differing lengths, so a task that is given bytes in
its middle must find where a record begins: the first place from which records follow each
other up to the range's end. Neighbours check each other: where one range's records
end, the next one's must begin.
"""

from __future__ import annotations

import io
import struct
import zipfile
from typing import NamedTuple

# Signatures and layouts of the ZIP format.
RECORD, LOCAL, END, END64, LOCATOR64 = b"PK\x01\x02", b"PK\x03\x04", b"PK\x05\x06", b"PK\x06\x06", b"PK\x06\x07"
_END, _END64, _LOCATOR64, _LOCAL = "<4s4H2LH", "<4sQ2H2L4Q", "<4sLQL", "<4s5H3L2H"
_RECORD_BYTES = 46
#: The longest record: three texts of two-byte lengths behind the fixed part.
RECORD_MOST = _RECORD_BYTES + 3 * 0xFFFF


class Directory(NamedTuple):
    start: int
    end: int
    #: Bytes in front of the archive; offsets in records are without them.
    shift: int


class Count(NamedTuple):
    """The records that begin in a range: the first one's place, the place behind the
    last, how many, and bytes of their members."""

    first: int
    after: int
    records: int
    packed: int


def find(source) -> Directory:
    """Where the directory is, from the end of the file."""
    size = source.seek(0, 2)
    tail_start = max(0, size - struct.calcsize(_END) - 0xFFFF)
    source.seek(tail_start)
    tail = source.read()
    at = tail.rfind(END)
    if at < 0 or len(tail) - at < struct.calcsize(_END):
        raise zipfile.BadZipFile("File is not a zip file")
    _, _, _, _, _, length, offset, _ = struct.unpack_from(_END, tail, at)
    end = tail_start + at
    if end >= struct.calcsize(_LOCATOR64):
        source.seek(end - struct.calcsize(_LOCATOR64))
        signature, _, place, _ = struct.unpack(_LOCATOR64, source.read(struct.calcsize(_LOCATOR64)))
        if signature == LOCATOR64:
            # With bytes in front of the archive the stated place is off by them; the record
            # stands right before its locator.
            end -= struct.calcsize(_LOCATOR64) + struct.calcsize(_END64)
            source.seek(end)
            fields = struct.unpack(_END64, source.read(struct.calcsize(_END64)))
            if fields[0] != END64:
                raise zipfile.BadZipFile("Corrupt zip64 end of central directory record")
            length, offset = fields[-2], fields[-1]
    start = end - length
    if start < 0:
        raise zipfile.BadZipFile("Bad offset for central directory")
    return Directory(start, end, start - offset)


def _follow(data: bytes, at: int, whole: bool) -> list[int] | None:
    """Places of the records from `at` on, the one behind the last included; None if they
    do not follow each other to the end of what was read. At the directory's end (`whole`)
    they must end exactly there."""
    places = [at]
    while at < len(data):
        if data[at : at + 4] != RECORD[: len(data) - at]:
            return None
        if len(data) - at < _RECORD_BYTES:
            break
        at += _RECORD_BYTES + sum(struct.unpack_from("<3H", data, at + 28))
        places.append(at)
    return places if not whole or at == len(data) else None


def _read(source, start: int, end: int, last: int) -> bytes:
    source.seek(start)
    return source.read(min(end + RECORD_MOST + 4, last) - start)


def count(source, start: int, end: int, directory: Directory, border: int | None = None) -> Count:
    """Counts the records that begin in a range; raises where none follow each other.

    `border` is the place of the first one where it is known: at the directory's start,
    and where the last range tells.
    """
    if start == directory.start:
        border = start
    data = _read(source, start, end, directory.end)
    stop = end - start
    at = data.find(RECORD) if border is None else border - start
    whole = start + len(data) == directory.end
    while 0 <= at < stop:
        places = _follow(data, at, whole)
        if places:
            own = [p for p in places if p < stop]
            packed = sum(struct.unpack_from("<L", data, p + 20)[0] for p in own)
            after = places[len(own)] if len(own) < len(places) else places[-1]
            return Count(start + places[0], start + after, len(own), packed)
        if border is not None:
            break
        at = data.find(RECORD, at + 1)
    if at < 0 or at >= stop:
        # One record covers the whole range.
        after = start + at if at >= 0 else directory.end
        return Count(after, after, 0, 0)
    raise zipfile.BadZipFile("Bad magic number for central directory")


def entries(source, first: int, after: int) -> list[zipfile.ZipInfo]:
    """The records between two places, parsed by the standard library: as a directory of
    their own, with an end record made for them."""
    source.seek(first)
    data = source.read(after - first)
    end = struct.pack(_END, END, 0, 0, 0, 0, len(data), 0, 0)
    with zipfile.ZipFile(io.BytesIO(data + end)) as part:
        return part.infolist()


def open_member(source, place: int, method: int, packed: int, size: int, crc: int) -> io.BufferedIOBase:
    """A member read from its local header on; the directory is not needed."""
    source.seek(place)
    header = source.read(struct.calcsize(_LOCAL))
    if len(header) < struct.calcsize(_LOCAL) or header[:4] != LOCAL:
        raise zipfile.BadZipFile("Bad magic number for file header")
    flags, name, extra = struct.unpack_from("<H", header, 6)[0], *struct.unpack_from("<2H", header, 26)
    if flags & 1:
        raise RuntimeError("member is encrypted, password required for extraction")
    info = zipfile.ZipInfo("member")
    info.compress_type, info.compress_size, info.file_size, info.CRC = method, packed, size, crc
    info.flag_bits = flags
    source.seek(place + struct.calcsize(_LOCAL) + name + extra)
    return zipfile.ZipExtFile(source, "r", info)
