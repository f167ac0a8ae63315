"""Opening files of the shared storage from inside tasks."""

from __future__ import annotations

import errno
import io
import re
import uuid
import zlib
from bisect import bisect_right
from collections.abc import Iterable
from itertools import accumulate
from urllib.parse import urlsplit

from pyarrow import fs as pafs

# Hadoop scheme names that Arrow spells differently.
SCHEMES = {"s3a": "s3", "s3n": "s3", "abfss": "abfs"}


def locate(uri: str, opened: dict) -> tuple[pafs.FileSystem, str]:
    """File system and path for a Spark path; `opened` keeps one per authority."""
    scheme, _, rest = uri.partition(":")
    if not rest or "/" in scheme or scheme == "file":
        path = rest if scheme == "file" else uri
        if "file" not in opened:
            opened["file"] = pafs.LocalFileSystem()
        return opened["file"], "/" + path.lstrip("/")
    authority = urlsplit(uri).netloc
    place = f"{SCHEMES.get(scheme, scheme)}://{authority}"
    if place not in opened:
        opened[place] = pafs.FileSystem.from_uri(place + "/")[0]
    path = uri.split(authority, 1)[1] if authority else "/" + rest.lstrip("/")
    if SCHEMES.get(scheme, scheme) in ("s3", "gs", "abfs"):
        path = authority.split("@")[0] + path
    return opened[place], path


#: Stores where a file is there only once it is closed, all of it at a time: files are written
#: under their own name, and nothing is moved.
WHOLE_ON_CLOSE = ("s3", "gs", "abfs")


def _appears_on_close(uri: str) -> bool:
    scheme, _, rest = uri.partition(":")
    scheme = "file" if not rest or "/" in scheme else scheme
    return SCHEMES.get(scheme, scheme) in WHOLE_ON_CLOSE


class StorageError(Exception):
    """Storage failed, as opposed to the bytes being bad: the task must be tried again."""


class _Source(io.RawIOBase):
    """Raw reader whose failures cannot be taken for damaged data."""

    def __init__(self, file):
        self._file = file

    def readable(self) -> bool:
        return True

    def seekable(self) -> bool:
        return True

    def seek(self, offset: int, whence: int = 0) -> int:
        place = offset + (0, self._file.tell(), self._file.size())[whence]
        if place < 0:
            raise OSError(errno.EINVAL, "seek before the start of the file")
        return self._file.seek(place)

    def tell(self) -> int:
        return self._file.tell()

    def readinto(self, buffer) -> int:
        try:
            return self._file.readinto(buffer)
        except OSError as error:
            raise StorageError(str(error)) from error

    def close(self) -> None:
        if not self.closed:
            self._file.close()
        super().close()


class _Volumes:
    """Several files read as one; holds one of them open."""

    def __init__(self, fs: pafs.FileSystem, paths: list[str]):
        self._fs, self._paths = fs, paths
        self._ends = list(accumulate(info.size for info in fs.get_file_info(paths)))
        self._place, self._index, self._file = 0, None, None

    def size(self) -> int:
        return self._ends[-1]

    def tell(self) -> int:
        return self._place

    def seek(self, place: int) -> int:
        self._place = place
        return place

    def readinto(self, buffer) -> int:
        index = bisect_right(self._ends, self._place)
        if index == len(self._ends):
            return 0
        if index != self._index:
            self.close()
            self._file, self._index = self._fs.open_input_file(self._paths[index]), index
        start = self._ends[index - 1] if index else 0
        self._file.seek(self._place - start)
        count = self._file.readinto(memoryview(buffer)[: self._ends[index] - self._place])
        self._place += count
        return count

    def close(self) -> None:
        if self._file is not None:
            self._file.close()
        self._file = self._index = None


# Paths `name.{0001..0012}` stand for the volumes of one file.
_VOLUME_SET = re.compile(r"(.*)\.\{(\d+)\.\.(\d+)\}", re.DOTALL)


def open_input(uri: str, opened: dict) -> io.BufferedReader:
    """Seekable reader that fetches a megabyte at a time."""
    volumes = _VOLUME_SET.fullmatch(uri)
    fs, path = locate(volumes[1] if volumes else uri, opened)
    try:
        if volumes:
            first, last = volumes[2], volumes[3]
            numbers = range(int(first), int(last) + 1)
            file = _Volumes(fs, [f"{path}.{n:0{len(first)}d}" for n in numbers])
        else:
            file = fs.open_input_file(path)
        return io.BufferedReader(_Source(file), 1 << 20)
    except OSError as error:
        raise StorageError(f"{uri}: {error}") from error


def stat(uri: str, opened: dict) -> tuple[int, int] | None:
    """Size and modification time in microseconds, None when there is no such file."""
    fs, path = locate(uri, opened)
    info = _guarded(fs.get_file_info, path)
    if info.type != pafs.FileType.File:
        return None
    return info.size, (info.mtime_ns or 0) // 1000


def _guarded(action, *args, **kwargs):
    try:
        return action(*args, **kwargs)
    except OSError as error:
        raise StorageError(str(error)) from error


class Writer:
    """A file written piece by piece that takes its name when it is complete.

    A lost task leaves nothing under that name: on stores that show a file when it is closed,
    since it never is, elsewhere since the data goes to a hidden name first.
    """

    def __init__(self, uri: str, opened: dict):
        self._fs, self.path = locate(uri, opened)
        folder, _, name = self.path.rpartition("/")
        self._moves = not _appears_on_close(uri)
        self._hidden = f"{folder}/.{name}.{uuid.uuid4().hex}" if self._moves else self.path
        made = opened.setdefault("folders", set())
        if self._moves and folder not in made:
            _guarded(self._fs.create_dir, folder, recursive=True)
            made.add(folder)
        self.size = self.crc = 0
        self._out = _guarded(self._fs.open_output_stream, self._hidden)

    def write(self, chunk: bytes) -> None:
        _guarded(self._out.write, chunk)
        self.size += len(chunk)
        self.crc = zlib.crc32(chunk, self.crc)

    def finish(self) -> None:
        _guarded(self._out.close)
        if self._moves:
            _guarded(self._fs.move, self._hidden, self.path)

    def abandon(self) -> None:
        """Takes away what was written."""
        if not self._out.closed:
            self._out.close()
        if self._fs.get_file_info(self._hidden).type != pafs.FileType.NotFound:
            self._fs.delete_file(self._hidden)


def names(uri: str, opened: dict) -> list[str]:
    """Names in a folder that readers see; none where there is no folder."""
    fs, path = locate(uri, opened)
    found = _guarded(fs.get_file_info, pafs.FileSelector(path, allow_not_found=True))
    return [f.base_name for f in found if not f.base_name.startswith((".", "_"))]


def remove(uri: str, opened: dict) -> bool:
    """Deletes a file; whether there was one."""
    fs, path = locate(uri, opened)
    if _guarded(fs.get_file_info, path).type != pafs.FileType.File:
        return False
    _guarded(fs.delete_file, path)
    return True


def write_file(uri: str, chunks: Iterable[bytes], opened: dict) -> tuple[int, int]:
    """Writes a whole file or none; returns its size and CRC-32.

    Readers never see a partial file and a repeated task leaves the same one:
    data goes to a hidden name first, then takes the final name.
    """
    writer = Writer(uri, opened)
    try:
        for chunk in chunks:
            writer.write(chunk)
        writer.finish()
    except BaseException:
        writer.abandon()
        raise
    return writer.size, writer.crc
