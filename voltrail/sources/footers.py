"""What landing files hold, told by their footers: rows, contract columns, types.

One Spark job reads all footers. A task turns each file into its shape (the contract columns it
has, as spelled, with their types) and tasks fold equal shapes before the shuffle, so
what reaches the driver grows with the number of different shapes, not of files. Shapes
then fold into groups that Spark's Parquet reader can read with one schema each: of int
and bigint the wider, of float and double too, of date and timestamp_ntz the latter.
Types that do not join (bigint and double) are read as two groups and cleaned
separately; columns outside the contract never matter.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltrail import contract
from voltrail.sources import storage

#: Contract columns by their name without case.
_SPELLED = {f.raw_name.lower(): f.raw_name for f in contract.FIELDS if f.name != contract.KEY}
_WIDER = (
    # From left to right, Spark's reader takes each type as any that follows it.
    ("tinyint", "smallint", "int", "bigint"),
    ("tinyint", "smallint", "int", "double"),
    ("float", "double"),
    ("date", "timestamp_ntz"),
)
#: Files of a batch whose footers are read without tasks.
HANDFUL = 8
_FOUND = "shape array<struct<name: string, type: string>>, error string, rows bigint, files bigint, path string"


class Group(NamedTuple):
    """Files that one schema reads."""

    schema: T.StructType
    rows: int
    files: int
    shapes: tuple


class Unusable(NamedTuple):
    """Files that cannot be loaded, with an example."""

    reason: str
    rows: int
    files: int
    path: str
    shape: tuple


class Survey(NamedTuple):
    groups: list[Group]
    unusable: list[Unusable]
    #: Names of the files of each shape, where few files were surveyed.
    names: dict[tuple, list[str]] | None = None

    @property
    def rows(self) -> int:
        """Rows of the files that can be loaded."""
        return sum(g.rows for g in self.groups)

    @property
    def columns(self) -> set[str]:
        """Contract columns, by the contract's names, that any file has."""
        raw = {name for g in self.groups for name in g.schema.names}
        return {f.name for f in contract.FIELDS if f.raw_name in raw}

    @property
    def extras(self) -> T.StructType:
        """Columns outside the contract, in the types that hold them from all groups."""
        found: dict[str, str] = {}
        for group in self.groups:
            for f in group.schema:
                if f.name.lower() not in _SPELLED:
                    kind = f.dataType.simpleString()
                    joined = _join(found.get(f.name, kind), kind) or _holding(found[f.name], kind)
                    if joined is None:
                        raise contract.ContractError(f"column {f.name} is {found[f.name]} and {kind}")
                    found[f.name] = joined
        return _schema(found)

    def require(self) -> None:
        """Fails where files cannot be loaded, or none has a mandatory column."""
        if self.unusable:
            told = "; ".join(f"{u.reason} in {u.path} and {u.files - 1} more" for u in self.unusable)
            raise contract.ContractError(f"unusable files: {told}")
        absent = [c for c in contract.MANDATORY if c not in self.columns]
        if self.groups and absent:
            raise contract.ContractError(f"mandatory columns missing: {absent}")


def _leaf_type(column) -> str:
    """Spark's name of a footer column's type; other than that, a name Spark has not."""
    logical, physical = column.logical_type.type, column.physical_type
    if logical == "INT":
        size = re.search(r"bitWidth=(\d+)", str(column.logical_type))
        signed = "isSigned=true" in str(column.logical_type)
        widths = ("8", "16", "32", "64")
        names = ("tinyint", "smallint", "int", "bigint") if signed else ("smallint", "int", "bigint", "decimal(20,0)")
        return names[widths.index(size[1])]
    if logical == "TIMESTAMP":
        text = str(column.logical_type)
        if "nanoseconds" in text:
            return "timestamp in nanoseconds"
        return "timestamp" if "isAdjustedToUTC=true" in text else "timestamp_ntz"
    if logical == "DECIMAL":
        return f"decimal({column.precision},{column.scale})"
    if logical in ("DATE", "STRING"):
        return logical.lower()
    plain = {"BOOLEAN": "boolean", "INT32": "int", "INT64": "bigint", "INT96": "timestamp", "FLOAT": "float"}
    plain |= {"DOUBLE": "double", "BYTE_ARRAY": "binary", "FIXED_LEN_BYTE_ARRAY": "binary"}
    return plain[physical] if logical == "NONE" else logical.lower()


def _shape(file: pq.ParquetFile, extras: bool = False) -> list[tuple[str, str]]:
    """Contract columns of one file; a nested one has the type 'nested'. With `extras` other
    plain columns too."""
    found = {}
    for i in range(len(file.schema)):
        column = file.schema.column(i)
        name, _, below = column.path.partition(".")
        kind = "nested" if below else _leaf_type(column)
        if name.lower() in _SPELLED or (extras and _is_extra(name, kind)):
            found[name] = kind
    return sorted(found.items())


def _is_extra(name: str, kind: str) -> bool:
    """Whether a column outside the contract can be loaded."""
    known = (contract.KEY, contract.DAY, contract.LOAD, *contract.SYSTEM_COLUMNS)
    return name.lower() not in known and (kind in _PLAIN or kind.startswith("decimal"))


_PLAIN = {k for chain in _WIDER for k in chain} | {"boolean", "string", "binary", "timestamp"}


@lru_cache(maxsize=1024)
def _spark_type(kind: str) -> T.DataType:
    """The type of a name; asked of Spark once, as batches have the same few."""
    return T._parse_datatype_string(kind)


def _problem(shape: list[tuple[str, str]]) -> str | None:
    """Why files of this shape cannot be loaded."""
    names = [name.lower() for name, _ in shape]
    twice = sorted({n for n in names if names.count(n) > 1})
    if twice:
        return "columns that differ in case only: " + ", ".join(twice)
    for name, kind in shape:
        field = next((f for f in contract.FIELDS if f.raw_name.lower() == name.lower()), None)
        if field is None:
            continue
        try:
            usable = contract.assignable(_spark_type(kind), field.type)
        except Exception:  # a type Spark has no name for
            usable = False
        if not usable:
            return f"{field.name} is {kind}"
    return None


def landing_files(spark: SparkSession, path: str) -> DataFrame:
    """`path` of every file below a folder, read from the listing alone."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    return reader.load(path).select("path")


def _told(path: str, extras: bool, opened: dict) -> tuple[tuple, str | None, int]:
    """Shape, error and rows of one file."""
    try:
        with storage.open_input(path, opened) as source:
            file = pq.ParquetFile(source)
            return tuple(_shape(file, extras)), None, file.metadata.num_rows
    except (pa.ArrowInvalid, pa.ArrowNotImplementedError, EOFError) as bad:
        return (), "no Parquet file: " + str(bad).splitlines()[0][:200], 0


def _at_hand(paths: list[str], extras: bool) -> list[dict]:
    """The rows of `_footers` for a handful of files, read here."""
    opened: dict = {}
    found = []
    for path in paths:
        shape, error, rows = _told(path, extras, opened)
        named = [{"name": n, "type": t} for n, t in shape]
        found.append({"shape": named, "error": error, "rows": rows, "files": 1, "path": path})
    return found


def _footers(files: DataFrame, fold: bool, extras: bool) -> DataFrame:
    """The shapes of these files: one row per file, or (`fold`) per shape and task."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened: dict = {}
        folded: dict[tuple, list] = {}
        for batch in batches:
            for path in batch.column(0).to_pylist():
                shape, error, rows = _told(path, extras, opened)
                key = (shape, error, path if not fold else None)
                known = folded.setdefault(key, [0, 0, path])
                known[0] += rows
                known[1] += 1
        if folded:
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(
                        [[{"name": n, "type": t} for n, t in shape] for shape, _, _ in folded],
                        pa.list_(pa.struct([("name", pa.string()), ("type", pa.string())])),
                    ),
                    pa.array([error for _, error, _ in folded], pa.string()),
                    pa.array([v[0] for v in folded.values()], pa.int64()),
                    pa.array([v[1] for v in folded.values()], pa.int64()),
                    pa.array([v[2] for v in folded.values()], pa.string()),
                ],
                names=["shape", "error", "rows", "files", "path"],
            )

    return files.mapInArrow(read, _FOUND)


def _join(a: str, b: str) -> str | None:
    """The type that reads both, or None."""
    if a == b:
        return a
    for chain in _WIDER:
        if a in chain and b in chain:
            return max(a, b, key=chain.index)
    return None


def _holding(a: str, b: str) -> str | None:
    """The type that holds the values of two groups; other than `_join`, by a cast."""
    numbers = ("tinyint", "smallint", "int", "bigint", "float", "double")
    return "double" if a in numbers and b in numbers else None


def _fold(groups: list[dict], shape: tuple, rows: int, files: int) -> None:
    types = {name.lower(): kind for name, kind in shape}
    for group in groups:
        joined = {n: _join(group["types"].get(n, k), k) for n, k in types.items()}
        if all(joined.values()):
            group["types"] |= joined
            group["shapes"].append(shape)
            group["rows"] += rows
            group["files"] += files
            return
    groups.append({"types": types, "shapes": [shape], "rows": rows, "files": files})


def _schema(types: dict[str, str]) -> T.StructType:
    """The columns by the contract's spelling; others in lower case."""
    return T.StructType([T.StructField(_SPELLED.get(n, n), _spark_type(k)) for n, k in types.items()])


def _merged(rows: list) -> dict[tuple, tuple[int, int, str]]:
    """Rows, files and the least name per shape and error."""
    merged: dict[tuple, tuple[int, int, str]] = {}
    for r in rows:
        key = (tuple((c["name"], c["type"]) for c in r["shape"]), r["error"])
        n_rows, n_files, path = merged.get(key, (0, 0, r["path"]))
        merged[key] = (n_rows + r["rows"], n_files + r["files"], min(path, r["path"]))
    return merged


def survey(files: DataFrame, few: bool = False, extras: bool = False) -> Survey:
    """Groups of files (`path`) that one schema reads each, and those that cannot be loaded.

    With `few`, as for a batch of a stream, which is bounded, the files' names come along and
    nothing is shuffled; of a handful of files no task has to read the footers. With `extras`, plain columns outside the contract count as well.
    """
    names: dict[tuple, list[str]] | None = None
    if few:
        paths = [r["path"] for r in files.collect()]
        rows = _at_hand(paths, extras) if len(paths) <= HANDFUL else _footers(files, False, extras).collect()
        names = {}
        for r in rows:
            names.setdefault(tuple((c["name"], c["type"]) for c in r["shape"]), []).append(r["path"])
    else:
        folded = _footers(files, True, extras).groupBy("shape", "error")
        rows = folded.agg(
            F.sum("rows").alias("rows"), F.sum("files").alias("files"), F.min("path").alias("path")
        ).collect()
    groups: list[dict] = []
    unusable = []
    # The most common shape leads its group, whatever order the rows come in.
    for (shape, error), (n_rows, n_files, path) in sorted(_merged(rows).items(), key=lambda x: (-x[1][1], x[0][0])):
        reason = error or _problem(shape)
        if reason:
            unusable.append(Unusable(reason, n_rows, n_files, path, shape))
        else:
            _fold(groups, shape, n_rows, n_files)
    made = [Group(_schema(g["types"]), g["rows"], g["files"], tuple(g["shapes"])) for g in groups]
    return Survey(made, unusable, names)


def paths_of(files: DataFrame, shapes: list[tuple], extras: bool = False) -> dict[tuple, list[str]]:
    """Names of the files of each of these shapes. Only asked for where files are split into
    groups: Spark's readers are told the files of a group by name."""
    wanted = set(shapes)
    found: dict[tuple, list[str]] = {}
    for r in _footers(files, False, extras).select("shape", "path").toLocalIterator():
        shape = tuple((c["name"], c["type"]) for c in r["shape"])
        if shape in wanted:
            found.setdefault(shape, []).append(r["path"])
    return found


def literal_path(path: str) -> str:
    """A file's name for readers that take patterns."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", path)
