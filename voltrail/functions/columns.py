"""Small column expressions shared by the jobs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def primary_key(vin: Column, ts: Column) -> Column:
    """vehicle + '_' + time as text; NULL when either part is NULL."""
    return F.concat(vin, F.lit("_"), ts.cast("string"))


def decode_key(key: Column) -> Column:
    """URL-decode with '+' as blank; a '%' that starts no escape stays as it is."""
    return F.url_decode(F.regexp_replace(key, "%(?![0-9A-Fa-f]{2})", "%25"))


def base_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def is_raw_archive_key(key: Column) -> Column:
    """Keys of archives to unpack; `raw/` may stand anywhere in the key."""
    return key.contains("raw/") & (key.endswith(".zip") | key.endswith(".7z"))


# Leading bytes of the known file types.
MAGIC = (
    ("7z", "377ABCAF271C"),
    ("xz", "FD377A585A00"),
    ("zip", "504B0304"),
    ("zip", "504B0506"),
    ("zstd", "28B52FFD"),
    ("parquet", "50415231"),
    ("bzip2", "425A68"),
    ("gzip", "1F8B"),
)


def file_kind(content: Column) -> Column:
    """File type by leading bytes, `unknown` when none matches."""
    kind = F.lit("unknown")
    for name, magic in reversed(MAGIC):
        size = len(magic) // 2
        kind = F.when(F.hex(F.substring(content, 1, size)) == magic, name).otherwise(kind)
    return F.when(content.isNotNull(), kind)


def _components(text: Column) -> Column:
    return F.filter(F.split(text, "/"), lambda p: (p != "") & (p != "."))


def resolved_member_path(member: Column, target: str) -> Column:
    """Absolute path of a member below `target`, or NULL when it would leave it.

    Leading slashes and one leading './' are removed, '..' steps up.
    """
    root = [p for p in target.split("/") if p]
    base = F.array(*[F.lit(p) for p in root]) if root else F.array().cast("array<string>")
    name = F.regexp_replace(F.regexp_replace(member, "^/+", ""), "^\\./", "")
    start = F.when(name.startswith("/"), F.array().cast("array<string>")).otherwise(base)
    parts = F.aggregate(
        F.concat(start, _components(name)),
        F.array().cast("array<string>"),
        lambda stack, p: F.when(p != "..", F.array_append(stack, p))
        .when(F.size(stack) > 0, F.slice(stack, F.lit(1), F.size(stack) - 1))
        .otherwise(stack),
    )
    inside = F.slice(parts, 1, len(root)) == base if root else F.lit(True)
    return F.when(inside, F.concat(F.lit("/"), F.array_join(parts, "/")))


def member_output_name(member: Column, occurrence: Column) -> Column:
    """First member of a name keeps it, later ones get `_0`, `_1`, …"""
    return F.when(occurrence == 0, member).otherwise(
        F.concat(member, F.lit("_"), (occurrence - 1).cast("string"))
    )
