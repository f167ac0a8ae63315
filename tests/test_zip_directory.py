"""ZIP directories cut into ranges, and members read without a directory."""

import io
import random
import warnings
import zipfile

import pytest
from pyspark.sql import functions as F

from voltrail.sources import archives, zip_directory


def write(path, members, method=zipfile.ZIP_DEFLATED, comment=b""):
    with open(path, "wb") as file, warnings.catch_warnings():
        warnings.simplefilter("ignore")
        with zipfile.ZipFile(file, "w", method) as z:
            z.comment = comment
            for name, data in members:
                info = zipfile.ZipInfo(name)
                info.compress_type = method
                info.comment = b"PK\x01\x02" * (len(name) % 3)  # looks like a record
                z.writestr(info, data)


def members(n, seed=1):
    rng = random.Random(seed)
    names = [f"dir{rng.randrange(5)}/é{rng.randrange(n // 2 + 1)}{'x' * rng.randrange(60)}" for _ in range(n)]
    return [(name, rng.randbytes(rng.randrange(40))) for name in names] + [("dir/", b"")]


def listing(df):
    keep = [c for c in df.columns if c != "header_offset"]
    return sorted(map(repr, df.select(keep).collect()))


@pytest.mark.parametrize("comment", [b"", b"note"])
@pytest.mark.parametrize("size", [zip_directory.RECORD_MOST, 250_000])
def test_ranges_list_what_the_library_lists(spark, tmp_path, size, comment):
    write(tmp_path / "a.zip", members(9000), comment=comment)
    write(tmp_path / "b.zip", members(40, 2), zipfile.ZIP_STORED)
    write(tmp_path / "none.zip", [])
    (tmp_path / "junk.zip").write_bytes(b"junk")
    files = archives.read_archives(spark, str(tmp_path))
    want = archives.inventory(files)
    got = archives.inventory(files, directory_bytes=size)
    assert listing(got) == listing(want)
    assert got.where("header_offset IS NOT NULL").count() == 9001
    read = lambda df: sorted((r["path"], r["position"], bytes(r["data"] or b""), r["read_error"]) for r in archives.read_members(df).collect())
    assert read(got) == read(want)
    assert listing(archives.integrity(got)) == listing(archives.integrity(want))


def test_ranges_of_any_size_count_alike():
    file = io.BytesIO()
    write_to = [(n, d) for n, d in members(60)]
    with zipfile.ZipFile(file, "w") as z, warnings.catch_warnings():
        warnings.simplefilter("ignore")
        for name, data in write_to:
            z.writestr(name, data)
    whole = zip_directory.find(file)
    infos = zipfile.ZipFile(file).infolist()
    for size in (1, 7, 45, 46, 47, 100, 333, 5000):
        counts = [
            zip_directory.count(file, a, min(a + size, whole.end), whole) for a in range(whole.start, whole.end, size)
        ]
        found = [c for c in counts if c.records]
        assert sum(c.records for c in counts) == len(infos)
        assert found[0].first == whole.start and found[-1].after == whole.end
        assert all(a.after == b.first for a, b in zip(found, found[1:]))
        names = [i.filename for c in found for i in zip_directory.entries(file, c.first, c.after)]
        assert names == [i.filename for i in infos]


def test_offsets_behind_other_bytes(tmp_path):
    write(tmp_path / "a.zip", [("n", b"data")])
    file = io.BytesIO(b"#!/bin/sh\n" + (tmp_path / "a.zip").read_bytes())
    found = zip_directory.find(file)
    (info,) = zip_directory.entries(file, found.start, found.end)
    assert found.shift == 10
    sizes = info.compress_type, info.compress_size, info.file_size, info.CRC
    assert zip_directory.open_member(file, info.header_offset + found.shift, *sizes).read() == b"data"


def test_a_directory_damaged_in_one_range_is_told_once(spark, tmp_path):
    write(tmp_path / "a.zip", members(9000))
    data = bytearray((tmp_path / "a.zip").read_bytes())
    with open(tmp_path / "a.zip", "rb") as file:
        place = zip_directory.find(file)
    middle = data.index(b"PK\x01\x02", (place.start + place.end) // 2)
    data[middle : middle + 46] = b"\0" * 46
    (tmp_path / "a.zip").write_bytes(data)
    rows = archives.inventory(archives.read_archives(spark, str(tmp_path)), directory_bytes=200_000).collect()
    assert len(rows) == 1 and "BadZipFile" in rows[0]["error"] and rows[0]["position"] is None


def test_damaged_members_of_ranged_archives(spark, tmp_path):
    write(tmp_path / "a.zip", [(f"m{i}", b"payload%d" % i) for i in range(9000)], zipfile.ZIP_STORED)
    data = (tmp_path / "a.zip").read_bytes().replace(b"payload7007", b"PAYLOAD7007", 1)
    (tmp_path / "a.zip").write_bytes(data)
    listed = archives.inventory(archives.read_archives(spark, str(tmp_path)), directory_bytes=200_000)
    assert [tuple(r)[1:3] for r in archives.integrity(listed).collect()] == [("bad", "m7007")]
    errors = archives.read_members(listed).where("read_error IS NOT NULL").collect()
    assert [r["member"] for r in errors] == ["m7007"]


def test_ranges_have_a_least_size(spark, tmp_path):
    with pytest.raises(ValueError, match="ranges"):
        archives.inventory(spark.range(0).selectExpr("'x' AS path"), directory_bytes=1000)


def test_many_members_are_listed_by_many_tasks(spark, tmp_path):
    """A fifth of a million members, one name very often."""
    n = 200_000
    with zipfile.ZipFile(tmp_path / "big.zip", "w") as z, warnings.catch_warnings():
        warnings.simplefilter("ignore")
        for i in range(n):
            z.writestr(zipfile.ZipInfo("same" if i % 3 == 0 else f"folder/name-{i}"), b"")
    files = archives.read_archives(spark, str(tmp_path))
    listed = archives.inventory(files, directory_bytes=1 << 20)
    ranges = archives._ranged(
        files.select("path", F.col("length").alias("archive_bytes"), F.lit(0).cast("bigint").alias("archive_micros")),
        archives.SLICE_BYTES,
        1 << 20,
    )
    assert "mapInArrow" in ranges._jdf.queryExecution().toString() or "MapInArrow" in ranges._jdf.queryExecution().toString()
    stats = listed.agg(
        F.count("*"), F.max("position"), F.count_distinct("position"), F.max("occurrence"), F.count_distinct("member")
    ).first()
    assert tuple(stats) == (n, n - 1, n, (n - 1) // 3, n - (n - 1) // 3)
