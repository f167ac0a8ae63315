import bz2
import gzip
import io
import lzma
import pathlib
import time
import zipfile
import zlib

import pytest
import zstandard
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from voltrail.functions.columns import (
    base_name,
    decode_key,
    file_kind,
    is_raw_archive_key,
    resolved_member_path,
)
from voltrail.operators.pack import pack, volume_name, write_files
from voltrail.sources import archives, messages, storage


def zip_file(path, members, method=zipfile.ZIP_DEFLATED):
    with zipfile.ZipFile(path, "w", method) as z:
        for name, data in members:
            z.writestr(name, data)
    return path


def read(spark, folder, **kwargs):
    return archives.read_archives(spark, str(folder), **kwargs)


def contents(df):
    out = {}
    for r in df.orderBy("path", "position", "chunk").collect():
        key = (r["path"].rsplit("/", 1)[-1], r["position"], r["member"])
        out[key] = out.get(key, b"") + bytes(r["data"])
    return out


def test_inventory_of_good_and_bad_files(spark, tmp_path):
    zip_file(tmp_path / "good.zip", [("dir/", b""), ("dir/a.txt", b"alpha" * 50), ("empty", b"")])
    zip_file(tmp_path / "none.zip", [])
    (tmp_path / "cut.zip").write_bytes((tmp_path / "good.zip").read_bytes()[:60])
    (tmp_path / "old.7z").write_bytes(bytes.fromhex("377ABCAF271C") + b"rest")
    (tmp_path / "junk.zip").write_bytes(b"no archive at all")
    (tmp_path / "zero.zip").write_bytes(b"")
    listed = archives.inventory(read(spark, tmp_path)).cache()
    rows = {(r["path"].rsplit("/", 1)[-1], r["member"]): r for r in listed.collect()}
    assert rows["good.zip", "dir/"]["is_directory"]
    a = rows["good.zip", "dir/a.txt"]
    assert (a["uncompressed_size"], a["crc32"], a["method"]) == (250, zlib.crc32(b"alpha" * 50), "DEFLATE")
    assert rows["none.zip", None]["error"] is None
    assert "BadZipFile" in rows["cut.zip", None]["error"]
    assert "no reader for 7z" in rows["old.7z", None]["error"]
    assert "not an archive" in rows["junk.zip", None]["error"]
    # Spark's file sources pass over files without bytes.
    assert archives.quarantine_of(listed).count() == 3

    found = archives.members_of(listed)
    assert contents(archives.read_members(found)) == {
        ("good.zip", 1, "dir/a.txt"): b"alpha" * 50,
        ("good.zip", 2, "empty"): b"",
    }
    lines = {r["path"].rsplit("/", 1)[-1]: r for r in archives.summarize(listed).collect()}
    assert (lines["good.zip"]["blocks"], lines["good.zip"]["members"]) == (1, 3)
    assert (lines["none.zip"]["members"], lines["none.zip"]["total_uncompressed"]) == (0, 0)
    state = {r["path"].rsplit("/", 1)[-1]: r["status"] for r in archives.integrity(listed).collect()}
    assert state == {
        "good.zip": "ok", "none.zip": "ok", "cut.zip": "unreadable", "old.7z": "unreadable",
        "junk.zip": "unreadable",
    }


@pytest.mark.parametrize("method", [zipfile.ZIP_STORED, zipfile.ZIP_DEFLATED, zipfile.ZIP_BZIP2, zipfile.ZIP_LZMA])
def test_flipped_byte_is_found(spark, tmp_path, method):
    data = bytes(range(256)) * 40
    zip_file(tmp_path / "a.zip", [("one", data), ("two", data)], method)
    blob = bytearray((tmp_path / "a.zip").read_bytes())
    second = blob.index(b"two") + 40
    blob[second] ^= 0xFF
    (tmp_path / "a.zip").write_bytes(blob)
    listed = archives.inventory(read(spark, tmp_path))
    line = archives.integrity(listed).first()
    assert (line["status"], line["first_bad"], line["members_read"]) == ("bad", "two", 2)
    rows = archives.read_members(archives.members_of(listed)).collect()
    errors = {r["member"]: r["read_error"] for r in rows if r["read_error"]}
    assert list(errors) == ["two"]


def test_large_members_come_in_chunks_and_slices_spread(spark, tmp_path):
    big = bytes(i * 7 % 251 for i in range(300_000))
    members = [(f"m{i}", big[i:]) for i in range(12)]
    zip_file(tmp_path / "big.zip", members, zipfile.ZIP_STORED)
    listed = archives.list_members(read(spark, tmp_path), slice_bytes=1_000_000)
    assert [r[0] for r in listed.select("slice").distinct().orderBy("slice").collect()] == [0, 1, 2, 3]
    rows = archives.read_members(listed, partitions=8, chunk_bytes=100_000)
    assert rows.select(F.spark_partition_id()).distinct().count() > 1
    assert rows.agg(F.max(F.length("data"))).first()[0] <= 100_000
    assert contents(rows) == {("big.zip", i, n): d for i, (n, d) in enumerate(members)}


def test_single_member_containers(spark, tmp_path):
    data = b"speed,soc\n" * 5000
    (tmp_path / "a.csv.gz").write_bytes(gzip.compress(data))
    (tmp_path / "a.csv.bz2").write_bytes(bz2.compress(data))
    (tmp_path / "a.csv.xz").write_bytes(lzma.compress(data))
    (tmp_path / "a.csv.zst").write_bytes(zstandard.compress(data) + zstandard.compress(data))
    (tmp_path / "cut.gz").write_bytes(gzip.compress(data)[:40])
    listed = archives.inventory(read(spark, tmp_path)).cache()
    assert {r["kind"]: r["method"] for r in archives.members_of(listed).collect()} == {
        "gzip": "DEFLATE", "bzip2": "BZip2", "xz": "LZMA2", "zstd": "ZStandard",
    }
    got = contents(archives.read_members(archives.members_of(listed)))
    assert got["a.csv.gz", 0, "a.csv"] == got["a.csv.bz2", 0, "a.csv"] == got["a.csv.xz", 0, "a.csv"] == data
    assert got["a.csv.zst", 0, "a.csv"] == data * 2
    assert [r["path"].rsplit("/", 1)[-1] for r in archives.quarantine_of(listed).collect()] == ["cut.gz"]
    assert {r["status"] for r in archives.integrity(archives.members_of(listed)).collect()} == {"ok"}


def test_selection_opens_only_what_is_asked(spark, tmp_path):
    zip_file(tmp_path / "a.zip", [("x/1", b"1"), ("x/2", b"2"), ("y/1", b"3"), ("xy", b"4")])
    listed = archives.list_members(read(spark, tmp_path))
    pick = lambda **k: {r["member"] for r in archives.select_members(listed, **k).collect()}
    assert pick(names=["y/1", "absent"]) == {"y/1"}
    assert pick(prefixes=["x/"]) == {"x/1", "x/2"}
    assert pick(names=["xy"], prefixes=["x/2"]) == {"x/2", "xy"}
    assert pick() == set()
    assert pick(names=spark.createDataFrame([("xy",), ("xy",)], "member string")) == {"xy"}


@pytest.mark.filterwarnings("ignore:Duplicate name")
def test_repeated_names(spark, tmp_path):
    zip_file(tmp_path / "a.zip", [("n", b"1"), ("o", b"2"), ("n", b"3"), ("n", b"4")])
    listed = archives.with_output_names(archives.list_members(read(spark, tmp_path)))
    assert [r["output_name"] for r in listed.orderBy("position").collect()] == ["n", "o", "n_0", "n_1"]
    assert contents(archives.read_members(listed)) == {
        ("a.zip", 0, "n"): b"1", ("a.zip", 1, "o"): b"2", ("a.zip", 2, "n"): b"3", ("a.zip", 3, "n"): b"4",
    }


def test_last_by_base_name_takes_the_newest_archive(spark, tmp_path):
    zip_file(tmp_path / "b.zip", [("x/f", b"old"), ("only", b"b")])
    time.sleep(1.1)
    zip_file(tmp_path / "a.zip", [("f", b"first"), ("y/f", b"new"), ("y/", b"")])
    winners = archives.last_by_base_name(archives.list_members(read(spark, tmp_path, glob="*.zip")))
    out = winners.withColumn("target", F.concat(F.lit(f"{tmp_path}/out/"), "base_name"))
    manifest = archives.land_members(out).collect()
    assert {r["base_name"]: r["read_error"] for r in manifest} == {"f": None, "only": None}
    assert (tmp_path / "out" / "f").read_bytes() == b"new"
    assert sorted(p.name for p in (tmp_path / "out").iterdir()) == ["f", "only"]


def test_lost_file_fails_the_task_instead_of_quarantining(spark, tmp_path):
    path = zip_file(tmp_path / "a.zip", [("n", b"1")])
    listed = archives.list_members(read(spark, tmp_path))
    listed = spark.createDataFrame(listed.collect(), listed.schema)
    path.unlink()
    with pytest.raises(Exception, match="StorageError"):
        archives.read_members(listed).collect()


def test_failed_write_leaves_nothing(tmp_path):
    def broken():
        yield b"part"
        raise EOFError("damaged")

    with pytest.raises(EOFError):
        storage.write_file(f"file:{tmp_path}/x/y", broken(), {})
    assert list((tmp_path / "x").iterdir()) == []
    assert storage.write_file(f"file://{tmp_path}/x/y", [b"a", b"b"], {}) == (2, zlib.crc32(b"ab"))
    assert storage.write_file(f"{tmp_path}/x/y", [b"c"], {})[0] == 1
    assert (tmp_path / "x" / "y").read_bytes() == b"c"


def test_locate_archives(spark, tmp_path):
    zip_file(tmp_path / "a.zip", [("n", b"1")])
    keys = spark.createDataFrame([("a.zip",), ("a.zip",), ("gone.zip",)], "key string")
    found = archives.locate_archives(keys, f"file:{tmp_path}").cache()
    assert {(r["path"].rsplit("/", 1)[-1], r["length"] is None) for r in found.collect()} == {
        ("a.zip", False), ("gone.zip", True),
    }
    listed = archives.inventory(found)
    assert archives.members_of(listed).count() == 1
    assert archives.quarantine_of(listed).first()["error"] == "no such file"


def test_partition_count(spark):
    rows = lambda n, size: spark.range(n).selectExpr(f"{size}L AS length")
    assert archives.partition_count(rows(0, 1)) == 1
    assert archives.partition_count(rows(10, 64 << 20)) == 20
    assert archives.partition_count(rows(160, 1)) == 10
    assert archives.partition_count(rows(1000, 1 << 31)) == 64_000


def test_file_kind(spark):
    rows = [
        ("504B0304AA", "zip"), ("504B0506", "zip"), ("1F8B08", "gzip"), ("425A6839", "bzip2"),
        ("FD377A585A00", "xz"), ("28B52FFD", "zstd"), ("377ABCAF271C", "7z"), ("50415231", "parquet"),
        ("377ABCAF27", "unknown"), ("", "unknown"), (None, None),
    ]
    df = spark.createDataFrame(rows, "h string, kind string")
    got = df.select("kind", file_kind(F.unhex("h")).alias("got")).collect()
    assert all(r["kind"] == r["got"] for r in got)


def expected_path(member, target):
    """The rule in plain Python: where the member would be written, None if outside."""
    name = member.lstrip("/")
    name = name[2:] if name.startswith("./") else name
    stack = []
    for part in (pathlib.PurePosixPath(target) / name).parts[1:]:
        if part != "..":
            stack.append(part)
        elif stack:
            stack.pop()
    path = "/" + "/".join(stack)
    return path if path == target or path.startswith(target + "/") else None


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(
        st.lists(st.sampled_from(["a", "out", "land", "..", ".", "", "b c"]), max_size=6),
        min_size=40,
        max_size=60,
    )
)
def test_member_paths(spark, data):
    names = ["/".join(parts) for parts in data] + ["/etc/passwd", ".//etc/passwd", ".//land/out/x", "//x"]
    df = spark.createDataFrame([(n,) for n in names], "member string")
    got = df.select("member", resolved_member_path(F.col("member"), "/land/out").alias("p")).collect()
    for r in got:
        assert r["p"] == expected_path(r["member"], "/land/out"), r["member"]


def test_keys(spark):
    from urllib.parse import unquote_plus

    keys = ["raw/a+b.zip", "raw%2Fx%2B1.7z", "100%", "%zz%41", "draw/x.zip", "raw/x.ZIP", "x/raw.zip", "%E4%BD%A0.zip"]
    df = spark.createDataFrame([(k,) for k in keys], "k string")
    df = df.select("k", decode_key(F.col("k")).alias("d"))
    df = df.withColumn("w", is_raw_archive_key(F.col("d"))).withColumn("b", base_name(F.col("d")))
    for r in df.collect():
        d = unquote_plus(r["k"])
        assert r["d"] == d and r["b"] == d.split("/")[-1]
        assert r["w"] == ("raw/" in d and d.endswith((".zip", ".7z")))


def test_messages(spark):
    bodies = [
        '{"Records":[{"s3":{"object":{"key":"raw/a.zip"}}},{"s3":5},{"s3":{"object":{}}},{"s3":{"object":{"key":"b"}}}]}',
        '{"Records":[]}', '{"Records":7}', '{"x":1}', "[1]", None, "{broken", "",
    ]
    df = spark.createDataFrame(list(enumerate(bodies)), "id int, body string")
    keys = {(r["id"], r["record"], r["key"]) for r in messages.object_keys(df).collect()}
    assert keys == {(0, 0, "raw/a.zip"), (0, 3, "b")}
    assert {r["id"] for r in messages.rejected_messages(df).collect()} == {6, 7}
    assert [r["key"] for r in messages.wanted_archives(messages.object_keys(df)).collect()] == ["raw/a.zip"]


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(st.tuples(st.sampled_from("ab"), st.binary(max_size=400)), min_size=1, max_size=40),
    st.sampled_from(["COPY", "DEFLATE", "BZip2", "LZMA"]),
)
def test_pack_list_read_is_identity(spark, tmp_path_factory, data, method):
    folder = tmp_path_factory.mktemp("packed")
    rows = [(a, i, d) for i, (a, d) in enumerate(data)]
    df = spark.createDataFrame(rows, "a string, i int, d binary")
    packed = pack(df, F.col("a"), F.concat("a", F.lit("/"), "i"), F.col("d"), ["i"], method=method,
                  volume_bytes=1000, shard_bytes=1500)
    write_files(packed, F.concat(F.lit(f"{folder}/"), volume_name()), F.col("content")).count()
    listed = archives.list_members(read(spark, folder))
    got = contents(archives.read_members(listed))
    assert sorted((name, blob) for (_, _, name), blob in got.items()) == sorted((f"{a}/{i}", d) for a, i, d in rows)
    for path in folder.iterdir():
        with zipfile.ZipFile(path) as z:
            sizes = [m.file_size for m in z.infolist()]
            assert sum(sizes) <= 1000 and z.testzip() is None


def test_hot_archive_is_split_and_repeatable(spark):
    df = spark.range(3000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('c', id % 200) END AS a", "id", "repeat('x', 100) AS d"
    )
    args = (F.col("a"), F.col("id").cast("string"), F.col("d"), ["id"])
    packed = pack(df, *args, volume_bytes=20_000, shard_bytes=25_000, partitions=8)
    shards = {r["archive"]: r["n"] for r in packed.groupBy("archive").agg(F.countDistinct("shard").alias("n")).collect()}
    assert shards["hot"] == 4 and max(n for a, n in shards.items() if a != "hot") == 1
    assert packed.agg(F.sum("members")).first()[0] == 3000
    again = pack(df.repartition(3), *args, volume_bytes=20_000, shard_bytes=25_000, partitions=5)
    digest = lambda p: sorted(map(tuple, p.select("archive", "shard", "volume", F.md5("content")).collect()))
    assert digest(packed) == digest(again)


def test_many_large_archives_use_an_ordinary_join(spark, monkeypatch):
    from voltrail.operators import pack as module

    monkeypatch.setattr(module, "_LISTED_ARCHIVES", 2)
    df = spark.range(100).selectExpr("concat('a', id % 5) AS a", "id", "repeat('x', 100) AS d")
    packed = pack(df, F.col("a"), F.col("id").cast("string"), F.col("d"), ["id"], shard_bytes=500)
    assert "BroadcastHint" not in packed._jdf.queryExecution().analyzed().toString()
    assert packed.agg(F.sum("members"), F.countDistinct("archive", "shard")).first()[0] == 100


def test_zip_with_prefix_and_unknown_method(spark, tmp_path):
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as z:
        z.writestr("a", b"data")
    blob = buffer.getvalue().replace(b"\x00\x00\x00\x00\x21\x00", b"\x00\x00\x09\x00\x21\x00")
    (tmp_path / "odd.zip").write_bytes(blob)
    listed = archives.inventory(read(spark, tmp_path))
    assert archives.integrity(listed).count() == 1


def test_unmeasured_containers_are_still_verified(spark, tmp_path):
    data = b"speed,soc\n" * 5000
    (tmp_path / "a.gz").write_bytes(gzip.compress(data))
    (tmp_path / "cut.gz").write_bytes(gzip.compress(data)[:40])
    listed = archives.inventory(read(spark, tmp_path), measure=False)
    assert [r["uncompressed_size"] for r in listed.collect()] == [None, None]
    state = {r["path"].rsplit("/", 1)[-1]: r["status"] for r in archives.integrity(listed).collect()}
    assert state == {"a.gz": "ok", "cut.gz": "bad"}


def test_fixed_shards_need_no_size_lookup(spark):
    df = spark.range(100).selectExpr("'one' AS a", "id", "'x' AS d")
    packed = pack(df, F.col("a"), F.col("id").cast("string"), F.col("d"), ["id"], shards=4)
    assert packed.agg(F.sum("members"), F.countDistinct("shard")).first() == (100, 4)


@pytest.mark.parametrize(
    "uri, place, path",
    [
        ("s3a://bucket/raw/a b.zip", "s3://bucket/", "bucket/raw/a b.zip"),
        ("gs://bucket/x", "gs://bucket/", "bucket/x"),
        ("hdfs://nn:8020/raw/a.zip", "hdfs://nn:8020/", "/raw/a.zip"),
        ("abfss://box@acc.dfs.core.windows.net/x/y", "abfs://box@acc.dfs.core.windows.net/", "box/x/y"),
    ],
)
def test_paths_of_shared_storage(monkeypatch, uri, place, path):
    asked = []

    class Fake:
        @staticmethod
        def from_uri(name):
            asked.append(name)
            return "fs", ""

    monkeypatch.setattr(storage.pafs, "FileSystem", Fake)
    opened = {}
    assert [storage.locate(uri, opened) for _ in range(2)] == [("fs", path)] * 2
    assert asked == [place]


def test_one_base_name_in_a_third_of_all_members(spark):
    """The last member per name is found map-side first; one row per task is shuffled."""
    listed = spark.range(0, 30_000, 1, 8).selectExpr(
        "concat('file:/raw/', lpad(id div 100, 6, '0'), '.zip') AS path", "timestamp'2024-01-01' AS archive_modified",
        "cast(id % 100 AS int) AS position", "false AS is_directory",
        "CASE WHEN id % 3 = 0 THEN 'x/data.csv' ELSE concat('x/', id) END AS member",
    )
    winners = archives.last_by_base_name(listed)
    assert "partial_max" in winners._jdf.queryExecution().executedPlan().toString()
    hot = winners.where("base_name = 'data.csv'").first()
    assert (hot["path"], hot["position"]) == ("file:/raw/000299.zip", 97)
    assert winners.count() == 20_001


def test_volumes(spark, tmp_path):
    from voltrail.operators.pack import split_volumes

    data = [(f"m{i}", bytes(i * j % 256 for j in range(900))) for i in range(20)]
    whole = zip_file(tmp_path / "whole.zip", data).read_bytes()
    names = ["a.zip", "gap.zip"]
    files = spark.createDataFrame([(f"{tmp_path}/v/{n}", whole) for n in names], "target string, content binary")
    write_files(split_volumes(files, 1000), F.col("target"), F.col("content")).count()
    sizes = [p.stat().st_size for p in sorted((tmp_path / "v").glob("a.zip.*"))]
    assert set(sizes[:-1]) == {1000} and sum(sizes) == len(whole)
    (tmp_path / "v" / "gap.zip.0003").rename(tmp_path / "taken-away")
    (tmp_path / "v" / "single.zip").write_bytes(whole)
    found = archives.join_volumes(read(spark, tmp_path / "v")).cache()
    lengths = {r["path"].rsplit("/", 1)[-1]: r["length"] for r in found.collect()}
    last = f"{len(sizes):04d}"
    assert lengths == {
        f"a.zip.{{0001..{last}}}": len(whole), f"gap.zip.{{0001..{last}}}": None, "single.zip": len(whole),
    }
    listed = archives.inventory(found, slice_bytes=2000)
    assert [r["error"] for r in archives.quarantine_of(listed).collect()] == ["no such file"]
    got = contents(archives.read_members(archives.members_of(listed)))
    assert len(got) == 40 and {(m, d) for (_, _, m), d in got.items()} == set(data)
    assert {r["status"] for r in archives.integrity(archives.members_of(listed)).collect()} == {"ok"}


def test_empty_file_is_one_volume(spark):
    from voltrail.operators.pack import split_volumes

    files = spark.createDataFrame([("x", b""), ("y", b"ab"), ("z", b"abc")], "target string, content binary")
    got = {r["target"]: bytes(r["content"]) for r in split_volumes(files, 2).collect()}
    assert got == {"x.0001": b"", "y.0001": b"ab", "z.0001": b"ab", "z.0002": b"c"}


def test_members_are_whole_where_asked(spark, tmp_path):
    zip_file(tmp_path / "a.zip", [("é.txt", "é".encode() * 1000), ("b", b"")])
    members = archives.list_members(read(spark, tmp_path))
    assert archives.read_members(members, chunk_bytes=7).count() > 200
    whole = {r["member"]: r["data"].decode() for r in archives.read_whole(members).collect()}
    assert whole == {"é.txt": "é" * 1000, "b": ""}


def test_a_name_that_looks_like_a_volume(spark, tmp_path):
    for name in ("drive.2024", "set.0002", "set.0003"):
        zip_file(tmp_path / name, [("n", b"1")])
    found = archives.join_volumes(read(spark, tmp_path))
    assert archives.list_members(found).count() == 3


def test_many_keys_are_looked_up_by_many_tasks(spark):
    keys = spark.range(20_000).selectExpr("concat(id, '.zip') AS key")
    found = archives.locate_archives(keys, "file:/nowhere").withColumn("task", F.spark_partition_id())
    assert found.select("task").distinct().count() > 1
