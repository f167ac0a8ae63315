"""ZIP files streamed to numbered volumes."""

import os
import random
import tracemalloc
import zipfile
import zlib

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from voltrail.operators import pack
from voltrail.sources import archives


def rows(spark, n=30, seed=3):
    rng = random.Random(seed)
    made = []
    for i in range(n):
        for chunk in range(rng.randrange(1, 5)):
            made.append((f"a{i % 3}", i, f"m{i // 6}", chunk, bytearray(rng.randbytes(rng.randrange(3000)))))
    return spark.createDataFrame(made, "archive string, id int, member string, chunk int, data binary"), made


@pytest.mark.parametrize("method", ["COPY", "DEFLATE", "BZip2", "LZMA"])
def test_volumes_join_to_the_archive(spark, tmp_path, method):
    df, made = rows(spark)
    target = F.concat(F.lit(f"{tmp_path}/out/"), "archive", F.lit(".zip"))
    written = pack.write_volumes(
        df, target, F.col("member"), F.col("data"), ["id"], "chunk", method=method, volume_bytes=4000
    ).collect()
    for name in ("a0", "a1", "a2"):
        parts = sorted((tmp_path / "out").glob(f"{name}.zip.*"))
        sizes = [p.stat().st_size for p in parts]
        assert len(parts) > 1 and set(sizes[:-1]) == {4000} and 0 < sizes[-1] <= 4000
        assert sorted(r["bytes"] for r in written if r["target"].endswith(f"{name}.zip")) == sorted(sizes)
        whole = tmp_path / f"{name}-{method}.zip"
        whole.write_bytes(b"".join(p.read_bytes() for p in parts))
        want = {}
        for archive, i, member, _, data in made:
            if archive == name:
                want[i] = (member, want.get(i, ("", b""))[1] + bytes(data))
        with zipfile.ZipFile(whole) as z:
            assert [(x.filename, z.read(x)) for x in z.infolist()] == [want[i] for i in sorted(want)]
    found = archives.join_volumes(archives.read_archives(spark, str(tmp_path / "out")))
    assert archives.list_members(found).count() == 30
    assert {r["status"] for r in archives.integrity(archives.inventory(found)).collect()} == {"ok"}


def test_a_shorter_run_leaves_no_old_volumes(spark, tmp_path):
    df, _ = rows(spark)
    target = F.lit(f"{tmp_path}/x.zip")
    for n, part in ((1, df), (2, df.where("id < 4")), (3, df.where("id < 4"))):
        pack.write_volumes(part, target, F.col("member"), F.col("data"), ["id"], "chunk", "COPY", 3000).collect()
    found = archives.join_volumes(archives.read_archives(spark, str(tmp_path)))
    assert archives.list_members(found).count() == 4
    assert not [p for p in os.listdir(tmp_path) if p.startswith(".") and not p.endswith(".crc")]


def test_empty_members_and_no_rows(spark, tmp_path):
    df = spark.createDataFrame([("e", None), ("f", bytearray(b""))], "member string, data binary")
    made = pack.write_volumes(df, F.lit(f"{tmp_path}/e.zip"), F.col("member"), F.col("data"), ["member"])
    assert [(r["volume"], r["members"]) for r in made.collect()] == [(1, 2)]
    assert pack.write_volumes(df.limit(0), F.lit("x"), F.col("member"), F.col("data"), ["member"]).collect() == []


def test_memory_does_not_follow_the_archive(tmp_path):
    """200 MB through one task in 30 MB volumes, in chunks of a megabyte."""
    chunk = os.urandom(1 << 20)

    def batches():
        for i in range(200):
            columns = [[f"{tmp_path}/big.zip"], [f"m{i // 100}"], [str(i // 100)], [chunk]]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["target", "member", "place", "data"])

    tracemalloc.start()
    (done,) = list(pack._write_archives(batches(), 30 << 20, zipfile.ZIP_STORED))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert done.num_rows == 7 and peak < 16 << 20


def test_a_failing_task_leaves_no_volume_open(tmp_path):
    def batches():
        columns = [[f"{tmp_path}/x.zip"], ["m"], ["0"], [b"data" * 1000]]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["target", "member", "place", "data"])
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        list(pack._write_archives(batches(), 1 << 20, zipfile.ZIP_STORED))
    assert os.listdir(tmp_path) == []


@pytest.mark.parametrize("direct", [False, True])
def test_a_file_is_there_whole_or_not_at_all(tmp_path, monkeypatch, direct):
    """With and without a move; a writer that is never closed, and one that fails."""
    from voltrail.sources import storage

    if direct:
        monkeypatch.setattr(storage, "WHOLE_ON_CLOSE", ("file",))
    uri = f"file:{tmp_path}/f.bin"
    assert storage.write_file(uri, [b"one", b"two"], {}) == (6, zlib.crc32(b"onetwo"))
    assert (tmp_path / "f.bin").read_bytes() == b"onetwo" and os.listdir(tmp_path) == ["f.bin"]

    def failing():
        yield b"part"
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        storage.write_file(f"file:{tmp_path}/g.bin", failing(), {})
    assert os.listdir(tmp_path) == ["f.bin"]
    for scheme in ("s3a", "s3", "gs", "abfss", "hdfs"):
        assert storage._appears_on_close(f"{scheme}://bucket/x") == (not direct and scheme != "hdfs")
