from types import SimpleNamespace

import pytest

from voltrail import session


def fake(master, shared=None):
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda name, default=None: shared or default),
        sparkContext=SimpleNamespace(master=master, getCheckpointDir=lambda: None),
    )


def test_work_folders(monkeypatch, spark):
    monkeypatch.setattr(session, "qualify", lambda spark, path: path)
    assert session.new_workdir(fake("yarn", "hdfs:///shared/"), "x").startswith("hdfs:///shared/voltrail/x-")
    assert "voltrail-" in session.new_workdir(fake("local[2]"), "x")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.new_workdir(fake("yarn"), "x")


def test_paths_are_qualified(spark):
    assert session.qualify(spark, "/tmp/x").startswith("file:/")
    first, second = session.new_workdir(spark, "a"), session.new_workdir(spark, "a")
    assert first != second and spark.conf.get("spark.checkpoint.dir") in first


def test_stored_rows_are_computed_once_and_go_away(spark):
    from pyspark.sql import functions as F

    from voltrail.plans import writes

    df = spark.range(100).select("id", F.rand().alias("r"))
    with writes.stored(df, "test") as rows:
        assert rows.collect() == rows.collect() and rows.count() == 100
        path = rows.inputFiles()[0].rsplit("/", 1)[0]
    fs, folder = session._hadoop(spark, path)
    assert not fs.exists(folder)
    with pytest.raises(ValueError, match="no work folder"):
        session.discard(spark, "/tmp/elsewhere")
