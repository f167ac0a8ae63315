import datetime as dt
import glob
import json
import shutil
import zipfile

from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltrail import contract
from voltrail.operators import summaries
from voltrail.operators.clean import clean
from voltrail.plans import catalog, writes
from voltrail.sources import telemetry
from voltrail.streaming.ingest import ingest_stream
from voltrail.streaming.unpack import quarantine, unpack_to_files, unpack_to_rows, unpacked_rows

NTZ = T.TimestampNTZType()


def raw(spark, first, last):
    return spark.range(first, last).selectExpr(
        "concat('V', id % 5) AS vin_id",
        "cast(id % 3 AS int) AS Clean_Mode",
        "cast(id % 90 AS float) AS DISPLAY_SPEED",
        "timestamp_ntz'2024-03-01 00:00:00' + make_dt_interval(0, 0, 0, id * 600) AS ts",
    )


def snapshot(df):
    return sorted(map(repr, df.collect()))


def test_files_in_lots_with_restarts_equal_one_batch(spark, namespace, tmp_path):
    landing, checkpoint = str(tmp_path / "landing"), str(tmp_path / "checkpoint")
    name = f"{namespace}.canbus01"
    run = lambda: ingest_stream(
        spark, landing, name, checkpoint, ts_type=NTZ, max_files_per_trigger=2
    ).awaitTermination()
    for first in (0, 300, 600):
        raw(spark, first, first + 300).repartition(3).write.mode("append").parquet(landing)
        run()
    run()
    want = clean(raw(spark, 0, 900))
    assert snapshot(telemetry.scan(spark, name)) == snapshot(want)
    assert snapshot(summaries.daily_summary(telemetry.scan(spark, name))) == snapshot(summaries.daily_summary(want))


def test_replayed_batch_does_not_double(spark, namespace, tmp_path):
    """A batch whose commit was lost runs again and replaces its own rows."""
    landing, checkpoint = str(tmp_path / "landing"), str(tmp_path / "checkpoint")
    name = f"{namespace}.canbus01"
    raw(spark, 0, 300).repartition(4).write.parquet(landing)
    run = lambda: ingest_stream(
        spark, landing, name, checkpoint, ts_type=NTZ, max_files_per_trigger=2
    ).awaitTermination()
    run()
    before = snapshot(spark.table(name))
    commits = sorted(glob.glob(checkpoint + "/commits/[0-9]*"), key=lambda p: int(p.rsplit("/", 1)[1]))
    shutil.move(commits[-1], tmp_path / "lost-commit")
    for crc in glob.glob(checkpoint + "/commits/.*.crc"):
        shutil.move(crc, tmp_path / ("lost" + crc.rsplit("/", 1)[1]))
    run()
    assert snapshot(catalog.fresh_table(spark, name)) == before and len(before) == 300


def test_stream_and_batch_loads_share_a_table(spark, namespace, tmp_path):
    landing = str(tmp_path / "landing")
    name = f"{namespace}.canbus01"
    catalog.ensure_telemetry_table(spark, name, NTZ)
    writes.load_telemetry(clean(raw(spark, 0, 10)), name, "batch")
    raw(spark, 10, 30).write.parquet(landing)
    ingest_stream(spark, landing, name, str(tmp_path / "c"), ts_type=NTZ).awaitTermination()
    loads = {r[0]: r[1] for r in spark.table(name).groupBy(contract.LOAD).count().collect()}
    assert sorted(loads.values()) == [10, 20] and loads["batch"] == 10


def test_streams_of_one_name_do_not_replace_each_other(spark, namespace, tmp_path):
    name = f"{namespace}.canbus01"
    for i in range(2):
        landing = str(tmp_path / f"landing{i}")
        raw(spark, i * 10, i * 10 + 10).write.parquet(landing)
        ingest_stream(spark, landing, name, str(tmp_path / f"c{i}"), ts_type=NTZ).awaitTermination()
        source = tmp_path / f"raw{i}"
        archive(source / "a.zip", [("n", b"%d" % i)])
        unpack_to_rows(spark, str(source), str(tmp_path / "rows"), str(tmp_path / f"u{i}")).awaitTermination()
    assert snapshot(telemetry.scan(spark, name)) == snapshot(clean(raw(spark, 0, 20)))
    assert {bytes(r["data"]) for r in unpacked_rows(spark, str(tmp_path / "rows")).collect()} == {b"0", b"1"}


def test_replayed_unpacking_does_not_double(spark, tmp_path):
    source, output, checkpoint = tmp_path / "raw", str(tmp_path / "rows"), tmp_path / "c"
    archive(source / "a.zip", [("n", b"1"), ("o", b"2")])
    run = lambda: unpack_to_rows(spark, str(source), output, str(checkpoint)).awaitTermination()
    run()
    for file in (checkpoint / "commits").iterdir():
        shutil.move(file, tmp_path / f"lost-{file.name}")
    run()
    assert unpacked_rows(spark, output).count() == 2


def archive(path, members):
    path.parent.mkdir(parents=True, exist_ok=True)
    with zipfile.ZipFile(path, "w") as z:
        for name, data in members:
            z.writestr(name, data)


def test_unpack_to_files(spark, tmp_path):
    source, target, manifest = tmp_path / "raw", tmp_path / "processed", str(tmp_path / "manifest")
    archive(source / "a.zip", [("d/", b""), ("d/x.txt", b"1"), ("../evil", b"no"), ("/abs", b"2")])
    archive(source / "sub/a.zip", [("d/x.txt", b"other")])
    run = lambda: unpack_to_files(
        spark, str(source), str(target), manifest, str(tmp_path / "c"), glob="*.zip"
    ).awaitTermination()
    run()
    (source / "b.zip").write_bytes(b"junk")
    (source / "note.txt").write_bytes(b"not looked at")
    run()
    run()
    files = {str(p.relative_to(target)): p.read_bytes() for p in target.rglob("*") if p.is_file()}
    files = {k: v for k, v in files.items() if not k.endswith(".crc")}
    assert files == {"a.zip/d/x.txt": b"1", "a.zip/abs": b"2", "sub/a.zip/d/x.txt": b"other"}
    rows = spark.read.parquet(manifest).collect()
    status = sorted((r["path"].rsplit("raw/", 1)[1], r["member"], r["status"]) for r in rows if r["member"])
    assert status == [
        ("a.zip", "../evil", "rejected"), ("a.zip", "/abs", "landed"), ("a.zip", "d/", "directory"),
        ("a.zip", "d/x.txt", "landed"), ("sub/a.zip", "d/x.txt", "landed"),
    ]
    assert [r["path"].rsplit("/", 1)[1] for r in quarantine(spark, manifest).collect()] == ["b.zip"]


def test_unpack_flat_lets_the_later_batch_win(spark, tmp_path):
    source, target, manifest = tmp_path / "raw", tmp_path / "processed", str(tmp_path / "manifest")
    run = lambda: unpack_to_files(
        spark, str(source), str(target), manifest, str(tmp_path / "c"), flat=True
    ).awaitTermination()
    archive(source / "b.zip", [("x/f", b"first"), ("g", b"g")])
    run()
    archive(source / "a.zip", [("y/f", b"second")])
    (source / "bad.zip").write_bytes(b"junk")
    run()
    assert {p.name: p.read_bytes() for p in target.iterdir()} == {"f": b"second", "g": b"g"}
    assert quarantine(spark, manifest).count() == 1


def test_unpack_to_rows_keeps_errors_apart(spark, tmp_path):
    source, output = tmp_path / "raw", str(tmp_path / "members")
    archive(source / "a.zip", [("one", b"intact"), ("two", b"payload")])
    blob = (source / "a.zip").read_bytes().replace(b"payload", b"PAYLOAD")
    (source / "a.zip").write_bytes(blob)
    archive(source / "none.zip", [])
    (source / "cut.zip").write_bytes(blob[:50])
    unpack_to_rows(spark, str(source), output, str(tmp_path / "c")).awaitTermination()
    assert [(r["member"], bytes(r["data"])) for r in unpacked_rows(spark, output).collect()] == [("one", b"intact")]
    assert {r["member"] for r in quarantine(spark, output).collect()} == {"two", None}


def test_landed_parquet_feeds_the_ingest_stream(spark, namespace, tmp_path):
    parts, source, target = tmp_path / "parts", tmp_path / "raw", tmp_path / "processed"
    raw(spark, 0, 200).repartition(3).write.parquet(str(parts))
    for i, file in enumerate(sorted(parts.glob("*.parquet"))):
        archive(source / f"drive-{i}.zip", [(f"log/{file.name}", file.read_bytes()), ("readme.txt", b"hello")])
    unpack_to_files(
        spark, str(source), str(target), str(tmp_path / "m"), str(tmp_path / "c1")
    ).awaitTermination()
    name = f"{namespace}.canbus01"
    ingest_stream(spark, str(target), name, str(tmp_path / "c2"), ts_type=NTZ).awaitTermination()
    assert snapshot(telemetry.scan(spark, name)) == snapshot(clean(raw(spark, 0, 200)))
    end = dt.datetime(2024, 3, 2)
    assert telemetry.scan(spark, name, end=end).agg(F.max("ts")).first()[0] < end


def test_odd_file_and_member_names(spark, tmp_path):
    source, target = tmp_path / "raw", tmp_path / "processed"
    archive(source / "ä b%20c+d#1.zip", [("ü x%41/y z.txt", b"odd"), ("a:b", b"colon"), ("q?*", b"glob")])
    unpack_to_files(
        spark, str(source), str(target), str(tmp_path / "m"), str(tmp_path / "c")
    ).awaitTermination()
    files = {str(p.relative_to(target)): p.read_bytes() for p in target.rglob("*") if p.is_file()}
    assert files == {
        "ä b%20c+d#1.zip/ü x%41/y z.txt": b"odd",
        "ä b%20c+d#1.zip/a:b": b"colon",
        "ä b%20c+d#1.zip/q?*": b"glob",
    }


def test_stream_of_wider_types_is_narrowed(spark, namespace, tmp_path):
    landing = str(tmp_path / "landing")
    wide = raw(spark, 0, 20).withColumn("Clean_Mode", F.col("Clean_Mode").cast("bigint"))
    wide = wide.withColumn("DISPLAY_SPEED", F.col("DISPLAY_SPEED").cast("double"))
    wide.write.parquet(landing)
    name = f"{namespace}.canbus01"
    ingest_stream(
        spark, landing, name, str(tmp_path / "c"), ts_type=NTZ, schema=telemetry.file_schema(spark, landing)
    ).awaitTermination()
    assert snapshot(telemetry.scan(spark, name)) == snapshot(clean(raw(spark, 0, 20)))


def test_odd_targets_do_not_stop_the_stream(spark, tmp_path):
    """Equal targets, a file that is a folder too, and names that are too long."""
    from test_archives import zip_file

    from voltrail.streaming.unpack import unpack_to_files

    source, target = tmp_path / "raw", tmp_path / "processed"
    source.mkdir()
    names = ["a.txt", "a.txt", "a.txt_0", "b/./c", "b/c", "d", "d/e", "x" * 240]
    zip_file(source / "odd.zip", [(n, str(i).encode()) for i, n in enumerate(names)])
    for _ in range(2):
        unpack_to_files(
            spark, str(source), str(target), str(tmp_path / "m"), str(tmp_path / "c"), glob="*.zip"
        ).awaitTermination()
    rows = {r["position"]: r["status"] for r in spark.read.parquet(str(tmp_path / "m")).collect()}
    assert rows == {
        0: "landed", 1: "replaced", 2: "landed", 3: "replaced", 4: "landed", 5: "rejected", 6: "landed", 7: "rejected",
    }
    files = {str(p.relative_to(target / "odd.zip")): p.read_bytes() for p in target.rglob("*") if p.is_file()}
    assert files == {"a.txt": b"0", "a.txt_0": b"2", "b/c": b"4", "d/e": b"6"}


def sent(folder, name, *bodies):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("".join(json.dumps({"body": b}) + "\n" for b in bodies))


def told(*keys, **more):
    records = [{"s3": {"object": {"key": k, **more}}} for k in keys]
    return json.dumps({"Records": records})


def test_a_message_in_two_batches_lands_once(spark, tmp_path):
    from voltrail.streaming.unpack import message_stream, unpack_notified_stream

    for name in "abc":
        archive(tmp_path / "raw" / f"{name} 1.zip", [("n", name.encode())])
    inbox, manifest = tmp_path / "inbox", tmp_path / "m"

    def run():
        unpack_notified_stream(
            message_stream(spark, str(inbox), 1), str(tmp_path), str(tmp_path / "out"), str(manifest), str(tmp_path / "c")
        ).awaitTermination()

    sent(inbox, "1.json", told("raw/a+1.zip"), told("raw/a+1.zip", "other/x.zip"), "no json", '{"Event":"test"}')
    run()
    sent(inbox, "2.json", told("raw/a+1.zip"), told("raw/b%201.zip"), "no json")
    sent(inbox, "3.json", told("raw/b+1.zip", "raw/gone.zip"), None)
    run()  # after a restart
    archive(tmp_path / "raw" / "a 1.zip", [("n", b"again")])
    sent(inbox, "4.json", told("raw/a+1.zip", sequencer="2"), told("raw/c+1.zip"), told("raw/gone.zip"))
    run()
    run()
    rows = spark.read.parquet(str(manifest / "members"))
    landed = sorted((r["path"].rsplit("/", 1)[1], r["status"]) for r in rows.collect())
    assert landed == [
        ("a 1.zip", "landed"), ("a 1.zip", "landed"), ("b 1.zip", "landed"), ("c 1.zip", "landed"), ("gone.zip", "unreadable"),
    ]
    assert (tmp_path / "out/raw/a 1.zip/n").read_bytes() == b"again"
    assert [r["body"] for r in spark.read.parquet(str(manifest / "rejected")).collect()] == ["no json"]


def test_a_replayed_batch_of_messages_lands_the_same(spark, tmp_path):
    from voltrail.streaming.unpack import message_stream, unpack_notified_stream

    archive(tmp_path / "raw" / "a.zip", [("n", b"1")])
    checkpoint = tmp_path / "c"

    def run():
        unpack_notified_stream(
            message_stream(spark, str(tmp_path / "inbox")), str(tmp_path), str(tmp_path / "out"), str(tmp_path / "m"), str(checkpoint)
        ).awaitTermination()

    sent(tmp_path / "inbox", "1.json", told("raw/a.zip"), told("raw/a.zip"))
    run()
    for file in checkpoint.glob("commits/*0*"):
        shutil.move(file, tmp_path / f"lost-{file.name}")
    run()
    assert [r["status"] for r in spark.read.parquet(str(tmp_path / "m/members")).collect()] == ["landed"]


def test_members_without_target_are_not_gathered(spark):
    """Half of the members have no target: no task gets them all."""
    from voltrail.streaming.unpack import settled_targets

    target = "if(id % 2 = 0, concat('file:/out/', id % 1000), null) AS target"
    members = spark.range(40_000).selectExpr("'p' AS path", "cast(id AS int) AS position", target)
    conf = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        settled = settled_targets(members)
        sizes = [r["count"] for r in settled.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sum(sizes) == 40_000 and max(sizes) < 6_000
    assert settled.where("target IS NOT NULL").count() == 500


def test_a_small_batch_takes_few_jobs(spark, namespace, tmp_path):
    """Names, load and two notes: rows are counted as they are written, footers read without tasks."""
    from voltrail.plans import ledger

    landing, name = str(tmp_path / "landing"), f"{namespace}.canbus01"
    for i in range(4):
        rows = spark.range(i * 70, i * 70 + 70).selectExpr(
            "if(id % 10 = 0, null, concat('V', id % 5)) AS vin_id",
            "cast(id % 3 AS int) AS Clean_Mode",
            "if(id % 7 = 0, null, timestamp_ntz'2024-03-01 00:00:00' + make_dt_interval(0, 0, 0, id * 600)) AS ts",
        )
        rows.coalesce(1).write.mode("append").parquet(landing)
    query = ingest_stream(spark, landing, name, str(tmp_path / "c"), ts_type=NTZ, max_files_per_trigger=1)
    query.awaitTermination()
    jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup(str(query.runId)))
    assert jobs <= 4 * 4
    notes = ledger.loads(spark, name).select("rows_read", "rows_written", "rows_rejected", "null_keys").collect()
    assert [tuple(n) for n in notes] == [(70, 63, 7, 9)] * 4
    assert catalog.fresh_table(spark, name).count() == 4 * 63


def odd_files(spark, landing, count):
    """One file a batch; rows without vehicle, and rows without time."""
    for i in range(count):
        rows = spark.range(i * 70, i * 70 + 70).selectExpr(
            "if(id % 10 = 0, null, concat('V', id % 5)) AS vin_id",
            "cast(id % 3 AS int) AS Clean_Mode",
            "cast(id % 90 AS float) AS DISPLAY_SPEED",
            "if(id % 7 = 0, null, timestamp_ntz'1890-03-01 00:00:00.25' + make_dt_interval(0, 0, 0, id * 600)) AS ts",
        )
        rows.coalesce(1).write.mode("append").parquet(landing)


def test_a_small_batch_makes_no_job_of_its_notes(spark, namespace, tmp_path):
    """Two jobs a batch: names of the files, and the load; notes are put beside them."""
    from voltrail.plans import ledger

    landing, name = str(tmp_path / "landing"), f"{namespace}.canbus01"
    odd_files(spark, landing, 4)
    query = ingest_stream(spark, landing, name, str(tmp_path / "c"), ts_type=NTZ, max_files_per_trigger=1)
    query.awaitTermination()
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup(str(query.runId))) <= 4 * 2
    notes = ledger.loads(spark, name).select("rows_read", "rows_written", "rows_rejected", "null_keys").collect()
    assert [tuple(n) for n in notes] == [(70, 63, 7, 9)] * 4
    assert [r["rows_rejected"] for r in spark.table(f"{name}_rejected").collect()] == [7] * 4
    want = clean(spark.read.parquet(landing).where("vin_id IS NOT NULL"), NTZ)
    assert snapshot(telemetry.scan(spark, name)) == snapshot(want)


def test_small_loads_of_instants_and_of_odd_years(spark, namespace):
    """Written by tasks or (years beyond 9999) by Spark, the rows are those that came."""
    for kind in (T.TimestampType(), NTZ):
        name = f"{namespace}.{kind.typeName()}"
        catalog.ensure_telemetry_table(spark, name, kind)
        first = "timestamp_ntz'1500-01-01 00:00:00.000001'"
        for i, years in enumerate((400, 4000)):
            rows = spark.range(12).selectExpr(
                "concat('V', id) AS vin_id", f"cast({first} + make_ym_interval(cast(id * {years} AS int)) AS {kind.simpleString()}) AS ts"
            )
            load_id = f"s-{i}"
            assert writes.load_telemetry(clean(rows, kind), name, load_id, most_rows=12, count=True) == (12, 0)
            stored = catalog.fresh_table(spark, name).where(F.col(contract.LOAD) == load_id)
            text = lambda df: sorted(r[0] for r in df.selectExpr("to_json(struct(*))").collect())
            assert text(stored.select(*contract.COLUMNS)) == text(clean(rows, kind))
            files = {f.rsplit("/", 1)[1] for f in stored.inputFiles()}
            assert (files == {writes.SMALL_FILE}) == (years == 400)


def test_a_small_load_cut_short_is_made_whole(spark, namespace, tmp_path):
    """Files that a lost load left in its folders, from Spark or from itself, do not stay; a
    load that readers see already is replaced."""
    name = f"{namespace}.canbus01"
    catalog.ensure_telemetry_table(spark, name, NTZ)
    load = lambda first, last: writes.load_telemetry(
        clean(raw(spark, first, last)), name, "s-000000001", most_rows=1000, count=True
    )
    assert load(0, 300) == (300, 0)
    held = catalog.partition_values(spark, name)
    files = glob.glob(catalog.table_details(spark, name)["Location"].removeprefix("file:") + "/*/*/*.parquet")
    assert len(files) == len(held) == 3
    for file in files:  # as a commit of Spark would have left it
        shutil.copy(file, file.replace("part-00000", "part-00007-lost"))
    # Out of the catalog, while the files stay.
    place = files[0].rsplit("/ts_day", 1)[0]
    shutil.copytree(place, tmp_path / "kept")
    writes.drop_partitions(spark, name, held)
    shutil.copytree(tmp_path / "kept", place, dirs_exist_ok=True)
    assert load(0, 300) == (300, 0)
    assert snapshot(telemetry.scan(spark, name)) == snapshot(clean(raw(spark, 0, 300)))
    assert load(0, 100) == (100, 0)  # seen by readers: fewer days now
    assert snapshot(telemetry.scan(spark, name)) == snapshot(clean(raw(spark, 0, 100)))
    assert len(catalog.partition_values(spark, name)) == 1
