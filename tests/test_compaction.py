"""Small loads packed by day, the ledger of loads, and what readers see meanwhile."""

import shutil

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltrail import contract
from voltrail.operators.clean import clean
from voltrail.plans import catalog, compaction, jobs, ledger, writes
from voltrail.sources import telemetry
from voltrail.streaming.ingest import ingest_stream

NTZ = T.TimestampNTZType()


def raw(spark, first, last, days=3):
    return spark.range(first, last).selectExpr(
        "concat('V', id % 5) AS vin_id",
        "cast(id % 3 AS int) AS Clean_Mode",
        "cast(id % 90 AS float) AS DISPLAY_SPEED",
        f"timestamp_ntz'2024-03-01 00:00:00' + make_dt_interval(cast(id % {days} AS int), 0, 0, id) AS ts",
    )


def snapshot(df):
    return sorted(map(repr, df.collect()))


def per_day(spark, table):
    held = catalog.partition_values(spark, table)
    days = [p[contract.DAY] for p in held]
    return {d: days.count(d) for d in days}


def batches(spark, table, stream, count, start=0, rows=30):
    """Loads as a stream writes them, each noted."""
    for i in range(start, start + count):
        load_id = ledger.batch_load_id(stream, i)
        writes.load_telemetry(clean(raw(spark, i * rows, (i + 1) * rows)), table, load_id)
        ledger.note(spark, table, load_id, rows, *ledger.own_rows(spark, table, load_id))


@pytest.fixture()
def table(spark, namespace):
    name = f"{namespace}.canbus01"
    catalog.ensure_telemetry_table(spark, name, NTZ)
    return name


def test_closed_batches_are_packed_by_day(spark, table):
    batches(spark, table, "s", 6)
    writes.load_telemetry(clean(raw(spark, 1000, 1030)), table, "by hand")
    before = snapshot(telemetry.scan(spark, table))
    compaction.close_batches(spark, table, "s", 5)
    assert compaction.compact(spark, table) == 15
    # Readers that go through the table's state see each row once before and after the sweep.
    assert snapshot(telemetry.scan(spark, table)) == before
    assert len(catalog.partition_values(spark, table)) == 15 + 3 + 3 + 3
    compaction.recover(spark, table)
    assert per_day(spark, table) == {f"2024-03-0{d}": 3 for d in (1, 2, 3)}
    assert snapshot(telemetry.scan(spark, table)) == before
    assert snapshot(catalog.fresh_table(spark, table).select(*contract.COLUMNS)) == before
    loads = {p[contract.LOAD] for p in catalog.partition_values(spark, table)}
    assert {x for x in loads if not x.startswith("packed-")} == {"by hand", "s-000000005"}


def test_packed_partitions_are_packed_again(spark, table):
    for start in (0, 4, 8):
        batches(spark, table, "s", 4, start)
        compaction.close_batches(spark, table, "s", start + 4)
        compaction.compact(spark, table)
    compaction.recover(spark, table)
    assert set(per_day(spark, table).values()) == {1}
    assert snapshot(telemetry.scan(spark, table)) == snapshot(clean(raw(spark, 0, 360)))


def test_bins_keep_to_their_size():
    sizes = {f"l{i}": s for i, s in enumerate([5, 90, 40, 60, 30, 30, 100, 200, 1])}
    packed = compaction.bins(sizes, 100)
    assert all(sum(sizes[x] for x in b) <= 100 and len(b) > 1 for b in packed)
    assert not {"l6", "l7"} & {x for b in packed for x in b}
    assert compaction.bins({"a": 60, "b": 70}, 100) == [] and compaction.bins({}, 100) == []


def test_large_loads_wait_until_the_others_have_grown():
    """Of 200 packings of 20 new loads each, none writes the whole day again and again."""
    day, written = {"packed": 0}, 0
    for i in range(200):
        day |= {f"{i}-{n}": 1 for n in range(20)}
        for loads in compaction.bins(compaction.grown(day, 0.5), 10**9):
            written += sum(day[x] for x in loads)
            day[f"packed-{i}"] = sum(day.pop(x) for x in loads)
    total = 200 * 20
    assert sum(day.values()) == total and len(day) < 12 and written < 12 * total
    assert compaction.grown({"a": 9, "b": 1}, 0.0) == {"a": 9, "b": 1}


def test_a_closed_batch_is_not_loaded_again(spark, table):
    batches(spark, table, "s", 3)
    compaction.close_batches(spark, table, "s", 2)
    assert [compaction.may_load(spark, table, ledger.batch_load_id("s", i)) for i in range(4)] == [False, False, True, True]
    assert compaction.may_load(spark, table, "other-000000001") and compaction.may_load(spark, table, "2024-05-01x")
    compaction.close_batches(spark, table, "s", 1)  # never backwards
    assert compaction.closed_before(spark, table, "s") == 2


def test_settled_batch_loads_are_packed_and_refused(spark, table, tmp_path):
    landing = str(tmp_path / "in")
    raw(spark, 0, 30).write.parquet(landing)
    for load in ("one", "two", "three"):
        jobs.ingest(spark, landing, table, load, NTZ)
    assert compaction.compact(spark, table) == 0
    assert compaction.compact(spark, table, settled=("one", "two")) == 6
    with pytest.raises(ValueError, match="closed"):
        jobs.ingest(spark, landing, table, "two", NTZ)
    line = jobs.ingest(spark, landing, table, "three", NTZ).first()
    assert (line["rows_before"], line["rows_after"], line["rows_written"]) == (90, 90, 30)
    assert telemetry.scan(spark, table).count() == 90


@pytest.mark.parametrize("stop_at", ["writing", "written"])
def test_a_compaction_cut_short_is_taken_up(spark, table, monkeypatch, stop_at):
    batches(spark, table, "s", 4)
    compaction.close_batches(spark, table, "s", 4)
    before = snapshot(telemetry.scan(spark, table))
    set_property = catalog.set_property

    def failing(session, name, key, value):
        if key == "compaction" and stop_at == "writing" and value.startswith("written"):
            raise RuntimeError("driver lost")
        set_property(session, name, key, value)

    monkeypatch.setattr(catalog, "set_property", failing)
    if stop_at == "writing":
        with pytest.raises(RuntimeError):
            compaction.compact(spark, table)
    else:
        compaction.compact(spark, table)
    monkeypatch.setattr(catalog, "set_property", set_property)
    # Both kinds of partitions are there; readers see one of them.
    assert len(catalog.partition_values(spark, table)) == 15
    assert snapshot(telemetry.scan(spark, table)) == before
    compaction.compact(spark, table)
    compaction.recover(spark, table)
    assert set(per_day(spark, table).values()) == {1}
    assert snapshot(telemetry.scan(spark, table)) == before


def test_rows_without_time_are_packed_too(spark, table):
    for i in range(3):
        rows = raw(spark, i * 30, i * 30 + 30).withColumn("ts", F.when(F.col("Clean_Mode") > 0, F.col("ts")))
        writes.load_telemetry(clean(rows), table, ledger.batch_load_id("s", i))
    before = snapshot(telemetry.scan(spark, table))
    compaction.close_batches(spark, table, "s", 3)
    compaction.compact(spark, table)
    assert snapshot(telemetry.scan(spark, table)) == before
    compaction.recover(spark, table)
    assert set(per_day(spark, table).values()) == {1} and None in per_day(spark, table)
    assert snapshot(telemetry.scan(spark, table)) == before


def test_days_of_one_load_are_left_alone(spark, table):
    batches(spark, table, "s", 1)
    compaction.close_batches(spark, table, "s", 1)
    assert compaction.compact(spark, table) == 0
    assert catalog.properties(spark, table).get("compaction", "") == ""


def test_the_ledger_folds_closed_batches(spark, table):
    batches(spark, table, "s", 5)
    batches(spark, table, "t", 2)
    writes.load_telemetry(clean(raw(spark, 0, 7)), table, "by hand")
    assert ledger.rows_by_load(spark, table, "by hand") == (210, 7)
    compaction.close_batches(spark, table, "s", 4)
    compaction.compact(spark, table)
    noted = {r[contract.LOAD]: r["rows_written"] for r in ledger.loads(spark, table).collect()}
    assert noted == {"s-000000003+": 120, "s-000000004": 30, "t-000000000": 30, "t-000000001": 30, "by hand": 7}
    # A fold whose cleaning was lost: covered notes do not count.
    ledger.note(spark, table, "s-000000001", 30, 30, 0)
    assert ledger.rows_by_load(spark, table, "by hand") == (210, 7)
    compaction.close_batches(spark, table, "s", 5)
    compaction.compact(spark, table)
    noted = {r[contract.LOAD]: r["rows_written"] for r in ledger.loads(spark, table).collect()}
    assert noted == {"s-000000004+": 150, "t-000000000": 30, "t-000000001": 30, "by hand": 7}
    assert telemetry.scan(spark, table).count() == 217


def test_partitions_stay_bounded_over_a_hundred_batches(spark, namespace, tmp_path):
    """A stream of one small file a batch; a lost commit is replayed after packing."""
    landing, checkpoint = str(tmp_path / "landing"), tmp_path / "checkpoint"
    name = f"{namespace}.canbus01"
    raw(spark, 0, 1000, days=1).repartition(100).write.parquet(landing)
    run = lambda: ingest_stream(
        spark, landing, name, str(checkpoint), ts_type=NTZ, max_files_per_trigger=1, pack_every=25
    ).awaitTermination()
    run()
    want = snapshot(clean(raw(spark, 0, 1000, days=1)))
    assert snapshot(telemetry.scan(spark, name)) == want
    # At most the batches between two calls, those replaced last, and the packed ones.
    assert max(per_day(spark, name).values()) <= 2 * 25 + 2
    for number in (98, 99):
        for file in checkpoint.glob(f"commits/*{number}*"):
            shutil.move(file, tmp_path / f"lost-{file.name}")
    run()
    assert snapshot(telemetry.scan(spark, name)) == want
    compaction.compact(spark, name)
    assert snapshot(telemetry.scan(spark, name)) == want
    assert ledger.rows_by_load(spark, name, "none") == (1000, 0)


def test_summaries_while_a_compaction_is_on(spark, table, namespace):
    batches(spark, table, "s", 3)
    jobs.refresh_summaries(spark, table, namespace)
    want = snapshot(jobs.read_summary(spark, namespace, "vehicle_daily_summary"))
    compaction.close_batches(spark, table, "s", 3)
    compaction.compact(spark, table)
    days = [r[0] for r in telemetry.scan(spark, table).select(F.to_date("ts")).distinct().collect()]
    jobs.refresh_summary_days(spark, table, namespace, days)
    assert snapshot(jobs.read_summary(spark, namespace, "vehicle_daily_summary")) == want


def rows_read(df):
    """Rows that the scan of a plan without shuffles gives on."""
    df.collect()
    leaf = df._jdf.queryExecution().executedPlan().collectLeaves().head()
    return leaf.metrics().apply("numOutputRows").value()


@pytest.mark.parametrize("packed", [False, True])
def test_a_scan_of_one_vehicle_skips_the_others(spark, table, packed):
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    rows = spark.range(60_000).selectExpr(
        "format_string('V%03d', pmod(hash(id), 500)) AS vin_id",
        "cast(id % 90 AS float) AS DISPLAY_SPEED",
        "timestamp_ntz'2024-03-01 00:00:00' + make_dt_interval(0, 0, 0, id) AS ts",
    )
    spark.conf.set(size, "200KB")
    try:
        for i in range(2):
            part = rows.where(f"id % 2 = {i}")
            writes.load_telemetry(clean(part), table, ledger.batch_load_id("s", i), gather_days=not packed)
        if packed:
            compaction.close_batches(spark, table, "s", 2)
            compaction.compact(spark, table, file_bytes=100_000)
            compaction.recover(spark, table)
    finally:
        spark.conf.unset(size)
    whole = telemetry.scan(spark, table)
    one = telemetry.scan(spark, table, vehicles=["V123"])
    assert snapshot(one) == snapshot(whole.where("vin_id = 'V123'"))
    files = len(one.inputFiles())
    if packed:  # one file holds all rows of the vehicle
        assert files > 4 and rows_read(one) <= 2 * 60_000 / files


def test_one_compaction_at_a_time(spark, table, monkeypatch):
    """A second call while one is on does nothing; one that is lost is taken over."""
    batches(spark, table, "s", 3)
    compaction.close_batches(spark, table, "s", 3)
    before = snapshot(telemetry.scan(spark, table))
    seen, replace = [], writes.replace_partitions

    def meanwhile(df, name):
        replace(df, name)
        if name == table and not seen:
            seen.append(compaction.compact(spark, table))
            compaction.recover(spark, table)
            seen.append(snapshot(telemetry.scan(spark, table)) == before)

    monkeypatch.setattr(writes, "replace_partitions", meanwhile)
    assert compaction.compact(spark, table) == 9 and seen == [0, True]
    monkeypatch.setattr(writes, "replace_partitions", replace)
    assert snapshot(telemetry.scan(spark, table)) == before

    from voltrail.session import claim

    place = f"{compaction._location(spark, table)}/_compactions/working"
    assert claim(spark, place, 3600) and not claim(spark, place, 3600)
    compaction.recover(spark, table)
    assert len(catalog.partition_values(spark, table)) == 12
    monkeypatch.setattr(compaction, "STALE_SECONDS", 0)
    compaction.recover(spark, table)
    assert set(per_day(spark, table).values()) == {1}
    assert snapshot(telemetry.scan(spark, table)) == before


def test_a_compaction_that_was_taken_over_changes_nothing(spark, table, monkeypatch):
    batches(spark, table, "s", 3)
    compaction.close_batches(spark, table, "s", 3)
    before, replace = snapshot(telemetry.scan(spark, table)), writes.replace_partitions

    def taken_over(df, name):
        replace(df, name)
        if name == table:
            compaction._recover(spark, table)

    monkeypatch.setattr(writes, "replace_partitions", taken_over)
    with pytest.raises(RuntimeError, match="took over"):
        compaction.compact(spark, table)
    monkeypatch.setattr(writes, "replace_partitions", replace)
    assert snapshot(telemetry.scan(spark, table)) == before
    assert compaction.compact(spark, table) == 9
    compaction.recover(spark, table)
    assert snapshot(telemetry.scan(spark, table)) == before


def test_days_wait_for_new_loads(spark, table):
    """A day with few new loads is not written again; the next calls take it up."""
    batches(spark, table, "s", 3)
    compaction.close_batches(spark, table, "s", 3)
    assert compaction.compact(spark, table, least_new=4) == 0
    batches(spark, table, "s", 2, 3)
    compaction.close_batches(spark, table, "s", 5)
    assert compaction.compact(spark, table, least_new=4) == 15
    compaction.recover(spark, table)
    assert set(per_day(spark, table).values()) == {1}
    batches(spark, table, "s", 3, 5)
    compaction.close_batches(spark, table, "s", 8)
    assert compaction.compact(spark, table, least_new=4) == 0 and compaction.compact(spark, table) == 12
    assert snapshot(telemetry.scan(spark, table)) == snapshot(clean(raw(spark, 0, 240)))


def test_bins_below_the_size_of_a_file_are_one_file_each(spark, table):
    batches(spark, table, "s", 4)
    compaction.close_batches(spark, table, "s", 4)
    before = snapshot(telemetry.scan(spark, table))
    assert compaction.compact(spark, table) == 12
    compaction.recover(spark, table)
    assert snapshot(telemetry.scan(spark, table)) == before
    assert len(catalog.fresh_table(spark, table).inputFiles()) == 3
