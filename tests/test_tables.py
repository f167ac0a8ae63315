import datetime as dt
import glob
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltrail import contract
from voltrail.operators import summaries
from voltrail.operators.clean import clean
from voltrail.plans import catalog, jobs, writes
from voltrail.sources import telemetry

NTZ = T.TimestampNTZType()


def rows(spark, n=1000, days=5, start="2024-03-01"):
    return spark.range(n).selectExpr(
        "concat('V', id % 7) AS vin_id",
        "cast(id % 3 AS int) AS Clean_Mode",
        "cast(id % 2 AS int) AS Road_Mode",
        "cast(id % 101 AS int) AS Fuel_Percentage",
        "cast(id % 60 AS float) AS DISPLAY_SPEED",
        f"cast(date_add(date'{start}', cast(id % {days} AS int)) AS timestamp_ntz) "
        "+ make_dt_interval(0, 0, 0, id) AS ts",
    )


def made(spark, namespace, df=None, load="one", **kwargs):
    name = f"{namespace}.canbus01"
    catalog.ensure_telemetry_table(spark, name, NTZ)
    writes.load_telemetry(clean(rows(spark) if df is None else df), name, load, **kwargs)
    return name


def location(spark, table):
    return spark.sql(f"DESCRIBE EXTENDED {table}").where("col_name = 'Location'").first()[1].split(":", 1)[1]


def snapshot(df):
    return sorted(map(repr, df.collect()))


def test_create_then_reuse(spark, namespace):
    name = f"{namespace}.canbus01"
    assert not catalog.table_exists(spark, name)
    assert catalog.ensure_telemetry_table(spark, name, NTZ)
    assert not catalog.ensure_telemetry_table(spark, name, NTZ)
    assert catalog.table_property(spark, name, "day.zone") == "UTC"


def test_existing_table_is_checked(spark, namespace):
    spark.sql(f"CREATE TABLE {namespace}.canbus01 (vin_id int) USING parquet")
    with pytest.raises(contract.ContractError, match="vin_id"):
        catalog.ensure_telemetry_table(spark, f"{namespace}.canbus01", NTZ)


def test_missing_namespace_counts_as_absent(spark):
    assert not catalog.table_exists(spark, "no_such_place.canbus01")


def test_lists(spark, namespace):
    name = made(spark, namespace)
    assert namespace in [r[0] for r in catalog.list_namespaces(spark).collect()]
    assert [r["tableName"] for r in catalog.list_tables(spark, namespace).collect()] == ["canbus01"]
    assert catalog.list_partitions(spark, name).count() == 5
    described = {r["col_name"]: r["data_type"] for r in catalog.describe(spark, name).collect()}
    assert described["fuel_percentage"] == "int" and described["ts_day"] == "date"
    catalog.drop_table(spark, name)
    assert not catalog.table_exists(spark, name)
    assert catalog.catalog_report(spark, namespace).count() == 0


def test_iceberg_ddl():
    text = catalog.telemetry_table_ddl("c.n.t", provider="iceberg")
    assert "PARTITIONED BY (days(ts), `load_id`)" in text and "ts_day" not in text
    assert "'write.parquet.compression-codec'='snappy'" in text


def test_same_load_replaces_itself_and_others_stay(spark, namespace):
    name = made(spark, namespace, load="one")
    made(spark, namespace, load="two")
    before = snapshot(spark.table(name))
    made(spark, namespace, load="one")
    assert snapshot(spark.table(name)) == before and len(before) == 2000


def test_codec_of_written_files(spark, namespace):
    name = f"{namespace}.packed"
    spark.sql(catalog.telemetry_table_ddl(name, NTZ, compression="zstd"))
    writes.load_telemetry(clean(rows(spark)), name, "one")
    files = glob.glob(location(spark, name) + "/*/*/*.parquet")
    assert files and all(f.endswith(".zstd.parquet") for f in files)


def test_rows_without_time_are_kept(spark, namespace):
    timeless = F.when(F.col("Clean_Mode") > 0, F.col("ts"))
    name = made(spark, namespace, rows(spark).withColumn("ts", timeless))
    assert telemetry.scan(spark, name).count() == 1000


def test_a_hot_day_is_spread_over_files(spark, namespace):
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "20KB")
    try:
        name = made(spark, namespace, rows(spark, n=40_000, days=1).repartition(8))
        files = glob.glob(location(spark, name) + "/*/*/*.parquet")
        assert len(files) > 1
        assert spark.table(name).count() == 40_000
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")


def test_days_are_pruned(spark, namespace):
    name = made(spark, namespace)
    df = telemetry.scan(spark, name, dt.datetime(2024, 3, 2), dt.datetime(2024, 3, 4))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ts_day" in plan
    days = {r[0] for r in df.select(F.to_date("ts")).distinct().collect()}
    assert days == {dt.date(2024, 3, 2), dt.date(2024, 3, 3)}
    files = {f.split("ts_day=")[1][:10] for f in df.inputFiles()}
    assert files == {"2024-03-02", "2024-03-03"}


def test_other_zone_is_refused_for_instants(spark, namespace):
    name = f"{namespace}.canbus01"
    catalog.ensure_telemetry_table(spark, name)
    df = clean(rows(spark), T.TimestampType())
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Shanghai")
    try:
        with pytest.raises(ValueError, match="counts days in UTC"):
            writes.load_telemetry(df, name, "one")
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_append_by_name(spark, namespace):
    name = f"{namespace}.plain"
    spark.range(2).selectExpr("cast(id AS int) AS a", "'x' AS b").write.saveAsTable(name)
    writes.append_by_name(spark.sql("SELECT 'y' AS b, 5 AS a"), name)
    writes.append_by_name(spark.sql("SELECT 6 AS a"), name)
    with pytest.raises(Exception):
        writes.append_by_name(spark.sql("SELECT 7 AS a, 1.5D AS c"), name)
    writes.append_by_name(spark.sql("SELECT 7 AS a, 1.5D AS c"), name, evolve=True)
    got = {tuple(r) for r in spark.table(name).select("a", "b", "c").collect()}
    assert got == {(0, "x", None), (1, "x", None), (5, "y", None), (6, None, None), (7, None, 1.5)}


def test_append_overflow_is_an_error(spark, namespace):
    name = f"{namespace}.plain"
    spark.sql(f"CREATE TABLE {name} (a int) USING parquet")
    with pytest.raises(Exception, match="OVERFLOW"):
        writes.append_by_name(spark.sql("SELECT 3000000000L AS a"), name)


def test_full_refresh_drops_days_that_are_gone(spark, namespace):
    name = f"{namespace}.{summaries.DAILY}"
    first = summaries.daily_summary(clean(rows(spark, days=5)))
    second = summaries.daily_summary(clean(rows(spark, days=3, start="2024-03-02")))
    writes.create_table_as(first, name, "date")
    writes.create_table_as(second, name, "date")
    assert snapshot(spark.table(name).select(*second.columns)) == snapshot(second)


def test_failed_refresh_keeps_the_old_table(spark, namespace):
    name = f"{namespace}.{summaries.DAILY}"
    good = summaries.daily_summary(clean(rows(spark)))
    writes.create_table_as(good, name, "date")
    before = snapshot(spark.table(name))
    bad = good.withColumn("record_count", F.raise_error(F.lit("broken")).cast("bigint"))
    with pytest.raises(Exception, match="broken"):
        writes.create_table_as(bad, name, "date")
    assert snapshot(spark.table(name)) == before


def test_day_refresh_equals_full_rebuild(spark, namespace):
    name = made(spark, namespace, rows(spark, days=3), "one")
    jobs.refresh_summaries(spark, name, namespace)
    late = rows(spark, n=300, days=2, start="2024-03-03")
    timeless = F.when(F.col("Clean_Mode") > 0, F.col("ts"))
    made(spark, namespace, late.withColumn("ts", timeless), "two")
    jobs.refresh_summary_days(spark, name, namespace, jobs.loaded_days(spark, name, "two"))
    base = telemetry.scan(spark, name)
    for summary, build in summaries.SUMMARIES.items():
        want, got = build(base), jobs.read_summary(spark, namespace, summary)
        assert got.columns == want.columns and snapshot(got) == snapshot(want)


def test_ingest_and_summarize(spark, namespace, tmp_path):
    landing = str(tmp_path / "landing")
    rows(spark).drop("Road_Mode").write.parquet(landing)
    for _ in range(2):
        line = jobs.ingest_and_summarize(spark, landing, namespace, "one", NTZ).first()
    assert (line["rows_read"], line["rows_written"], line["rows_after"]) == (1000, 1000, 1000)
    assert "road_mode" in line["missing_columns"]
    total = spark.table(f"{namespace}.{summaries.DAILY}").agg(F.sum("record_count")).first()[0]
    assert total == 1000


def test_ingest_of_an_empty_folder_and_a_missing_one(spark, namespace, tmp_path):
    empty = tmp_path / "empty"
    empty.mkdir()
    line = jobs.ingest(spark, str(empty), f"{namespace}.canbus01", "one", NTZ).first()
    assert (line["rows_read"], line["rows_after"]) == (0, 0)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        jobs.ingest(spark, str(tmp_path / "gone"), f"{namespace}.canbus01", "two", NTZ)
    assert spark.table(f"{namespace}.canbus01").count() == 0


def test_sample_rows(spark):
    df = telemetry.sample_rows(spark, dt.datetime(2024, 1, 1), NTZ)
    assert df.schema.names == list(contract.COLUMNS)
    assert [r["__primary_key"] for r in df.collect()] == [
        "TEST001_2024-01-01 00:00:00",
        "TEST002_2024-01-01 00:00:00",
    ]


def test_split_export_limits_rows(spark, tmp_path):
    path = str(tmp_path / "split")
    writes.export_split(spark.range(0, 1000, 1, 2), path, 300)
    counts = [spark.read.parquet(f).count() for f in glob.glob(path + "/*.parquet")]
    assert max(counts) <= 300 and sum(counts) == 1000


@pytest.mark.parametrize("codec", sorted(writes.EXPORT_CODECS))
def test_export_codecs(spark, tmp_path, codec):
    df = spark.range(100).selectExpr("id", "concat('n', id) AS name")
    path = str(tmp_path / codec)
    writes.export_compressed(df, path, codec)
    assert snapshot(writes.read_export(spark, path, codec, df.schema)) == snapshot(df)
    assert os.path.exists(path + "/_SUCCESS")


def test_unknown_codec(spark, tmp_path):
    with pytest.raises(ValueError, match="brotli"):
        writes.export_compressed(spark.range(1), str(tmp_path), "brotli")


def test_table_without_dynamic_overwrite_is_not_emptied(spark, namespace):
    name = f"{namespace}.foreign"
    spark.sql(f"CREATE TABLE {name} (a int, d string) USING parquet PARTITIONED BY (d)")
    spark.sql(f"INSERT INTO {name} VALUES (1, 'x'), (2, 'y')")
    with pytest.raises(ValueError, match="partitionOverwriteMode"):
        writes.replace_partitions(spark.sql("SELECT 3 AS a, 'x' AS d"), name)
    assert spark.table(name).count() == 2


def test_session_setting_is_left_alone(spark, namespace):
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    made(spark, namespace)
    made(spark, namespace, load="two")
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == before
    assert spark.table(f"{namespace}.canbus01").count() == 2000


def test_full_refresh_of_a_table_made_elsewhere(spark, namespace):
    name = f"{namespace}.{summaries.DAILY}"
    daily = summaries.daily_summary(clean(rows(spark)))
    daily.limit(3).write.partitionBy("date").saveAsTable(name)
    writes.create_table_as(daily, name, "date")
    assert spark.table(name).count() == daily.count()


def test_full_refresh_with_rows_of_no_date(spark, namespace):
    name = f"{namespace}.{summaries.DAILY}"
    timeless = F.when(F.col("Clean_Mode") > 0, F.col("ts"))
    some = summaries.daily_summary(clean(rows(spark).withColumn("ts", timeless)))
    none = summaries.daily_summary(clean(rows(spark)))
    for wanted in (some, some, none, some):
        writes.create_table_as(wanted, name, "date")
        got = summaries.ordered(catalog.fresh_table(spark, name))
        assert snapshot(got) == snapshot(wanted)


def test_load_without_gathering(spark, namespace):
    name = made(spark, namespace, gather_days=False)
    assert snapshot(telemetry.scan(spark, name)) == snapshot(clean(rows(spark)))


def test_files_of_different_columns_are_read_whole(spark, namespace, tmp_path):
    landing = str(tmp_path / "landing")
    for part in (["Road_Mode"], ["Clean_Mode"], ["Road_Mode", "Clean_Mode", "DISPLAY_SPEED"]):
        rows(spark, n=100).drop(*part).coalesce(1).write.mode("append").parquet(landing)
    line = jobs.ingest(spark, landing, f"{namespace}.canbus01", "one", NTZ).first()
    assert line["rows_written"] == 300
    counts = telemetry.scan(spark, f"{namespace}.canbus01").agg(
        F.count("road_mode"), F.count("clean_mode"), F.count("display_speed"), F.count("fuel_percentage")
    )
    assert list(counts.first()) == [100, 100, 200, 300]


@pytest.mark.parametrize("order", [1, -1])
def test_columns_of_all_footers_count(spark, namespace, tmp_path, order):
    """Each file in turn is the one that differs in columns, case or width."""
    landing = str(tmp_path / "landing")
    parts = [
        rows(spark, n=100).withColumnsRenamed({"Fuel_Percentage": "FUEL_PERCENTAGE", "ts": "TS"}),
        rows(spark, n=100).drop("Clean_Mode"),
        rows(spark, n=10).drop("vin_id"),
        rows(spark, n=100).withColumn("Fuel_Percentage", F.col("Fuel_Percentage").cast("bigint")),
    ]
    for i, part in enumerate(parts[::order]):
        part.drop("Road_Mode").coalesce(1).write.parquet(f"{landing}/{i}")
    line = jobs.ingest(spark, landing, f"{namespace}.canbus01", "one", NTZ).first()
    assert (line["rows_read"], line["rows_written"], line["rows_rejected"]) == (310, 300, 10)
    assert "road_mode" in line["missing_columns"]
    assert not {"fuel_percentage", "clean_mode", "vin_id", "ts"} & set(line["missing_columns"])
    counts = telemetry.scan(spark, f"{namespace}.canbus01").agg(
        F.count("fuel_percentage"), F.count("clean_mode"), F.count("display_speed"), F.count("ts"), F.count("road_mode")
    )
    assert list(counts.first()) == [300, 200, 300, 300, 0]


def test_files_without_a_mandatory_column_stop_the_job(spark, namespace, tmp_path):
    landing = str(tmp_path / "landing")
    rows(spark, n=100).drop("vin_id").write.parquet(landing)
    with pytest.raises(contract.ContractError, match="vin_id"):
        jobs.ingest(spark, landing, f"{namespace}.canbus01", "one", NTZ)
    assert spark.table(f"{namespace}.canbus01").count() == 0


def test_a_repeat_with_fewer_days_drops_the_others(spark, namespace):
    name = made(spark, namespace, load="it's one")
    made(spark, namespace, load="two")
    made(spark, namespace, clean(rows(spark, n=10, days=1)), load="it's one")
    left = {(r["load_id"], r["n"]) for r in spark.table(name).groupBy("load_id").agg(F.count("*").alias("n")).collect()}
    assert left == {("it's one", 10), ("two", 1000)}
    assert jobs.loaded_days(spark, name, "it's one") == [dt.date(2024, 3, 1)]


def test_emptied_days_leave_the_summaries(spark, namespace):
    name = made(spark, namespace)
    jobs.refresh_summaries(spark, name, namespace)
    made(spark, namespace, clean(rows(spark, n=20, days=2)))
    jobs.refresh_summary_days(spark, name, namespace, [dt.date(2024, 3, 1) + dt.timedelta(days=i) for i in range(5)])
    for summary, build in summaries.SUMMARIES.items():
        want = snapshot(summaries.ordered(build(telemetry.scan(spark, name))))
        assert snapshot(jobs.read_summary(spark, namespace, summary)) == want


def test_a_failing_refresh_with_new_columns_leaves_the_table(spark, namespace):
    name = f"{namespace}.by_day"
    df = rows(spark).withColumn("day", F.to_date("ts"))
    writes.create_table_as(df, name, "day")
    before = snapshot(spark.table(name))
    broken = df.withColumn("more", F.raise_error(F.lit("stop")).cast("string"))
    with pytest.raises(Exception, match="stop"):
        writes.create_table_as(broken, name, "day")
    assert snapshot(catalog.fresh_table(spark, name)) == before
    writes.create_table_as(df.withColumn("more", F.lit("x")), name, "day")
    assert "more" in catalog.fresh_table(spark, name).columns


def test_odd_partition_values(spark, namespace):
    name = f"{namespace}.odd"
    values = ["a/b", "it's", "x=y", "%41", "back\\slash", None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "n int, kind string")
    writes.create_table_as(df, name, "kind")
    assert {p["kind"] for p in catalog.partition_values(spark, name)} == set(values)
    writes.create_table_as(df.where("n = 2"), name, "kind")
    assert [r["kind"] for r in catalog.fresh_table(spark, name).collect()] == ["x=y"]


def test_command_line(spark, namespace, tmp_path, capsys):
    from test_archives import zip_file

    from voltrail.__main__ import main

    rows(spark).withColumn("ts", F.col("ts").cast("timestamp")).write.parquet(str(tmp_path / "in"))
    main(["load", str(tmp_path / "in"), namespace, "--load-id", "cli"])
    assert "cli" in capsys.readouterr().out
    want = snapshot(jobs.read_summary(spark, namespace, summaries.DAILY))
    spark.sql(f"DROP TABLE {namespace}.{summaries.DAILY}")
    main(["summaries", namespace])
    assert snapshot(jobs.read_summary(spark, namespace, summaries.DAILY)) == want
    main(["days", namespace, "2024-03-01", "2024-03-02"])
    assert snapshot(jobs.read_summary(spark, namespace, summaries.DAILY)) == want and want
    main(["stream-load", str(tmp_path / "in"), namespace, str(tmp_path / "c1")])
    assert spark.table(f"{namespace}.canbus01").count() == 2000

    (tmp_path / "raw").mkdir()
    zip_file(tmp_path / "raw" / "a.zip", [("x", b"1"), ("y", b"2")])
    body = '{"Records":[{"s3":{"object":{"key":"raw/a.zip"}}},{"s3":{"object":{"key":"raw/gone.zip"}}}]}'
    sent = spark.createDataFrame([(body,), (body,), ("no json",)], "body string")
    sent.write.json(str(tmp_path / "sent"))
    for _ in range(2):
        args = [str(tmp_path / n) for n in ("sent", "", "out", "m")]
        main(["unpack", *args, "--run-id", "r/1"])
    members = spark.read.parquet(str(tmp_path / "m/members"))
    assert sorted((r["member"] or "", r["status"]) for r in members.collect()) == [
        ("", "unreadable"), ("x", "landed"), ("y", "landed"),
    ]
    assert spark.read.parquet(str(tmp_path / "m/rejected")).count() == 1
    main(["stream-unpack", str(tmp_path / "raw"), str(tmp_path / "out2"), str(tmp_path / "m2"), str(tmp_path / "c2")])
    assert sorted(p.name for p in (tmp_path / "out2").rglob("*") if p.is_file()) == ["x", "y"]
    with pytest.raises(SystemExit):
        main(["load", str(tmp_path / "in"), namespace])


def test_iceberg_summaries_fix_format_and_codec():
    assert writes.iceberg_properties("zstd") == {
        "write.format.default": "parquet", "write.parquet.compression-codec": "zstd",
    }


def test_rows_without_vehicle_are_rejected_alike(spark, namespace, tmp_path):
    """A file that lacks the vehicle's column, in a batch and in a stream."""
    from voltrail.streaming.ingest import ingest_stream

    landing = str(tmp_path / "in")
    for i in range(2):
        rows(spark).coalesce(1).write.mode("append").parquet(landing)
    rows(spark, n=10).coalesce(1).drop("vin_id").write.mode("append").parquet(landing)
    declared = rows(spark).schema
    spark.read.schema(declared).parquet(landing).write.parquet(str(tmp_path / "whole"))
    audit = jobs.ingest(spark, str(tmp_path / "whole"), f"{namespace}.batch", "one", NTZ).first()
    assert (audit["rows_read"], audit["rows_written"], audit["rows_rejected"]) == (2010, 2000, 10)
    for _ in range(2):
        name = f"{namespace}.streamed"
        ingest_stream(spark, landing, name, str(tmp_path / "c"), ts_type=NTZ).awaitTermination()
    for table in ("batch", "streamed"):
        assert spark.table(f"{namespace}.{table}").where("vin_id is not null").count() == 2000
        assert spark.table(f"{namespace}.{table}").count() == 2000
    assert spark.table(f"{namespace}.streamed_rejected").agg(F.sum("rows_rejected")).first()[0] == 10
