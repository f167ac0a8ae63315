"""Landing files of any mix of types: what the footers tell, and how they load."""

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltrail import contract
from voltrail.operators.clean import clean
from voltrail.plans import catalog, jobs
from voltrail.sources import footers, telemetry
from voltrail.streaming.ingest import ingest_stream

NTZ = T.TimestampNTZType()


def raw(spark, n=100):
    return spark.range(n).selectExpr(
        "concat('V', id % 5) AS vin_id",
        "cast(id % 100 AS int) AS Fuel_Percentage",
        "cast(id % 90 AS float) AS DISPLAY_SPEED",
        "timestamp_ntz'2024-03-01 00:00:00' + make_dt_interval(0, 0, 0, id * 60) AS ts",
    )


def put(df, landing, name):
    df.coalesce(1).write.parquet(f"{landing}/{name}")


def cast(df, column, kind):
    return df.withColumn(column, F.col(column).cast(kind))


def snapshot(df):
    return sorted(map(repr, df.collect()))


def loaded(spark, name):
    return snapshot(telemetry.scan(spark, name))


def jobs_of(spark, action):
    """Spark jobs that an action starts."""
    spark.sparkContext.setJobGroup("counted", "")
    action()
    tracker = spark.sparkContext.statusTracker()
    found = len(tracker.getJobIdsForGroup("counted"))
    spark.sparkContext.setJobGroup("other", "")
    return found


def mixed(spark, landing):
    """int, bigint, double, tinyint; extra columns of two types, system columns of two."""
    base = raw(spark)
    put(base.withColumn("extra", F.lit(1)).withColumn("__op_type", F.lit("x")), landing, "a")
    put(cast(base, "Fuel_Percentage", "bigint").withColumn("extra", F.lit("s")).withColumn("__op_type", F.lit(1)), landing, "b")
    put(cast(base, "Fuel_Percentage", "double"), landing, "c")
    put(cast(cast(base, "Fuel_Percentage", "tinyint"), "DISPLAY_SPEED", "double").withColumn("extra", F.array(F.lit(1))), landing, "d")
    put(base.withColumnRenamed("Fuel_Percentage", "FUEL_percentage").drop("DISPLAY_SPEED"), landing, "e")
    return base


def test_types_of_many_kinds_load_in_groups(spark, namespace, tmp_path):
    landing, name = str(tmp_path / "in"), f"{namespace}.canbus01"
    base = mixed(spark, landing)
    line = jobs.ingest(spark, landing, name, "one", NTZ).first()
    assert (line["rows_read"], line["rows_written"], line["rows_rejected"]) == (500, 500, 0)
    assert "fuel_percentage" not in line["missing_columns"] and "clean_mode" in line["missing_columns"]
    whole = clean(base)
    without = whole.withColumn("display_speed", F.lit(None).cast("float"))
    want = whole
    for _ in range(3):
        want = want.unionByName(whole)
    assert loaded(spark, name) == snapshot(want.unionByName(without))


def test_groups_follow_the_types_not_the_files(spark, tmp_path):
    landing = str(tmp_path / "in")
    mixed(spark, landing)
    for i in range(10):
        put(cast(raw(spark, 5), "Fuel_Percentage", ("int", "bigint")[i % 2]), landing, f"f{i}")
    files = footers.landing_files(spark, landing)
    found = footers.survey(files)
    assert not found.unusable and found.rows == 550
    assert sorted(g.files for g in found.groups) == [1, 14]
    kinds = {g.schema["Fuel_Percentage"].dataType.simpleString() for g in found.groups}
    assert kinds == {"bigint", "double"}
    # One aggregate over all footers, however many types there are.
    assert jobs_of(spark, lambda: footers.survey(files)) <= 2


def test_a_file_that_cannot_be_loaded_stops_the_batch(spark, namespace, tmp_path):
    landing, name = str(tmp_path / "in"), f"{namespace}.canbus01"
    put(raw(spark), landing, "a")
    put(raw(spark).withColumn("Fuel_Percentage", F.lit("full")), landing, "b")
    with pytest.raises(contract.ContractError, match="fuel_percentage is string"):
        jobs.ingest(spark, landing, name, "one", NTZ)
    assert spark.table(name).count() == 0


def test_an_odd_file_does_not_stop_the_stream(spark, namespace, tmp_path):
    landing, name = str(tmp_path / "in"), f"{namespace}.canbus01"
    run = lambda: ingest_stream(
        spark, landing, name, str(tmp_path / "c"), ts_type=NTZ, max_files_per_trigger=2
    ).awaitTermination()
    base = mixed(spark, landing)
    run()
    put(base.withColumn("Fuel_Percentage", F.lit("full")), landing, "text")
    put(base.withColumn("Fuel_Percentage", F.array(F.lit(1))), landing, "list")
    (tmp_path / "in" / "junk.parquet").write_bytes(b"PAR1 no parquet file PAR1")
    (tmp_path / "in" / "br{ack}et[1]*.parquet").write_bytes(next((tmp_path / "in" / "a").glob("part*")).read_bytes())
    put(base, landing, "more")
    run()
    run()
    assert telemetry.scan(spark, name).count() == 700
    notes = catalog.fresh_table(spark, f"{name}_rejected_files").collect()
    assert sorted((r["reason"][:25], r["files"], r["file_rows"]) for r in notes) == [
        ("fuel_percentage is nested", 1, 100),
        ("fuel_percentage is string", 1, 100),
        ("no Parquet file: Parquet ", 1, 0),
    ]


def test_names_that_differ_in_case_only_within_a_file(spark, tmp_path):
    (tmp_path / "in").mkdir()
    pq.write_table(pa.table({"vin_id": ["a"], "TS": [1], "ts": [2]}), tmp_path / "in" / "x.parquet")
    found = footers.survey(footers.landing_files(spark, str(tmp_path / "in")))
    assert [u.reason for u in found.unusable] == ["columns that differ in case only: ts"]


@pytest.mark.parametrize(
    "kind, name",
    [
        (pa.int8(), "tinyint"), (pa.int16(), "smallint"), (pa.int32(), "int"), (pa.int64(), "bigint"),
        (pa.uint8(), "smallint"), (pa.uint16(), "int"), (pa.uint32(), "bigint"), (pa.uint64(), "decimal(20,0)"),
        (pa.float32(), "float"), (pa.float64(), "double"), (pa.bool_(), "boolean"), (pa.string(), "string"),
        (pa.binary(), "binary"), (pa.date32(), "date"), (pa.decimal128(12, 3), "decimal(12,3)"),
        (pa.timestamp("us", "UTC"), "timestamp"), (pa.timestamp("ms"), "timestamp_ntz"),
        (pa.timestamp("ns"), "timestamp in nanoseconds"),
    ],
)
def test_types_are_those_that_spark_reads(spark, tmp_path, kind, name):
    path = str(tmp_path / "x.parquet")
    pq.write_table(pa.table({"ts": pa.array([None], kind)}), path, version="2.6")
    assert footers._shape(pq.ParquetFile(path)) == [("ts", name)]
    if "nano" not in name:
        assert spark.read.parquet(path).schema["ts"].dataType.simpleString() == name


def test_storage_failures_are_no_unusable_files(spark, tmp_path):
    gone = spark.createDataFrame([(f"file:{tmp_path}/gone.parquet",)], "path string")
    with pytest.raises(Exception, match="StorageError"):
        footers.survey(gone)


def test_columns_outside_the_contract_are_loaded_on_request(spark, namespace, tmp_path):
    name, base = f"{namespace}.canbus01", raw(spark, 10)
    plain, first, second, third = (str(tmp_path / n) for n in "abcd")
    put(base.withColumn("Cabin", F.lit(1)), plain, "x")
    jobs.ingest(spark, plain, name, "plain", NTZ)
    assert "cabin" not in [c.lower() for c in spark.table(name).columns]
    put(base.withColumn("Cabin", F.lit(2)).withColumn("list", F.array(F.lit(1))), first, "x")
    put(base.withColumn("CABIN", F.lit(0.5)), first, "y")
    jobs.ingest(spark, first, name, "first", NTZ, evolve=True)
    put(base.withColumn("cabin", F.lit(7)).withColumn("word", F.lit("w")), second, "x")
    jobs.ingest(spark, second, name, "second", NTZ, evolve=True)
    rows = catalog.fresh_table(spark, name).groupBy("load_id").agg(F.sum("cabin"), F.count("word"), F.count("*"))
    assert sorted(map(tuple, rows.collect())) == [("first", 25.0, 0, 20), ("plain", None, 0, 10), ("second", 70.0, 10, 10)]
    assert "list" not in spark.table(name).columns
    assert telemetry.scan(spark, name).columns == list(contract.COLUMNS)
    put(base.withColumn("cabin", F.lit("hot")), third, "x")
    put(base.withColumn("cabin", F.lit(1)), third, "y")
    with pytest.raises(contract.ContractError, match="cabin is"):
        jobs.ingest(spark, third, name, "third", NTZ, evolve=True)
