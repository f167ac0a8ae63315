import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltrail import contract
from voltrail.operators.clean import clean

NOON = dt.datetime(2024, 5, 1, 12, 0, 0)


def raw(spark, rows, ts_type="timestamp_ntz"):
    return spark.createDataFrame(
        rows, f"vin_id string, Clean_Mode int, RESS_Power_Low_Flag boolean, ts {ts_type}"
    )


def test_renames_orders_and_fills(spark):
    df = clean(raw(spark, [("A", 1, None, NOON)]).withColumn("__op_type", F.lit(0)))
    assert df.columns == list(contract.COLUMNS)
    row = df.first()
    assert row["clean_mode"] == 1 and row["display_speed"] is None
    assert row["__primary_key"] == "A_2024-05-01 12:00:00"
    assert df.schema == contract.table_schema(T.TimestampNTZType())


def test_stale_key_is_rebuilt(spark):
    df = raw(spark, [("A", 1, True, NOON)]).withColumn("__primary_key", F.lit("old"))
    assert clean(df).first()["__primary_key"] == "A_2024-05-01 12:00:00"


def test_lowercase_input_passes(spark):
    once = clean(raw(spark, [("A", 1, True, NOON)]))
    assert clean(once).collect() == once.collect()


def test_rename_is_case_sensitive(spark):
    df = raw(spark, [("A", 1, True, NOON)]).withColumnRenamed("Clean_Mode", "CLEAN_MODE")
    statuses = {f.column: f.status for f in contract.findings(df.schema)}
    assert statuses["clean_mode"] == "missing" and statuses["CLEAN_MODE"] == "extra"
    assert clean(df).first()["clean_mode"] is None


def test_null_vin_or_time_gives_null_key_and_keeps_the_row(spark):
    df = clean(raw(spark, [(None, 1, True, NOON), ("A", 1, True, None)]))
    assert [r["__primary_key"] for r in df.collect()] == [None, None]


@pytest.mark.parametrize("name", contract.MANDATORY)
def test_mandatory_columns(spark, name):
    with pytest.raises(contract.ContractError, match=name):
        clean(raw(spark, [("A", 1, True, NOON)]).drop(name))


@pytest.mark.parametrize("sql", ["true", "'7'", "ts"])
def test_unusable_types_are_refused(spark, sql):
    df = raw(spark, [("A", 1, True, NOON)]).withColumn("Clean_Mode", F.expr(sql))
    with pytest.raises(contract.ContractError, match="clean_mode"):
        clean(df)


def test_both_spellings_are_refused(spark):
    schema = T.StructType.fromDDL("vin_id string, ts timestamp")
    schema = schema.add("Clean_Mode", T.IntegerType()).add("clean_mode", T.IntegerType())
    with pytest.raises(contract.ContractError, match="appears as"):
        contract.require(schema)


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_narrowing_never_wraps(spark, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        fits = raw(spark, [("A", 1, True, NOON)]).withColumn("Clean_Mode", F.lit(2**31 - 1).cast("bigint"))
        assert clean(fits).first()["clean_mode"] == 2**31 - 1
        over = fits.withColumn("Clean_Mode", F.lit(2**31).cast("bigint"))
        with pytest.raises(Exception, match="does not fit|overflow"):
            clean(over).collect()
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def test_instants_stay_instants(spark):
    df = clean(raw(spark, [("A", 1, True, NOON)], "timestamp"))
    assert df.schema["ts"].dataType == T.TimestampType()


def test_schema_report(spark):
    df = raw(spark, [("A", 1, True, NOON)]).withColumn("__sequence", F.lit(1).cast("bigint"))
    report = {r["column"]: r["status"] for r in contract.schema_report(df).collect()}
    assert report["vin_id"] == "ok" and report["__sequence"] == "system"
    assert report["road_mode"] == "missing"


def test_one_projection(spark):
    plan = clean(raw(spark, [("A", 1, True, NOON)]))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Project") <= 1


def test_report_of_odd_column_names(spark):
    df = raw(spark, [("A", 1, None, NOON), ("B", None, None, NOON)]).withColumn("odd.`name", F.lit(1))
    report = {r["column"]: (r["status"], r["non_null"]) for r in contract.contract_report(df).collect()}
    assert report["odd.`name"] == ("extra", 2)
    assert report["clean_mode"] == ("ok", 1) and report["road_mode"] == ("missing", 0)
