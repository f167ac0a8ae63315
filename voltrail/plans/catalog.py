"""Namespaces, tables and partitions."""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltrail import contract


def ensure_namespace(spark: SparkSession, namespace: str, location: str | None = None) -> None:
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {namespace}{where}")


def list_namespaces(spark: SparkSession, catalog: str | None = None) -> DataFrame:
    return spark.sql(f"SHOW NAMESPACES IN {catalog}" if catalog else "SHOW NAMESPACES")


def list_tables(spark: SparkSession, namespace: str) -> DataFrame:
    return spark.sql(f"SHOW TABLES IN {namespace}").where(~F.col("isTemporary"))


def list_partitions(spark: SparkSession, table: str) -> DataFrame:
    return spark.sql(f"SHOW PARTITIONS {table}")


# Fixed value: how file tables write a NULL partition value.
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def partition_values(
    spark: SparkSession, table: str, where: dict[str, str] | None = None
) -> list[dict[str, str | None]]:
    """Values of the table's partitions as the catalog has them; no file is opened.

    `where` picks by exact values, before the rows leave the listing.
    """
    spec = ", ".join("`%s`='%s'" % (k, v.replace("\\", "\\\\").replace("'", "\\'")) for k, v in (where or {}).items())
    rows = spark.sql(f"SHOW PARTITIONS {table}" + (f" PARTITION ({spec})" if spec else "")).collect()
    parsed = [dict(part.split("=", 1) for part in r["partition"].split("/")) for r in rows]
    return [{k: None if v == NULL_PARTITION else unquote(v) for k, v in p.items()} for p in parsed]


def describe(spark: SparkSession, table: str) -> DataFrame:
    return spark.sql(f"DESCRIBE TABLE {table}")


def table_details(spark: SparkSession, table: str) -> dict[str, str]:
    """What DESCRIBE EXTENDED tells besides the columns, by name."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()
    start = next((i for i, r in enumerate(rows) if r["col_name"].startswith("# Detailed")), 0)
    return {r["col_name"]: r["data_type"] for r in rows[start + 1 :] if r["col_name"]}


def table_exists(spark: SparkSession, table: str) -> bool:
    """Whether the table is there; a namespace or catalog that is not counts as no."""
    try:
        return spark.catalog.tableExists(table)
    except AnalysisException:
        return False


def fresh_table(spark: SparkSession, table: str) -> DataFrame:
    """The table with its files listed anew: another session may have replaced some."""
    spark.catalog.refreshTable(table)
    return spark.table(table)


def drop_table(spark: SparkSession, table: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {table}")


def telemetry_table_ddl(
    table: str,
    ts_type: T.DataType = T.TimestampType(),
    provider: str = "parquet",
    compression: str = "snappy",
    zone: str = "UTC",
) -> str:
    """CREATE TABLE text of the telemetry table.

    Providers with hidden partitioning take `days(ts)`; others get a day column.
    The load column makes a repeated load replace what it wrote before.
    """
    hidden = provider.lower() == "iceberg"
    columns = [f"`{f.name}` {f.dataType.simpleString()}" for f in contract.table_schema(ts_type)]
    if hidden:
        columns.append(f"`{contract.LOAD}` string")
        layout = f"days(ts), `{contract.LOAD}`"
        options = ""
        codec = f"'write.format.default'='parquet', 'write.parquet.compression-codec'='{compression}', "
    else:
        columns += [f"`{contract.DAY}` date", f"`{contract.LOAD}` string"]
        layout = f"`{contract.DAY}`, `{contract.LOAD}`"
        options = f"OPTIONS ('compression'='{compression}', 'partitionOverwriteMode'='dynamic') "
        codec = ""
    return (
        f"CREATE TABLE {table} ({', '.join(columns)}) USING {provider} {options}"
        f"PARTITIONED BY ({layout}) TBLPROPERTIES ({codec}'day.zone'='{zone}')"
    )


def ensure_telemetry_table(
    spark: SparkSession,
    table: str,
    ts_type: T.DataType = T.TimestampType(),
    provider: str = "parquet",
    compression: str = "snappy",
) -> bool:
    """Creates the table when absent, else checks its columns; True when created."""
    if not table_exists(spark, table):
        zone = spark.conf.get("spark.sql.session.timeZone")
        spark.sql(telemetry_table_ddl(table, ts_type, provider, compression, zone))
        return True
    have = {f.name: f.dataType for f in spark.table(table).schema}
    wanted = contract.table_schema(have.get("ts", ts_type))
    wrong = [f.name for f in wanted if have.get(f.name) != f.dataType]
    if wrong:
        raise contract.ContractError(f"{table} differs from the contract in {wrong}")
    return False


def table_property(spark: SparkSession, table: str, name: str) -> str | None:
    rows = spark.sql(f"SHOW TBLPROPERTIES {table}").where(F.col("key") == name).take(1)
    return rows[0]["value"] if rows else None


def set_property(spark: SparkSession, table: str, name: str, value: str | None) -> None:
    """Sets a table property in one statement, or (None) takes it away."""
    quoted = name.replace("\\", "\\\\").replace("'", "\\'")
    if value is None:
        spark.sql(f"ALTER TABLE {table} UNSET TBLPROPERTIES IF EXISTS ('{quoted}')")
        return
    text = value.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{quoted}'='{text}')")


def properties(spark: SparkSession, table: str) -> dict[str, str]:
    return {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}


def catalog_report(spark: SparkSession, namespace: str) -> DataFrame:
    """Per table of the namespace: columns, partitions and rows.

    Loops over table names only; counts come from one job over all the tables.
    """
    report = None
    for row in list_tables(spark, namespace).collect():
        table = f"{namespace}.{row['tableName']}"
        df = fresh_table(spark, table)
        described = describe(spark, table).collect()
        partitioned = any(r["col_name"] == "# Partition Information" for r in described)
        partitions = list_partitions(spark, table).count() if partitioned else 0
        line = df.agg(F.count("*").alias("row_count")).select(
            F.lit(row["tableName"]).alias("table_name"),
            F.lit(len(df.columns)).cast("bigint").alias("column_count"),
            F.lit(partitions).cast("bigint").alias("partition_count"),
            "row_count",
        )
        report = line if report is None else report.unionByName(line)
    if report is None:
        return spark.createDataFrame(
            [], "table_name string, column_count bigint, partition_count bigint, row_count bigint"
        )
    return report
