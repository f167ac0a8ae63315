import pytest


@pytest.fixture()
def folder(spark, tmp_path):
    """Writes tables where the queries look for them."""

    def write(name, rows, schema, clashing=()):
        df = spark.createDataFrame(rows, schema)
        df = df.selectExpr("*", *[f"'{c}' AS `{c}`" for c in clashing if c not in df.columns])
        df.repartition(3).write.mode("overwrite").parquet(f"{tmp_path}/{name}.parquet")
        return str(tmp_path)

    return write
