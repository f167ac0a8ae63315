"""Small helpers that the training-data operators share."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from voltrail.session import new_workdir

#: White space as the contracts count it: [\x20\x09-\x0D].
SPACES = " \t\n\x0b\x0c\r"
SPACE_CLASS = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """Writes the rows to the shared folder and reads them back.

    Later steps start from files every executor can open, so a lost executor never
    sends the work back to the source.
    """
    spark = df.sparkSession
    path = new_workdir(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def content(col: str = "text") -> Column:
    """Null counts as the empty text."""
    return F.coalesce(F.col(col), F.lit(""))


def text_key(col: str = "text") -> Column:
    """Tells rows of one id with different texts apart; equal rows share it."""
    return F.xxhash64(content(col))


def _field(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def whole_rows(docs: DataFrame) -> DataFrame:
    """Each row as one struct, `row`, beside doc_id and text_key: whatever the columns
    are called, they meet no column of a join."""
    return docs.select(
        F.struct(*[_field(c) for c in docs.columns]).alias("row"),
        F.col("doc_id").cast("long").alias("doc_id"),
        text_key().alias("text_key"),
    )


def rows_again(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.select(*[F.col("row").getField(c).alias(c) for c in columns])


def in_batches(
    df: DataFrame, rows: Callable[[pa.RecordBatch], dict], schema: str
) -> DataFrame:
    """mapInArrow for functions that turn a batch into columns of lists or arrays."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    arrow = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = rows(batch)
            yield pa.RecordBatch.from_arrays(
                [
                    made[f.name].cast(f.type)
                    if isinstance(made[f.name], pa.Array)
                    else pa.array(made[f.name], type=f.type)
                    for f in arrow
                ],
                schema=arrow,
            )

    return df.mapInArrow(run, schema)


def utf8(column: pa.Array) -> list[bytes]:
    """The texts of a column as UTF-8 bytes; null counts as empty."""
    return [b if b is not None else b"" for b in column.cast(pa.binary()).to_pylist()]


def sha256(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()
