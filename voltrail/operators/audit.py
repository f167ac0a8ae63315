"""Row counts, key checks, table statistics and previews."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltrail import contract
from voltrail.operators import summaries


def key_audit(cleaned: DataFrame) -> DataFrame:
    """One row: rows, distinct keys, keys met more than once, rows without key.

    Keys are told apart by 128 bits of hash, so no key text goes through the shuffle.
    """
    key = F.col(contract.KEY)
    hashes = [F.when(key.isNotNull(), F.xxhash64(*seed, key)).alias(n) for n, seed in (("h1", ()), ("h2", (F.lit(1),)))]
    per_key = cleaned.select(*hashes).groupBy("h1", "h2").agg(F.count("*").alias("n"))
    named = F.col("h1").isNotNull()
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("cleaned_rows"),
        F.count("h1").alias("distinct_keys"),
        F.count(F.when(named & (F.col("n") > 1), 1)).alias("duplicate_keys"),
        F.coalesce(F.sum(F.when(~named, F.col("n"))), F.lit(0)).alias("null_key_rows"),
    )


def row_count_audit(raw: DataFrame, cleaned: DataFrame) -> DataFrame:
    """`key_audit` next to the number of raw rows."""
    counts = raw.agg(F.count("*").alias("raw_rows"))
    names = ["raw_rows", "cleaned_rows", "distinct_keys", "duplicate_keys", "null_key_rows"]
    return counts.unionByName(key_audit(cleaned), allowMissingColumns=True).agg(
        *[F.max(n).alias(n) for n in names]
    )


def table_stats(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count of every table, in one job."""
    counts = [
        df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def summary_stats(rollup: DataFrame) -> DataFrame:
    """Rows each summary table has, from one pass over `summaries.mode_rollup`."""
    per_day = rollup.groupBy("vin_id", "date").agg(F.count("*").alias("modes"))
    counts = per_day.agg(F.count("*").alias("days"), F.coalesce(F.sum("modes"), F.lit(0)).alias("modes"))
    named = [(summaries.DAILY, "days"), (summaries.CHARGING, "days"), (summaries.DRIVING, "modes")]
    rows = F.array(*[F.struct(F.lit(n).alias("table_name"), F.col(c).alias("row_count")) for n, c in named])
    return counts.select(F.inline(rows))


def preview(df: DataFrame, keys: list[str], n: int) -> DataFrame:
    """The first `n` rows by `keys`; tasks keep `n` rows each."""
    return df.orderBy(*keys).limit(n)
