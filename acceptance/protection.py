"""Digests and encryption."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from acceptance.telemetry_view import table
from voltrail.functions import protect

# A key for the round trip only; real keys come from a secret store.
_KEY = "0123456789abcdef0123456789abcdef"


def content_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return protect.with_digests(docs, "text", ["md5", "sha1", "sha256"]).drop("text")


def aes_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two columns encrypted and decrypted in each mode."""
    customer = table(spark, sf_dir, "customer")
    key = F.lit(_KEY)
    parts = []
    for mode in protect.AES_MODES:
        hidden = protect.encrypt_columns(customer, ["c_name", "c_acctbal"], key, mode)
        shown = protect.decrypt_columns(hidden, {"c_name": "string", "c_acctbal": "double"}, key, mode)
        parts.append(shown.withColumn("mode", F.lit(mode)))
    return reduce(DataFrame.unionByName, parts)


QUERIES = {
    "content_digests": content_digests,
    "aes_roundtrip": aes_roundtrip,
}

SQL = {
    "content_digests": "SELECT doc_id, md5(text) AS md5, sha1(text) AS sha1, sha256(text) AS sha256 FROM documents",
    "aes_roundtrip": " UNION ALL ".join(
        f"SELECT *, '{mode}' AS mode FROM customer" for mode in protect.AES_MODES
    ),
}
