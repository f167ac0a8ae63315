import hashlib

import pytest
from pyspark.sql import functions as F

from voltrail.functions import protect

# Published test vectors of the AES standard (ECB, one block).
VECTORS = [
    ("000102030405060708090a0b0c0d0e0f", "69c4e0d86a7b0430d8cdb78070b4c55a"),
    ("000102030405060708090a0b0c0d0e0f1011121314151617", "dda97ca4864cdfe06eaf70a0ec0d7191"),
    ("000102030405060708090a0b0c0d0e0f101112131415161718191a1b1c1d1e1f", "8ea2b7ca516745bfeafc49904b496089"),
]
PLAIN = "00112233445566778899aabbccddeeff"


@pytest.mark.parametrize("text", ["", "abc", "Zürich 你好", "x" * 10_000])
def test_digests(spark, text):
    row = protect.with_digests(spark.createDataFrame([(text,)], "t string"), "t").first()
    for name in ("md5", "sha1", "sha224", "sha256", "sha384", "sha512"):
        assert row[name] == hashlib.new(name, text.encode()).hexdigest()


def test_digest_of_null(spark):
    row = protect.with_digests(spark.createDataFrame([(None,)], "t string"), "t").first()
    assert set(row) == {None}


@pytest.mark.parametrize("key, want", VECTORS)
def test_known_answers(spark, key, want):
    df = spark.createDataFrame([(PLAIN, key)], "p string, k string")
    hidden = protect.encrypt(F.unhex("p"), F.unhex("k"), "ECB")
    got = df.select(F.lower(F.hex(hidden)).alias("h")).first()["h"]
    assert got[:32] == want


@pytest.mark.parametrize("mode", sorted(protect.AES_MODES))
def test_roundtrip_and_wrong_key(spark, mode):
    key, other = F.lit("0" * 16), F.lit("1" * 16)
    df = spark.createDataFrame([("secret",), ("",), (None,)], "v string")
    hidden = protect.encrypt_columns(df, ["v"], key, mode)
    assert protect.decrypt_columns(hidden, {"v": "string"}, key, mode).collect() == df.collect()
    wrong = hidden.select(protect.try_decrypt(F.col("v"), other, mode).cast("string").alias("v"))
    assert "secret" not in [r["v"] for r in wrong.collect()]
    with pytest.raises(Exception):
        hidden.where("v IS NOT NULL").select(protect.decrypt(F.col("v"), F.lit("short"), mode)).collect()


def test_unknown_mode(spark):
    with pytest.raises(ValueError, match="CTR"):
        protect.encrypt(F.lit("x"), F.lit("0" * 16), "CTR")
