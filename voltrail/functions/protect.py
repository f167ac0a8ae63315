"""Content digests and column encryption."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Cipher mode and the padding Spark pairs with it.
AES_MODES = {"ECB": "PKCS", "CBC": "PKCS", "GCM": "DEFAULT"}


def digests(content: Column) -> dict[str, Column]:
    """Hex digests by name, all computed by Spark's own functions."""
    return {
        "md5": F.md5(content),
        "sha1": F.sha1(content),
        "sha224": F.sha2(content, 224),
        "sha256": F.sha2(content, 256),
        "sha384": F.sha2(content, 384),
        "sha512": F.sha2(content, 512),
    }


def with_digests(df: DataFrame, content: str, names: Iterable[str] | None = None) -> DataFrame:
    available = digests(F.col(content))
    return df.withColumns({n: available[n] for n in (names or available)})


def _mode(mode: str) -> tuple[Column, Column]:
    if mode not in AES_MODES:
        raise ValueError(f"mode {mode} is not one of {sorted(AES_MODES)}")
    return F.lit(mode), F.lit(AES_MODES[mode])


def encrypt(value: Column, key: Column, mode: str = "GCM") -> Column:
    """AES with a 16, 24 or 32 byte key; the random start vector leads the result."""
    return F.aes_encrypt(value, key, *_mode(mode))


def decrypt(value: Column, key: Column, mode: str = "GCM") -> Column:
    """Raises on a wrong key or damaged bytes."""
    return F.aes_decrypt(value, key, *_mode(mode))


def try_decrypt(value: Column, key: Column, mode: str = "GCM") -> Column:
    """NULL on a wrong key or damaged bytes."""
    return F.try_aes_decrypt(value, key, *_mode(mode))


def encrypt_columns(df: DataFrame, columns: Iterable[str], key: Column, mode: str = "GCM") -> DataFrame:
    return df.withColumns({c: encrypt(F.col(c).cast("string"), key, mode) for c in columns})


def decrypt_columns(df: DataFrame, types: dict[str, str], key: Column, mode: str = "GCM") -> DataFrame:
    return df.withColumns(
        {c: decrypt(F.col(c), key, mode).cast("string").cast(t) for c, t in types.items()}
    )
