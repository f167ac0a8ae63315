"""Object-created notifications: message bodies to object keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltrail.functions.columns import decode_key, is_raw_archive_key


def _parsed(messages: DataFrame, body: str) -> DataFrame:
    return messages.withColumn("_envelope", F.try_parse_json(F.col(body)))


def object_keys(messages: DataFrame, body: str = "body") -> DataFrame:
    """One row per record that names an object, with `record` (its place) and `key`.

    Messages without records and records without a key give no row. So do bodies
    that are no JSON: those come from `rejected_messages`.
    """
    records = F.try_variant_get("_envelope", "$.Records", "array<variant>")
    kept = [c for c in messages.columns if c != body]
    return (
        _parsed(messages, body)
        .select(*kept, F.posexplode(records).alias("record", "_record"))
        .withColumn("key", F.try_variant_get("_record", "$.s3.object.key", "string"))
        .where(F.col("key").isNotNull())
        .select(*kept, "record", decode_key(F.col("key")).alias("key"))
    )


def rejected_messages(messages: DataFrame, body: str = "body") -> DataFrame:
    """Messages whose body is there but is no JSON."""
    return (
        _parsed(messages, body)
        .where(F.col(body).isNotNull() & F.col("_envelope").isNull())
        .drop("_envelope")
    )


def wanted_archives(keys: DataFrame, key: str = "key") -> DataFrame:
    """Keys of archives to unpack."""
    return keys.where(is_raw_archive_key(F.col(key)))


def notified(messages: DataFrame, body: str = "body") -> DataFrame:
    """What each message tells, in one pass: `kind` object with `key` and `version`, or
    rejected with the body as key.

    The version tells uploads of one key apart: the record's sequencer, version or
    tag, whichever it has. An object that is uploaded anew is told anew.
    """
    path = lambda r, p: F.try_variant_get(r, p, "string")
    objects = F.transform(
        F.try_variant_get("_envelope", "$.Records", "array<variant>"),
        lambda r: F.struct(
            F.lit("object").alias("kind"),
            decode_key(path(r, "$.s3.object.key")).alias("key"),
            F.coalesce(
                *[path(r, f"$.s3.object.{p}") for p in ("sequencer", "versionId", "eTag")], F.lit("")
            ).alias("version"),
        ),
    )
    refused = F.array(F.struct(F.lit("rejected").alias("kind"), F.col(body).alias("key"), F.lit("").alias("version")))
    told = F.when(F.col("_envelope").isNull(), refused).otherwise(objects)
    return _parsed(messages, body).where(F.col(body).isNotNull()).select(F.inline(told)).where("key IS NOT NULL")
