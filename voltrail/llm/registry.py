"""Queries and SQL of the training-data operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from voltrail.llm import (
    bpe,
    conversation_repair,
    filter_audit,
    fingerprints,
    html_text,
    licenses,
    line_dedup,
    mixing,
    neighbours,
    quality,
    repeats,
    secrets,
    simhash_dedup,
)

_MODULES = (
    line_dedup,
    simhash_dedup,
    fingerprints,
    neighbours,
    repeats,
    quality,
    bpe,
    mixing,
    html_text,
    secrets,
    licenses,
    filter_audit,
    conversation_repair,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: query for module in _MODULES for name, query in module.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for module in _MODULES for name, sql in module.SQL.items()}
