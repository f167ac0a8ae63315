"""All acceptance queries by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from acceptance import archive_jobs, arrivals, protection, tables, telemetry

_MODULES = (telemetry, tables, arrivals, archive_jobs, protection)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: query for module in _MODULES for name, query in module.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for module in _MODULES for name, sql in module.SQL.items()}
