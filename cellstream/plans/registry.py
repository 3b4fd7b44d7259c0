"""All queries of the core, by name, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import landing_queries, log_queries


def _modules() -> list:
    return [log_queries, landing_queries]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
    for m in _modules():
        found |= m.QUERIES
    return found


def oracle_sql() -> dict[str, str]:
    found: dict[str, str] = {}
    for m in _modules():
        found |= m.SQL
    return found
