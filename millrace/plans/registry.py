"""All queries by name, with the SQL each is checked against."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

_MODULES = ("relational", "scans", "writes", "definitions", "warehouse", "histories", "streams")


def _entries() -> dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]]:
    found: dict = {}
    for name in _MODULES:
        entries = import_module(f"millrace.plans.{name}").QUERIES
        repeated = found.keys() & entries.keys()
        if repeated:
            raise ValueError(f"query names used twice: {sorted(repeated)}")
        found.update(entries)
    return found


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: run for name, (run, _) in _entries().items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql.strip() for name, (_, sql) in _entries().items() if sql}
