"""Registered queries of the core and their SQL equivalents."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .plans import data_quality, reference

MODULES = [reference, data_quality]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: fn for module in MODULES for name, fn in module.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for module in MODULES for name, sql in module.ORACLES.items()}
