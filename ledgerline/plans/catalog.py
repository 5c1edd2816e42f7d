"""All registered queries with their check SQL."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerline.plans.sqlforms import portable

_MODULES = ("scalars", "relations", "history", "series")


def _entries() -> dict[str, tuple[Callable, str | None]]:
    found: dict[str, tuple[Callable, str | None]] = {}
    for name in _MODULES:
        found.update(importlib.import_module(f"ledgerline.plans.catalog_{name}").QUERIES)
    return found


def _portable_query(fn: Callable) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return portable(fn(spark, folder))

    run.__doc__ = fn.__doc__
    return run


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _portable_query(fn) for name, (fn, _) in _entries().items()}


def all_sql() -> dict[str, str]:
    return {name: sql for name, (_, sql) in _entries().items() if sql}
