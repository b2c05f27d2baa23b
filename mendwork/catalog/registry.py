"""All registered queries, by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from mendwork.catalog import entries_analytics, entries_repair, entries_search, entries_workload
from mendwork.catalog.views import Views, with_views

_MODULES = (entries_search, entries_repair, entries_workload, entries_analytics)


def _entries() -> dict[str, tuple[Callable[[Views], DataFrame], str | None]]:
    merged: dict[str, tuple[Callable[[Views], DataFrame], str | None]] = {}
    for module in _MODULES:
        merged.update(module.ENTRIES)
    return merged


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(fn: Callable[[Views], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, sf_dir: fn(Views(spark, sf_dir))

    return {name: bind(fn) for name, (fn, _) in _entries().items()}


def oracle_sql() -> dict[str, str]:
    return {name: with_views(sql) for name, (_, sql) in _entries().items() if sql is not None}
