"""All queries of the library outside ``llm``, with their SQL."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}
_CASES = ("star", "functions", "relational", "aggregates", "rules", "profiles", "pages", "payloads", "sources", "quality", "catalogue", "adhoc", "streams")


def query(name: str, sql: str | None = None):
    """Registers a query and, where SQL can express it, the DuckDB SQL of its rows."""

    def register(fn: Callable[[SparkSession, str], DataFrame]):
        if name in _QUERIES:
            raise ValueError(f"{name} is registered twice")
        _QUERIES[name] = fn
        if sql is not None:
            _SQL[name] = sql
        return fn

    return register


def _load() -> None:
    for name in _CASES:
        import_module(f"marblework.cases.{name}")


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    _load()
    return _QUERIES["flagship"](spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(_SQL)
