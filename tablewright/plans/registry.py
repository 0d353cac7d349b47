"""The list of registered queries, each with the SQL it is checked against."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tablewright.plans.inputs import Tables, check_sql

_QUERIES: dict[str, Callable[[Tables], DataFrame]] = {}
_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(tables) -> DataFrame`` under ``name``; ``sql`` gives the same rows in plain SQL."""

    def add(fn):
        if name in _QUERIES:
            raise ValueError(f"query {name} is registered twice")
        _QUERIES[name] = fn
        if sql is not None:
            _SQL[name] = sql
        return fn

    return add


def _load() -> None:
    from tablewright.plans import (  # noqa: F401  (importing registers)
        aggregation,
        changes,
        cleaning,
        features,
        gates,
        joins,
        ordering,
        receipts,
        scalars,
        scans,
        streams,
        versioning,
        writes,
    )


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load()

    def bind(fn):
        return lambda spark, sf_dir: fn(Tables(spark, sf_dir))

    return {name: bind(fn) for name, fn in _QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    _load()
    return {name: check_sql(re.sub(r"\n\s*", "\n", text).strip()) for name, text in _SQL.items()}
