"""Registered queries of the library's own operators, by operator id and name, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(query: Query) -> Query:
        assert name not in _QUERIES, name
        _QUERIES[name] = query
        if sql is not None:
            _SQL[name] = sql
        return query

    return add


def queries() -> dict[str, Query]:
    return _QUERIES


def oracle_sql() -> dict[str, str]:
    return _SQL
