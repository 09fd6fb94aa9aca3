"""Queries over the driver's tables, each with the SQL that it must equal."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def add(name: str, query: Query, sql: str | None = None) -> None:
    if name in QUERIES:
        raise ValueError(f"registered twice: {name}")
    QUERIES[name] = query
    if sql is not None:
        ORACLES[name] = sql


def load() -> None:
    """Registers the queries of all plan modules, once."""
    if not QUERIES:
        from tidemark.plans import accession_queries, index_queries, table_queries

        for module in (accession_queries, table_queries, index_queries):
            module.register(add)
