"""All queries of the core library and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lexaloom.plans import chunk_queries, nested_queries, pipeline_queries, source_queries, table_queries, text_queries

_MODULES = (nested_queries, chunk_queries, text_queries, table_queries, source_queries, pipeline_queries)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Queries of all modules."""
    return {k: f for m in _MODULES for k, f in m.queries().items()}


def oracle_sql() -> dict[str, str]:
    """SQL of all modules."""
    return {k: s for m in _MODULES for k, s in m.oracle_sql().items()}
