"""Name -> query and name -> DuckDB text, gathered from the plan modules."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from hustings.plans import audit_queries, document_queries, geometry_queries, label_queries, list_queries, matching_queries, serving_queries, text_queries

MODULES = [matching_queries, text_queries, document_queries, geometry_queries, serving_queries, label_queries, audit_queries, list_queries]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: query for module in MODULES for name, query in module.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for module in MODULES for name, sql in module.ORACLES.items()}
