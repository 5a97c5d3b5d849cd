"""Registered queries: a Spark plan and (where SQL can say it) a DuckDB oracle.

Every query reads the driver tables through the adapter, so its work grows
with them.  Computed columns carry the same alias on both sides, doubles are
rounded the same way on both sides, and every top-k breaks ties.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]


@dataclass
class Query:
    name: str
    fn: QueryFn
    sql: str | None
    ops: str


REGISTRY: dict[str, Query] = {}


def register(name: str, ops: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        REGISTRY[name] = Query(name, fn, sql, ops)
        return fn
    return deco


def load_all() -> dict[str, Query]:
    # Importing the query modules fills REGISTRY.
    from parcelle.plans import queries_core, queries_clean, queries_geo, queries_reports, queries_misc, queries_ml, queries_pages, queries_pipelines, queries_tables  # noqa: F401
    return REGISTRY
