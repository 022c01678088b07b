"""Registered queries: one per operator key of the survey, with its oracle SQL.

Each query takes ``(spark, sf_dir)``, reads the ledger derived from that
directory's tables, and returns a DataFrame over the whole data; parameters are
fixed so that every run is comparable.  The oracle statement (DuckDB) derives
everything again from the raw tables and must give the same rows.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..oracle import with_ctes


@dataclass
class Query:
    key: str
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


REGISTRY: dict[str, Query] = {}


def register(key: str, sql: str | None = None, extra_ctes=None):
    """Register ``fn(spark, sf_dir)`` under ``key`` with its oracle SQL body."""
    if key in REGISTRY:
        raise ValueError(f"duplicate query key {key!r}")

    def deco(fn):
        REGISTRY[key] = Query(key, fn, with_ctes(sql, extra_ctes) if sql is not None else None)
        return fn
    return deco


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: q.run for k, q in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    return {k: q.sql for k, q in REGISTRY.items() if q.sql is not None}


from . import statements, operators, quality, ingest, streaming, forecast  # noqa: E402,F401  (registration side effects)
