"""Query registry: each entry pairs a Spark plan ``(spark, sf_dir) -> DataFrame`` with its DuckDB oracle SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass
class Query:
    name: str
    plan: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    note: str = ""


REGISTRY: dict[str, Query] = {}


def query(name: str, sql: str | None = None, note: str = ""):
    """Register a Spark plan under ``name``; ``sql`` is the oracle (None = rows-only check)."""
    def deco(fn):
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Query(name, fn, sql, note)
        return fn
    return deco
