"""Query registry: one Spark callable and (when SQL can express it) one
DuckDB oracle string per query key of the operator inventory."""

from __future__ import annotations

import importlib
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Query:
    key: str
    fn: Callable[[SparkSession, str], DataFrame]
    sql: str | None


REGISTRY: dict[str, Query] = {}

_MODULES = (
    "feature_store", "relational", "aggregates", "windowed", "sensors", "quality",
    "analytics", "fits", "text", "io", "streams", "properties",
)


def query(key: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``key``."""

    def deco(fn):
        if key in REGISTRY:
            raise ValueError(f"duplicate query key {key}")
        REGISTRY[key] = Query(key, fn, sql.strip() if sql else None)
        return fn

    return deco


def load_all() -> dict[str, Query]:
    for m in _MODULES:
        try:
            importlib.import_module(f"mlframe.plans.{m}")
        except ModuleNotFoundError as e:
            if e.name != f"mlframe.plans.{m}":
                raise
    return REGISTRY
