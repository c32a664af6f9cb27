"""``@query(key, sql)`` registers a Spark query and its oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def query(key: str, sql: str | None = None):
    def register(fn: QueryFn) -> QueryFn:
        if key in QUERIES:
            raise ValueError(f"duplicate query key {key}")
        QUERIES[key] = fn
        if sql is not None:
            ORACLE[key] = sql.strip()
        return fn

    return register


def load_all() -> None:
    """Import every module that registers queries."""
    from slotcast.catalog import (  # noqa: F401
        q_drift,
        q_export,
        q_models,
        q_relational,
        q_series,
        q_stream,
        q_windows,
    )
