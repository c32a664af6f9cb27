"""Registry of named queries (Spark) and their DuckDB oracle SQL."""

from slotcast.catalog.registry import ORACLE, QUERIES, query

__all__ = ["ORACLE", "QUERIES", "query"]
