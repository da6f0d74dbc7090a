"""Registry of the replication queries and their DuckDB equivalents."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import content, metadata, syncing

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = content.QUERIES | syncing.QUERIES | metadata.QUERIES
ORACLE_SQL: dict[str, str] = content.ORACLE_SQL | syncing.ORACLE_SQL | metadata.ORACLE_SQL
