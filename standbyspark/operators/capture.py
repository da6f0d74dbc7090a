"""The dirty-key event log: identity planning, pending events, backlog, acknowledgement and health."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..model import IdentityKind, StandbyError, Table

MAX_BATCH, DEFAULT_BATCH = 5000, 500
KEY_TYPES = ("integer", "varchar", "text")
LOG_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType(), False), T.StructField("table_name", T.StringType(), False), T.StructField("operation", T.StringType(), False),
    T.StructField("identity_kind", T.StringType(), False), T.StructField("key_json", T.StringType()), T.StructField("old_key_json", T.StringType()), T.StructField("captured_at", T.TimestampType()),
])


def identity_kind(table: Table) -> IdentityKind:
    """Rows are addressed by their key only if all of it is of a stable type."""
    kinds = [table.column(c).portable for c in table.primary_key]
    return IdentityKind.PRIMARY_KEY if kinds and all(k in KEY_TYPES for k in kinds) else IdentityKind.TABLE


def capture_plan(tables: DataFrame, key_columns: DataFrame) -> DataFrame:
    """(table_name, identity_kind, key_columns) from ``tables(table_name)`` and ``key_columns(table_name, position, column_name, portable_type)``."""
    keys = key_columns.groupBy("table_name").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("position", "column_name"))), lambda s: s.column_name), ",").alias("key_columns"), F.bool_and(F.col("portable_type").isin(*KEY_TYPES)).alias("stable"))
    kind = F.when(F.col("stable"), "primary_key").otherwise("table")
    return tables.join(keys, "table_name", "left").select("table_name", kind.alias("identity_kind"), F.when(F.col("stable"), F.col("key_columns")).otherwise("").alias("key_columns"))


def checked_limit(limit: int) -> int:
    if not 1 <= limit <= MAX_BATCH:
        raise StandbyError(f"a batch has 1 to {MAX_BATCH} events, not {limit}")
    return limit


def unacknowledged(log: DataFrame, acks: DataFrame) -> DataFrame:
    """Events whose own id has not been acknowledged; a lower id that shows up late is still pending."""
    return log.join(acks.select("event_id").distinct(), "event_id", "left_anti")


def pending(log: DataFrame, limit: int = DEFAULT_BATCH) -> DataFrame:
    """The first ``limit`` events by id (a top-k, not a sort of the log)."""
    return log.orderBy("event_id").limit(checked_limit(limit))


def backlog(log: DataFrame) -> DataFrame:
    return log.agg(F.count("*").alias("events"), F.min("event_id").alias("first_event_id"), F.max("event_id").alias("last_event_id"))


def acknowledgement(spark: SparkSession, event_ids: Iterable[int]) -> DataFrame:
    ids = sorted(set(event_ids))
    if ids and ids[0] < 1:
        raise StandbyError("event ids are at least 1")
    return spark.createDataFrame([(i,) for i in ids], "event_id long")


def capture_status(expected: DataFrame, installed: DataFrame, plan: DataFrame) -> DataFrame:
    """One row: tracked tables, expected and installed triggers (compared by name), table-dirty tables, healthy."""
    triggers = expected.join(installed.select("trigger_name", F.lit(1).alias("there")).distinct(), "trigger_name", "left").agg(F.count("*").alias("expected_triggers"), F.count("there").alias("installed_triggers"))
    tables = plan.agg(F.count("*").alias("tracked_tables"), F.count_if(F.col("identity_kind") == "table").alias("table_dirty_tables"))
    return tables.crossJoin(triggers).select("tracked_tables", "expected_triggers", "installed_triggers", "table_dirty_tables", (F.col("expected_triggers") == F.col("installed_triggers")).alias("healthy"))
