"""Applying dirty keys: read the primary's current rows, then upsert or delete, as set operations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..model import StandbyError


def current_rows(dirty: DataFrame, primary: DataFrame, key: Sequence[str]) -> DataFrame:
    """(key, action, primary's other columns): upsert where the row exists, delete where it is gone."""
    found = dirty.select(*key).distinct().join(primary.withColumn("present", F.lit(True)), list(key), "left")
    return found.withColumn("action", F.when(F.col("present"), "upsert").otherwise("delete")).drop("present")


def applied(standby: DataFrame, current: DataFrame, key: Sequence[str]) -> DataFrame:
    """The standby after the batch; applying the same batch again changes nothing."""
    kept = standby.join(current.select(*key), list(key), "left_anti")
    return kept.unionByName(current.filter("action = 'upsert'").select(*standby.columns))


def replaced(source: DataFrame, standby: DataFrame) -> DataFrame:
    """The whole table anew, in the standby's column order; all visible columns must be there."""
    missing = set(standby.columns) - set(source.columns)
    if missing:
        raise StandbyError(f"the replacement lacks {sorted(missing)}")
    return source.select(*standby.columns)


def cleared(standby: DataFrame) -> DataFrame:
    return standby.limit(0)


def counters(identities: DataFrame, tables: DataFrame, actions: DataFrame) -> DataFrame:
    """One row of counts from identities(table_name, kind), tables(table_name, schema_only) and actions(action)."""
    whole = identities.filter("kind = 'table'").join(F.broadcast(tables), "table_name").agg(
        F.count_if(~F.col("schema_only")).alias("table_dirty"), F.count_if("schema_only").alias("policy_noops"), F.count("*").alias("table_reconciliations"))
    rows = actions.agg(F.count_if(F.col("action") == "upsert").alias("upserts"), F.count_if(F.col("action") == "delete").alias("deletes"))
    return whole.crossJoin(rows)


def fk_unsafe(dirty_tables: DataFrame, foreign_keys: DataFrame) -> DataFrame:
    """Tables that must not be replaced as a whole: they have foreign keys or others refer to them."""
    involved = foreign_keys.select("table_name").union(foreign_keys.select("referenced_table")).distinct()
    return dirty_tables.join(involved.toDF("table_name"), "table_name", "left_semi")
