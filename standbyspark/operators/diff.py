"""Row-level comparison of a primary table with its standby copy."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def content_diff(primary: DataFrame, standby: DataFrame, key: Sequence[str], values: Sequence[str]) -> DataFrame:
    """(key, status) with status same, changed, missing (from the standby) or extra; one shuffle of each side by key."""
    left = primary.select(*key, F.struct(*values).alias("p"))
    right = standby.select(*key, F.struct(*values).alias("s"))
    same = F.col("p").eqNullSafe(F.col("s"))
    status = F.when(F.col("s").isNull(), "missing").when(F.col("p").isNull(), "extra").when(same, "same").otherwise("changed")
    return left.join(right, list(key), "full_outer").select(*key, status.alias("status"))


def diff_counts(diff: DataFrame) -> DataFrame:
    return diff.groupBy("status").agg(F.count("*").alias("n"))


def snapshot_events(before: DataFrame, after: DataFrame, table: str, key: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Dirty-key events that lead from one version of a table to the next, without ids: stands in for triggers.

    A changed key shows as a delete and an insert.
    """
    diff = content_diff(after, before, key, values).filter("status <> 'same'")
    operation = F.when(F.col("status") == "missing", "insert").when(F.col("status") == "extra", "delete").otherwise("update")
    own = F.to_json(F.struct(*key), {"ignoreNullFields": "false"})
    return diff.select(
        F.lit(table).alias("table_name"), operation.alias("operation"), F.lit("primary_key").alias("identity_kind"),
        F.when(operation != "delete", own).alias("key_json"), F.when(operation != "insert", own).alias("old_key_json"),
    )
