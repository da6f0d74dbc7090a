"""Event reduction: the smallest set of identities to read again, with the exact ids they settle."""

from __future__ import annotations

from pyspark.sql import Column as C
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..model import StandbyError


def usable_keys(events: DataFrame) -> DataFrame:
    """(event columns, key): the current key unless deleted, the old key unless inserted; equal ones once."""
    current = F.when(F.col("operation") != "delete", F.col("key_json"))
    old = F.when(F.col("operation") != "insert", F.col("old_key_json"))
    keys = F.array_distinct(F.array_compact(F.array(current, old)))
    return events.withColumn("key", F.explode_outer(keys))


def canonical_key(key: C, columns: C) -> C:
    """Key JSON with its columns in the physical order of ``columns`` (an array) and values as text; null if a column is missing or one is too many."""
    parsed = F.from_json(key, "map<string,string>")
    right = F.array_sort(F.map_keys(parsed)) == F.array_sort(columns)
    ordered = F.map_from_arrays(columns, F.transform(columns, lambda c: F.element_at(parsed, c)))
    return F.when(right, F.to_json(ordered, {"ignoreNullFields": "false"}))


def dirty_identities(events: DataFrame, tables: DataFrame) -> DataFrame:
    """(table_name, kind, key, event_ids, first_event) from events and ``tables(table_name, key_columns, schema_only)``.

    key_columns is the ordered primary key, empty for a table without one.

    A table event, a table without key, or a table whose rows are not copied stands for the whole table and absorbs
    the row identities of that table.  An event of an unknown table or without usable key ends the batch.
    """
    known = events.join(F.broadcast(tables), "table_name", "left")
    whole = F.coalesce("schema_only", F.lit(False)) | (F.col("identity_kind") == "table") | (F.coalesce(F.size("key_columns"), F.lit(0)) == 0)
    rows = usable_keys(known.withColumn("whole", whole)).withColumn("key", F.when(~F.col("whole"), canonical_key(F.col("key"), F.col("key_columns"))))
    checked = rows.withColumn("key", F.when(F.col("schema_only").isNull(), F.raise_error(F.concat(F.lit("a rebuild is required: unknown table "), F.col("table_name")))).when(~F.col("whole") & F.col("key").isNull(), F.raise_error(F.concat(F.lit("no usable key in event "), F.col("event_id")))).otherwise(F.col("key")))
    # grouped by key first, so that a hot key or table does not gather its events in one place unreduced
    grouped = checked.groupBy("table_name", "key").agg(F.collect_set("event_id").alias("ids"), F.bool_or("whole").alias("whole"))
    tables_whole = grouped.groupBy("table_name").agg(F.bool_or("whole").alias("table_whole"))  # one row for each table of the inventory
    absorbed = grouped.join(F.broadcast(tables_whole), "table_name")
    merged = absorbed.withColumn("key", F.when(F.col("table_whole"), None).otherwise(F.col("key"))).groupBy("table_name", "key", "table_whole").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("ids")))).alias("event_ids"))
    return merged.select("table_name", F.when(F.col("table_whole"), "table").otherwise("primary_key").alias("kind"), "key", "event_ids", F.get("event_ids", F.lit(0)).alias("first_event"))


def require_tables(events: DataFrame, tables: DataFrame) -> None:
    unknown = [r[0] for r in events.join(tables, "table_name", "left_anti").select("table_name").distinct().limit(20).collect()]
    if unknown:
        raise StandbyError(f"events of unknown tables {unknown}: a rebuild is required")
