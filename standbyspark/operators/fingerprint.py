"""Schema fingerprints and signatures."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.types import compared_type
from ..model import Engine, Table


def schema_fingerprint(tables: Iterable[Table]) -> str:
    """SHA-256 over the tables in byte order of their names; indexes and foreign keys in no order of their own."""
    described = []
    for t in sorted(tables, key=lambda t: t.name.encode()):
        described.append({
            "name": t.name,
            "columns": [[c.name, c.portable, c.nullable, c.default, c.unsigned, c.length, c.precision, c.scale, c.auto_increment, c.generated] for c in t.columns],
            "primary_key": list(t.primary_key),
            "indexes": sorted([i.unique, i.kind, i.partial, i.predicate or "", [[c.name, c.prefix_length, c.expression, c.descending] for c in i.columns]] for i in t.indexes if not i.primary),
            "foreign_keys": sorted([list(f.columns), f.parent, list(f.parent_columns), f.on_update, f.on_delete] for f in t.foreign_keys),
        })
    return hashlib.sha256(json.dumps(described, sort_keys=True, separators=(",", ":")).encode()).hexdigest()


def signature(table: Table, target: Engine) -> tuple:
    """What both sides must agree on: ordered columns as the target reads them, key, and secondary indexes in any order."""
    columns = tuple((c.name, compared_type(c.portable, target), c.nullable and c.name not in table.primary_key) for c in table.visible)
    return columns, table.primary_key, tuple(sorted((i.unique, tuple(c.name for c in i.columns)) for i in table.indexes if not i.primary))


def signatures(columns: DataFrame, target: str) -> DataFrame:
    """(table_name, signature) from ``columns(table_name, position, column_name, portable_type, nullable, in_key)``."""
    kind = F.when(F.lit(target == "sqlite") & F.col("portable_type").isin("date", "datetime", "timestamp", "time"), "text").otherwise(F.col("portable_type"))
    null = F.when(F.col("nullable") & ~F.col("in_key"), "null").otherwise("not null")
    one = F.concat_ws(" ", "column_name", kind, null)
    return columns.groupBy("table_name").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("position", one.alias("text")))), lambda s: s.text), ", ").alias("signature"))
