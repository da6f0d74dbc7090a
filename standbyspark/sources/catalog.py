"""Catalog relations from Spark schemas, from information_schema-shaped frames, and from inventories."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.names import is_reserved
from ..functions.types import PORTABLE, base_name, column_of
from ..model import Engine, Inventory, Table
from ..operators.portability import Catalog

COLUMNS = "table_name string, position int, column_name string, native_type string, portable_type string, precision int, scale int, length int, unsigned boolean, generated boolean, hidden boolean, collation string, default string, nullable boolean, in_key boolean"
TABLES = "table_name string, collation string, engine string, strict boolean"
INDEXES = "table_name string, index_name string, kind string, is_unique boolean, is_partial boolean, is_functional boolean"
INDEX_COLUMNS = "table_name string, index_name string, position int, column_name string, prefix_length int"
OBJECTS = "object_type string, object_name string"
FOREIGN_KEYS = "table_name string, constraint_name string, columns array<string>, referenced_table string, referenced_columns array<string>"


def table_of(name: str, df: DataFrame, key: Sequence[str] = ()) -> Table:
    """Describe a DataFrame; the key is declared, as Parquet has none."""
    return Table(name, tuple(column_of(f) for f in df.schema.fields), tuple(key))


def catalog_of(spark: SparkSession, inventory: Inventory) -> Catalog:
    """The catalog relations of an inventory."""
    t = inventory.tables
    columns = [(x.name, i, c.name, c.native, c.portable, c.precision, c.scale, c.length, c.unsigned, c.generated, c.hidden, c.collation, c.default, c.nullable, c.name in x.primary_key) for x in t for i, c in enumerate(x.columns, 1)]
    indexes = [(x.name, i.name, i.kind, i.unique, i.partial, i.functional) for x in t for i in x.indexes]
    parts = [(x.name, i.name, k, c.name, c.prefix_length) for x in t for i in x.indexes for k, c in enumerate(i.columns, 1)]
    return Catalog(
        spark.createDataFrame([(x.name, x.collation, x.engine, x.strict) for x in t], TABLES), spark.createDataFrame(columns, COLUMNS), spark.createDataFrame(indexes, INDEXES),
        spark.createDataFrame(parts, INDEX_COLUMNS), spark.createDataFrame([*inventory.objects], OBJECTS),
    )


def foreign_keys_of(spark: SparkSession, inventory: Inventory) -> DataFrame:
    return spark.createDataFrame([(t.name, f.name, list(f.columns), f.parent, list(f.parent_columns)) for t in inventory.tables for f in t.foreign_keys], FOREIGN_KEYS)


def portable_column(native: str = "DATA_TYPE"):
    """Portable type of a native type column, as an expression."""
    base = F.lower(F.trim(F.regexp_replace(native, r"(?s)\s*\(.*$", "")))
    out = F.lit("unknown")
    for portable, names in PORTABLE.items():
        out = F.when(base.isin(*names), portable).otherwise(out)
    return out


def in_scope(tables: DataFrame, name: str = "TABLE_NAME", prefix: str = "") -> DataFrame:
    """Tables under a prefix and outside the reserved names."""
    return tables.filter(F.col(name).startswith(prefix) & ~is_reserved(F.col(name)))


def information_schema_columns(tables: DataFrame, columns: DataFrame, prefix: str = "") -> DataFrame:
    """(table_name, position, column_name, native_type, portable_type, nullable) of in-scope base tables, prefix cut off.

    Columns of other tables are skipped (a semi join), as are generated ones' hidden helpers.
    """
    scope = in_scope(tables.filter(F.col("TABLE_TYPE") == "BASE TABLE"), prefix=prefix).select("TABLE_NAME")
    own = columns.join(scope, "TABLE_NAME", "left_semi")
    name = F.substring(F.col("TABLE_NAME"), len(prefix) + 1, 1 << 20)
    return own.select(name.alias("table_name"), F.col("ORDINAL_POSITION").cast("int").alias("position"), F.col("COLUMN_NAME").alias("column_name"), F.col("COLUMN_TYPE").alias("native_type"), portable_column("DATA_TYPE").alias("portable_type"), (F.col("IS_NULLABLE") == "YES").alias("nullable"))


def assembled_indexes(statistics: DataFrame) -> DataFrame:
    """(table_name, index_name, is_unique, columns): columns in sequence as name or name(prefix)."""
    part = F.concat(F.col("COLUMN_NAME"), F.coalesce(F.concat(F.lit("("), F.col("SUB_PART").cast("string"), F.lit(")")), F.lit("")))
    listed = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("SEQ_IN_INDEX", part.alias("part")))), lambda s: s.part), ",")
    return statistics.groupBy(F.col("TABLE_NAME").alias("table_name"), F.col("INDEX_NAME").alias("index_name")).agg((F.min("NON_UNIQUE") == 0).alias("is_unique"), listed.alias("columns"))


def assembled_foreign_keys(key_usage: DataFrame, constraints: DataFrame) -> DataFrame:
    """(table_name, constraint_name, columns, referenced_table, referenced_columns, on_update, on_delete)."""
    joined = key_usage.join(constraints.select("CONSTRAINT_NAME", "UPDATE_RULE", "DELETE_RULE"), "CONSTRAINT_NAME", "left").filter("REFERENCED_TABLE_NAME is not null")
    cols = F.array_sort(F.collect_list(F.struct("ORDINAL_POSITION", "COLUMN_NAME", "REFERENCED_COLUMN_NAME")))
    grouped = joined.groupBy(F.col("TABLE_NAME").alias("table_name"), F.col("CONSTRAINT_NAME").alias("constraint_name")).agg(cols.alias("c"), F.first("REFERENCED_TABLE_NAME").alias("referenced_table"), F.first("UPDATE_RULE").alias("on_update"), F.first("DELETE_RULE").alias("on_delete"))
    names = lambda field: F.array_join(F.transform("c", lambda s: s[field]), ",")
    return grouped.select("table_name", "constraint_name", names("COLUMN_NAME").alias("columns"), "referenced_table", names("REFERENCED_COLUMN_NAME").alias("referenced_columns"), "on_update", "on_delete")


class Registry:
    """Catalog readers by engine; the first that supports an engine reads."""

    def __init__(self, readers: Mapping[Engine, object]):
        self.readers = dict(readers)

    def inspect(self, engine: Engine, source: object) -> Inventory:
        if engine not in self.readers:
            raise LookupError(f"no catalog reader for {engine}")
        return self.readers[engine](source)


def native_base(native: str) -> str:
    return base_name(native)
