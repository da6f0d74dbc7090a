"""Portability rules over catalog relations, the import gate, and index bounding.

Catalog relations: ``tables(table_name, collation, engine, strict)``, ``columns(table_name, position, column_name,
native_type, portable_type, precision, scale, length, unsigned, generated, hidden, collation, default)``,
``indexes(table_name, index_name, kind, is_unique, is_partial, is_functional)``, ``index_columns(table_name,
index_name, position, column_name, prefix_length)`` and ``objects(object_type, object_name)``.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column as C
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..model import NotPortable

#: Type names and patterns that the rules look for.
ENUM_TYPES = ("enum", "set")
SPATIAL_TYPES = ("geometry", "point", "linestring", "polygon", "multipoint", "multilinestring", "multipolygon", "geometrycollection")
BACKEND_DEFAULT = r"(?i)\b(CURRENT_TIMESTAMP|CURRENT_DATE|CURRENT_TIME|NOW|UUID)\b|\w+\s*\("
INDEX_BYTES = 3000


@dataclass(frozen=True)
class Catalog:
    tables: DataFrame
    columns: DataFrame
    indexes: DataFrame
    index_columns: DataFrame
    objects: DataFrame


def _issue(rows: DataFrame, code: str, severity: str, table: C | None = None, column: C | None = None, name: C | None = None) -> DataFrame:
    none = F.lit(None).cast("string")
    return rows.select(F.lit(code).alias("code"), F.lit(severity).alias("severity"), (none if table is None else table).alias("table_name"), (none if column is None else column).alias("column_name"), (none if name is None else name).alias("object_name"))


def issues(catalog: Catalog) -> DataFrame:
    """(code, severity, table_name, column_name, object_name) of every finding."""
    base = F.lower(F.trim(F.regexp_replace("native_type", r"(?s)\s*\(.*$", "")))
    # at most one of the first four: what a column's type is
    kind = (
        F.when(base.isin(*ENUM_TYPES), "unsupported_type").when(base.isin(*SPATIAL_TYPES), "spatial_type").when(F.col("portable_type") == "unknown", "unknown_type")
        .when((F.col("portable_type") == "numeric") & (F.col("precision").isNull() | F.col("scale").isNull()), "numeric_mapping_incomplete")
    )
    found = F.array_compact(F.array(
        F.when(kind.isNotNull(), F.struct(kind.alias("code"), F.lit("error").alias("severity"))),
        *(F.when(test, F.struct(F.lit(code).alias("code"), F.lit(severity).alias("severity"))) for code, severity, test in (
            ("generated_column", "error", F.col("generated")), ("hidden_column", "error", F.col("hidden")), ("unsigned_semantics", "warning", F.col("unsigned")),
            ("column_collation", "warning", F.col("collation").isNotNull()), ("backend_default_expression", "error", F.col("default").rlike(BACKEND_DEFAULT))))))
    columns = catalog.columns.select("table_name", "column_name", F.inline(found)).select("code", "severity", "table_name", "column_name", F.lit(None).cast("string").alias("object_name"))
    t, i = F.col("table_name"), F.col("index_name")
    rest = [
        _issue(catalog.tables.filter("collation is not null"), "table_collation", "warning", t),
        _issue(catalog.indexes.filter("is_functional"), "functional_index", "error", t, name=i),
        _issue(catalog.indexes.filter(F.lower("kind").contains("fulltext")), "fulltext_index", "error", t, name=i),
        _issue(catalog.indexes.filter(F.lower("kind").contains("spatial")), "spatial_index", "error", t, name=i),
        _issue(catalog.indexes.filter("is_partial"), "partial_index", "warning", t, name=i),
        _issue(catalog.index_columns.filter("prefix_length is not null"), "prefix_index", "warning", t, F.col("column_name"), i),
        _issue(catalog.objects, "unsupported_schema_object", "error", name=F.concat("object_type", F.lit(":"), "object_name")),
    ]
    return reduce(DataFrame.unionByName, rest, columns)


def severity_counts(found: DataFrame) -> DataFrame:
    return found.groupBy("severity").agg(F.count("*").alias("n"))


#: The gate's checks in the order in which they stop an import.
GATE = ("portability_error", "hidden_or_generated", "unsupported_collation", "unique_prefix_index", "partial_index", "strict_table")


def gate_findings(catalog: Catalog, target: str) -> DataFrame:
    """(step, rule, table_name, detail) of all checks that fail for this target."""
    step = lambda rows, n, table, detail: rows.select(F.lit(n).alias("step"), F.lit(GATE[n - 1]).alias("rule"), table.alias("table_name"), detail.alias("detail"))
    t = F.col("table_name")
    parts = [
        step(issues(catalog).filter("severity = 'error'"), 1, F.coalesce(t, F.lit("")), F.concat_ws(":", "code", F.coalesce("column_name", "object_name"))),
        step(catalog.columns.filter("hidden or generated"), 2, t, F.col("column_name")),
        step(catalog.indexes.filter("is_partial"), 5, t, F.col("index_name")),
        step(catalog.tables.filter("strict"), 6, t, t),
    ]
    if target == "sqlite":
        odd = F.col("collation").isNotNull() & ~F.endswith("collation", F.lit("_ci")) & ~F.endswith("collation", F.lit("_bin"))
        prefixed = catalog.index_columns.filter("prefix_length is not null").select("table_name", "index_name").distinct()
        parts += [step(catalog.columns.filter(odd), 3, t, F.col("column_name")), step(catalog.indexes.filter("is_unique").join(prefixed, ["table_name", "index_name"], "left_semi"), 4, t, F.col("index_name"))]
    return reduce(DataFrame.unionByName, parts)


def first_failure(findings: DataFrame) -> DataFrame:
    return findings.agg(F.min_by(F.struct("step", "rule", "table_name", "detail"), F.struct("step", "table_name", "detail")).alias("f")).filter("f is not null").select("f.*")


def require_importable(catalog: Catalog, target: str) -> None:
    failed = first_failure(gate_findings(catalog, target)).collect()
    if failed:
        raise NotPortable(f"{failed[0]['rule']}: {failed[0]['table_name']} {failed[0]['detail']}")


def key_bytes(portable: C, length: C, precision: C, prefix: C) -> C:
    """Bytes that a column takes in an index key."""
    return (
        F.when(portable.isin("integer", "float", "datetime", "timestamp", "time"), 8).when(portable == "numeric", F.greatest(F.lit(8), F.coalesce(precision, F.lit(32)))).when(portable == "date", 4)
        .when(portable == "varchar", 4 * F.coalesce(prefix, length, F.lit(255))).otherwise(F.coalesce(4 * prefix, F.lit(65535)))
    )


def bounded_indexes(catalog: Catalog, most: int = INDEX_BYTES) -> DataFrame:
    """(table_name, index_name, total_bytes, status, prefixes): status is fits, shortened or too_long.

    A unique index over the bound is an error.  Another one is shortened from its last column backwards, string-like
    columns only, to what the other columns leave; an index that is still over the bound is an error.
    """
    sized = catalog.index_columns.join(catalog.columns.select("table_name", "column_name", "portable_type", "length", "precision"), ["table_name", "column_name"])
    sized = sized.withColumn("bytes", key_bytes(F.col("portable_type"), F.col("length"), F.col("precision"), F.col("prefix_length")).cast("int"))
    own = F.struct("position", "column_name", "bytes", F.col("portable_type").isin("varchar", "text", "blob").alias("texty"), F.coalesce("prefix_length", F.lit(0)).alias("prefix"))
    keys = sized.groupBy("table_name", "index_name").agg(F.sum("bytes").alias("total_bytes"), F.reverse(F.array_sort(F.collect_list(own))).alias("cols")).join(catalog.indexes.select("table_name", "index_name", "is_unique"), ["table_name", "index_name"])
    shorten = f"""aggregate(cols, struct(cast(total_bytes as bigint) as total, cast(array() as array<string>) as cut),
        (s, c) -> if(s.total > {most} and c.texty and ({most} - (s.total - c.bytes)) div 4 >= 1,
            struct(s.total - c.bytes + 4 * (({most} - (s.total - c.bytes)) div 4) as total, array_append(s.cut, concat(c.column_name, '(', ({most} - (s.total - c.bytes)) div 4, ')')) as cut),
            s))"""
    done = keys.withColumn("s", F.expr(shorten))
    status = F.when(F.col("total_bytes") <= most, "fits").when(F.col("is_unique"), "too_long").when(F.col("s.total") <= most, "shortened").otherwise("too_long")
    return done.withColumn("status", status).select("table_name", "index_name", "total_bytes", "status", F.when(F.col("status") == "shortened", F.array_join("s.cut", ",")).otherwise("").alias("prefixes"))
