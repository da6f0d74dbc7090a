"""Checks that stand in for the constraints Spark does not enforce."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..model import Table


def orphans(child: DataFrame, columns: Sequence[str], parent: DataFrame, parent_columns: Sequence[str]) -> DataFrame:
    """Child rows whose non-null foreign key has no parent."""
    there = parent.select(*(F.col(p).alias(c) for p, c in zip(parent_columns, columns, strict=True))).distinct()
    full = reduce(lambda a, b: a & b, (F.col(c).isNotNull() for c in columns))
    return child.filter(full).join(there, list(columns), "left_anti")


def unique_violations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(columns, n) of key values that occur more than once; nulls never clash."""
    full = reduce(lambda a, b: a & b, (F.col(c).isNotNull() for c in columns))
    return df.filter(full).groupBy(*columns).agg(F.count("*").alias("n")).filter("n > 1")


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, row_count) of all tables in one job."""
    parts = [df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count") for name, df in sorted(tables.items())]
    return reduce(DataFrame.unionByName, parts)


def schema_problems(expected: Table, actual: Table) -> list[str]:
    """What differs in visible column names (in order) or primary key."""
    out = []
    if [c.name for c in expected.visible] != [c.name for c in actual.visible]:
        out.append("columns")
    if expected.primary_key != actual.primary_key:
        out.append("primary_key")
    return out
