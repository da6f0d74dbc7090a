"""Canonical rows, row hashes and order-independent table digests.

A row is a JSON array with one entry per visible column: ``["null"]``, ``["integer","7"]``, ``["float","0.5"]``,
``["numeric","1.50"]``, or the portable type and the base64 of the bytes.  A table's digest is the sum of the rows'
SHA-256 values modulo 2^256, so it ignores order and counts duplicates.  Column names are not hashed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column as C
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..model import Column

LIMBS = 8


def _base64(value: C) -> C:
    text = F.base64(value)
    for line_end in ("\r", "\n"):
        text = F.replace(text, F.lit(line_end), F.lit(""))
    return F.replace(text, F.lit("/"), F.lit("\\/"))


def cell(column: Column, value: C | None = None) -> C:
    value = F.col(f"`{column.name}`") if value is None else value
    kind = column.portable
    if kind == "integer":
        text = F.concat(F.lit('["integer","'), value.cast("string"), F.lit('"]'))
    elif kind == "float":
        text = F.concat(F.lit('["float","'), value.cast("double").cast("string"), F.lit('"]'))
    elif kind == "numeric":
        text = F.concat(F.lit('["numeric","'), value.cast(f"decimal({min(column.precision or 18, 38)},{column.scale or 0})").cast("string"), F.lit('"]'))
    else:
        raw = value.cast("binary") if kind == "blob" else F.encode(value.cast("string"), "UTF-8")
        text = F.concat(F.lit(f'["{kind}","'), _base64(raw), F.lit('"]'))
    return F.coalesce(text, F.lit('["null"]'))


def row_text(columns: Sequence[Column]) -> C:
    return F.concat(F.lit("["), F.concat_ws(",", *(cell(c) for c in columns)), F.lit("]"))


def row_hash(columns: Sequence[Column]) -> C:
    return F.sha2(row_text(columns), 256)


def _limb(i: int) -> C:
    return F.conv(F.substring("h", 1 + 8 * i, 8), 16, 10).cast("long")


def digests(hashes: DataFrame, *keys: str) -> DataFrame:
    """(keys, row_count, digest) of ``hashes(keys, h)``; without keys one row, even of no rows.

    Sums are kept per leading byte first, so that 64-bit partial sums suffice for 2^39 rows, then as decimals.
    """
    partial = hashes.groupBy(*keys, F.substring("h", 1, 2).alias("lead")).agg(F.count("*").alias("n"), *(F.sum(_limb(i)).alias(f"s{i}") for i in range(LIMBS)))
    sums = partial.groupBy(*keys).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"), *(F.coalesce(F.sum(F.col(f"s{i}").cast("decimal(38,0)")), F.lit(0)).cast("decimal(38,0)").alias(f"s{i}") for i in range(LIMBS)))
    for i in range(LIMBS - 1, -1, -1):
        total = F.col(f"s{i}") if i == LIMBS - 1 else F.col(f"s{i}") + F.col(f"c{i + 1}")
        sums = sums.withColumn(f"t{i}", total.cast("decimal(38,0)")).withColumn(f"c{i}", F.expr(f"cast(t{i} div {1 << 32} as decimal(38,0))")).withColumn(f"d{i}", F.expr(f"cast(t{i} % {1 << 32} as bigint)"))
    text = F.concat(*(F.lpad(F.lower(F.hex(F.col(f"d{i}"))), 8, "0") for i in range(LIMBS)))
    return sums.select(*keys, F.col("row_count").cast("long").alias("row_count"), text.alias("digest"))


def table_digest(df: DataFrame, columns: Sequence[Column]) -> DataFrame:
    """(row_count, digest) of one table; an empty table has 64 zeros."""
    return digests(df.select(row_hash(columns).alias("h")))
