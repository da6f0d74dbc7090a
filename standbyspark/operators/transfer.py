"""Table transfer: projection, checks, byte metering and the batch ledger."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column as C
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..model import Column, StandbyError

BATCH_ROWS, BATCH_BYTES = 500, 4_194_304
MOST = 9_223_372_036_854_775_807


def row_bytes(columns: Sequence[str]) -> C:
    """Bytes of the values' text, nulls being none."""
    out = F.lit(0).cast("long")
    for c in columns:
        out = out + F.coalesce(F.octet_length(F.col(f"`{c}`").cast("string")), F.lit(0))
    return out


def projected(df: DataFrame, columns: Sequence[Column]) -> DataFrame:
    visible = [c.name for c in columns if not c.hidden]
    if not visible:
        raise StandbyError("no visible column")
    return df.select(*visible)


def overflows(value: C) -> C:
    """Whether a number is above what a signed 64-bit integer holds; text that is no number passes."""
    digits = value.cast("string").rlike("^[0-9]+$")
    stripped = F.ltrim(value.cast("string"), F.lit("0"))
    return F.coalesce(digits & ((F.length(stripped) > 19) | ((F.length(stripped) == 19) & (stripped > str(MOST)))), F.lit(False))


def batch_ledger(rows: DataFrame, order: str, most_rows: int = BATCH_ROWS, most_bytes: int = BATCH_BYTES, group: str | None = None) -> DataFrame:
    """(group, batch, rows, bytes, first_key, last_key) of ``rows(order, size)`` taken in order.

    A batch closes after the row that fills it by rows or by bytes.  The rule carries state from row to row, so a
    table's sizes (8 bytes a row, not the rows) pass one worker in order, streamed; many tables run side by side.
    """
    if most_rows < 1 or most_bytes < 1:
        raise StandbyError("batch bounds are at least 1")
    named = rows.select((F.col(group) if group else F.lit("")).alias("grp"), F.col(order).alias("k"), F.col("size").cast("long").alias("size"))

    def fold(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        grp, batch, n, total, first, last = None, 0, 0, 0, None, None
        for part in parts:
            out = []
            for g, k, size in zip(part["grp"], part["k"], part["size"], strict=True):
                if g != grp:
                    if n:
                        out.append((grp, batch, n, total, first, last))
                    grp, batch, n, total, first = g, 1, 0, 0, None
                first = k if first is None else first
                n, total, last = n + 1, total + size, k
                if n >= most_rows or total >= most_bytes:
                    out.append((grp, batch, n, total, first, last))
                    batch, n, total, first = batch + 1, 0, 0, None
            yield pd.DataFrame(out, columns=["grp", "batch", "n_rows", "n_bytes", "first_key", "last_key"])
        if n:
            yield pd.DataFrame([(grp, batch, n, total, first, last)], columns=["grp", "batch", "n_rows", "n_bytes", "first_key", "last_key"])

    kind = named.schema["k"].dataType.simpleString()
    ordered = named.repartition("grp").sortWithinPartitions("grp", "k")
    out = ordered.mapInPandas(fold, f"grp string, batch long, n_rows long, n_bytes long, first_key {kind}, last_key {kind}")
    return out.withColumnRenamed("grp", group) if group else out.drop("grp")
