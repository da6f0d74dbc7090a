"""Identifiers, derived object names and literals."""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import Column as C
from pyspark.sql import functions as F

from ..model import Engine

#: Name prefixes and widths of derived objects.
TRIGGER_PREFIX, LOG_TABLE = "standby_cdc_", "standby_change_log"
TRIGGER_HASH, MYSQL_INDEX_HASH, SQLITE_INDEX_HASH, ARCHIVE_HASH = 16, 24, 32, 40
RESERVED = (re.compile(r"^standby_(change_log|cdc_|snapshot_state)"), re.compile(r"^standby[cp][0-9a-f]{8}_"))


def sha256(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def quoted(name: str, engine: Engine) -> str:
    mark = "`" if engine is Engine.MYSQL else '"'
    return mark + name.replace(mark, mark * 2) + mark


def literal(value: str | None) -> str:
    """Numbers as they are, other text quoted."""
    if value is None:
        return "NULL"
    return value if re.fullmatch(r"-?\d+(\.\d+)?", value) else "'" + value.replace("'", "''") + "'"


def trigger_names(table: str) -> tuple[str, str, str]:
    stem = TRIGGER_PREFIX + sha256(table)[:TRIGGER_HASH]
    return stem + "_i", stem + "_u", stem + "_d"


def index_name(table: str, index: str, engine: Engine) -> str:
    width = MYSQL_INDEX_HASH if engine is Engine.MYSQL else SQLITE_INDEX_HASH
    return "idx_" + sha256(f"{table}\0{index}")[:width]


def reserved(name: str) -> bool:
    return any(p.search(name) for p in RESERVED)


def trigger_name(table: C, suffix: str) -> C:
    return F.concat(F.lit(TRIGGER_PREFIX), F.substring(F.sha2(table, 256), 1, TRIGGER_HASH), F.lit("_" + suffix))


def derived_index_name(table: C, index: C, width: int) -> C:
    joined = F.concat(F.encode(table, "UTF-8"), F.unhex(F.lit("00")), F.encode(index, "UTF-8"))
    return F.concat(F.lit("idx_"), F.substring(F.sha2(joined, 256), 1, width))


def is_reserved(name: C) -> C:
    out = F.lit(False)
    for pattern in RESERVED:
        out = out | name.rlike(pattern.pattern)
    return out
