"""SQLite files: introspection through the driver's sqlite3, and rows through a Spark data source.

The data source splits a table by ranges of rowid (or reads it whole, WITHOUT ROWID), so each executor must reach
the file by the same path, as with any file source.
"""

from __future__ import annotations

import sqlite3
from collections.abc import Iterator, Sequence
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..functions.names import quoted, reserved
from ..functions.types import shape, spark_type, sqlite_portable
from ..model import Column, Engine, ForeignKey, Index, IndexColumn, Inventory, Table


def _open(path: str) -> sqlite3.Connection:
    if not Path(path).is_file():
        raise FileNotFoundError(path)
    connection = sqlite3.connect(f"file:{path}?mode=ro", uri=True)
    connection.row_factory = sqlite3.Row
    return connection


def _default(text: str | None) -> str | None:
    if text and len(text) > 1 and text[0] == text[-1] == "'":
        return text[1:-1].replace("''", "'")
    return text


def inspect(path: str) -> Inventory:
    """Tables, columns, indexes, foreign keys and other objects, without SQLite's own."""
    with _open(path) as db:
        rows = db.execute("select type, name, tbl_name, sql from sqlite_schema where substr(name, 1, 7) <> 'sqlite_' order by name").fetchall()
        lists = {r["name"]: r for r in db.execute("pragma table_list").fetchall()}
        tables = [_table(db, r["name"], r["sql"] or "", bool(lists[r["name"]]["strict"])) for r in rows if r["type"] == "table" and not reserved(r["name"])]
        objects = tuple((r["type"], r["name"]) for r in rows if r["type"] in ("view", "trigger") and not reserved(r["name"]))
    return Inventory(Engine.SQLITE, tuple(tables), objects)


def _table(db: sqlite3.Connection, name: str, sql: str, strict: bool) -> Table:
    literal = "'" + name.replace("'", "''") + "'"
    info = db.execute(f"pragma table_xinfo({literal})").fetchall()
    key = tuple(r["name"] for r in sorted((r for r in info if r["pk"]), key=lambda r: r["pk"]))
    columns = []
    for r in info:
        portable = sqlite_portable(r["type"])
        length, precision, scale = shape(r["type"], portable)
        columns.append(Column(r["name"], r["type"] or "BLOB", portable, not r["notnull"] and r["name"] not in key, _default(r["dflt_value"]), length=length, precision=precision, scale=scale, auto_increment="AUTOINCREMENT" in sql.upper() and key == (r["name"],), generated=r["hidden"] in (2, 3), hidden=r["hidden"] == 1))
    indexes = []
    for r in db.execute(f"pragma index_list({literal})").fetchall():
        parts = db.execute("pragma index_xinfo('" + r["name"].replace("'", "''") + "')").fetchall()
        made = db.execute("select sql from sqlite_schema where type = 'index' and name = ?", (r["name"],)).fetchone()
        text = (made["sql"] if made else None) or ""
        predicate = text.upper().partition(" WHERE ")[2] and text[text.upper().index(" WHERE ") + 7 :]
        indexes.append(Index(r["name"], tuple(IndexColumn(p["name"], expression=None if p["cid"] >= 0 else text, descending=bool(p["desc"])) for p in parts if p["key"]), bool(r["unique"]), r["origin"] == "pk", "btree", bool(r["partial"]), predicate or None))
    links: dict[int, list[sqlite3.Row]] = {}
    for r in db.execute(f"pragma foreign_key_list({literal})").fetchall():
        links.setdefault(r["id"], []).append(r)
    keys = tuple(ForeignKey(f"fk_{i}", tuple(r["from"] for r in rows), rows[0]["table"], tuple(r["to"] for r in rows), rows[0]["on_update"], rows[0]["on_delete"]) for i, rows in sorted((i, sorted(v, key=lambda r: r["seq"])) for i, v in links.items()))
    return Table(name, tuple(columns), key, tuple(indexes), keys, strict=strict)


def destination_objects(path: str) -> list[str]:
    """Every user object as ``type: name``; a missing file has none."""
    if not Path(path).exists():
        return []
    with _open(path) as db:
        return [f"{r['type']}: {r['name']}" for r in db.execute("select type, name from sqlite_schema where substr(name, 1, 7) <> 'sqlite_' order by type, name")]


class _Range(InputPartition):
    def __init__(self, lo: int | None, hi: int | None):
        self.lo, self.hi = lo, hi


class _Reader(DataSourceReader):
    def __init__(self, options: dict[str, str], schema: T.StructType):
        self.path, self.table, self.schema = options["path"], options["table"], schema
        self.parts = int(options.get("partitions", 8))

    def partitions(self) -> Sequence[InputPartition]:
        with _open(self.path) as db:
            try:
                lo, hi = db.execute(f"select min(rowid), max(rowid) from {quoted(self.table, Engine.SQLITE)}").fetchone()
            except sqlite3.OperationalError:  # WITHOUT ROWID
                return [_Range(None, None)]
        if lo is None:
            return [_Range(0, 0)]
        step = max(1, -(-(hi - lo + 1) // self.parts))
        return [_Range(a, min(a + step, hi + 1)) for a in range(lo, hi + 1, step)]

    def read(self, partition: _Range) -> Iterator[tuple]:
        names = ", ".join(quoted(f.name, Engine.SQLITE) for f in self.schema.fields)
        where = "" if partition.lo is None else f" where rowid >= {partition.lo} and rowid < {partition.hi}"
        kinds = [f.dataType for f in self.schema.fields]
        with _open(self.path) as db:
            for row in db.execute(f"select {names} from {quoted(self.table, Engine.SQLITE)}{where}"):
                yield tuple(_value(v, k) for v, k in zip(row, kinds, strict=True))


def _value(value: object, kind: T.DataType) -> object:
    if value is None:
        return None
    if isinstance(kind, T.BinaryType):
        return value if isinstance(value, bytes) else str(value).encode()
    if isinstance(kind, T.StringType):
        return value.decode() if isinstance(value, bytes) else str(value)
    if isinstance(kind, T.DecimalType):
        from decimal import Decimal

        return Decimal(str(value)).quantize(Decimal(1).scaleb(-kind.scale))
    return float(value) if isinstance(kind, T.DoubleType) else int(value)


class SqliteSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "standby_sqlite"

    def schema(self) -> T.StructType:
        table = inspect(self.options["path"]).table(self.options["table"])
        if table is None:
            raise LookupError(self.options["table"])
        fields = []
        for c in table.visible:
            kind = T.StringType() if c.portable in ("date", "datetime", "timestamp", "time") else T.LongType() if c.portable == "integer" else spark_type(c)
            fields.append(T.StructField(c.name, kind, c.nullable))
        return T.StructType(fields)

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return _Reader(self.options, schema)


def read_table(spark: SparkSession, path: str, table: str, partitions: int = 8) -> DataFrame:
    spark.dataSource.register(SqliteSource)
    return spark.read.format("standby_sqlite").options(path=path, table=table, partitions=partitions).load()
