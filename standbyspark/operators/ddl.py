"""Rendered schema text for both targets; Spark holds the data, these texts document and recreate the schema."""

from __future__ import annotations

from ..functions.names import index_name, literal, quoted, sha256
from ..functions.types import default_value, target_type
from ..model import Column, Engine, Index, Table


def _column(column: Column, table: Table, target: Engine, source: Engine | None) -> str:
    key = table.primary_key == (column.name,)
    if target is Engine.SQLITE and key and column.auto_increment:
        return f"{quoted(column.name, target)} INTEGER PRIMARY KEY AUTOINCREMENT"
    parts = [quoted(column.name, target), target_type(column, target, source)]
    if target is Engine.SQLITE and column.collation:
        parts.append("COLLATE " + ("NOCASE" if column.collation.endswith("_ci") else "BINARY"))
    if not column.nullable or column.name in table.primary_key:
        parts.append("NOT NULL")
    if target is Engine.MYSQL and column.auto_increment:
        parts.append("AUTO_INCREMENT")
    default = default_value(column.portable, column.nullable, column.default)
    if default is not None and not (target is Engine.MYSQL and column.portable in ("text", "blob")):
        parts.append("DEFAULT " + literal(default))
    return " ".join(parts)


def create_table(table: Table, target: Engine, source: Engine | None = None) -> str:
    lines = [_column(c, table, target, source) for c in table.visible]
    own_key = target is Engine.SQLITE and any(c.auto_increment and table.primary_key == (c.name,) for c in table.columns)
    if table.primary_key and not own_key:
        lines.append("PRIMARY KEY (" + ", ".join(quoted(c, target) for c in table.primary_key) + ")")
    for fk in table.foreign_keys:
        name = quoted("fk_" + sha256(f"{table.name}\0{fk.name}")[:24], target)
        own, theirs = (", ".join(quoted(c, target) for c in names) for names in (fk.columns, fk.parent_columns))
        lines.append(f"CONSTRAINT {name} FOREIGN KEY ({own}) REFERENCES {quoted(fk.parent, target)} ({theirs}) ON UPDATE {fk.on_update} ON DELETE {fk.on_delete}")
    tail = " ENGINE=InnoDB DEFAULT CHARSET=utf8mb4" if target is Engine.MYSQL else ""
    return f"CREATE TABLE {quoted(table.name, target)} (" + ", ".join(lines) + ")" + tail


def create_index(table: Table, index: Index, target: Engine, prefixes: dict[str, int] | None = None) -> str:
    parts = []
    for c in index.columns:
        length = (prefixes or {}).get(c.name or "", c.prefix_length)
        parts.append(quoted(c.name or "", target) + (f"({length})" if length and target is Engine.MYSQL else "") + (" DESC" if c.descending else ""))
    unique = "UNIQUE " if index.unique else ""
    return f"CREATE {unique}INDEX {quoted(index_name(table.name, index.name, target), target)} ON {quoted(table.name, target)} (" + ", ".join(parts) + ")"


def schema_script(table: Table, target: Engine, source: Engine | None = None) -> list[str]:
    return [create_table(table, target, source), *(create_index(table, i, target) for i in table.indexes if not i.primary)]
