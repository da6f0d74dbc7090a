"""Text of the change log and its triggers, for databases that have triggers."""

from __future__ import annotations

from ..functions.names import quoted, trigger_names
from ..model import Engine, IdentityKind, Table
from .capture import identity_kind

LOG_TABLE = "change_log"
OPERATIONS = ("insert", "update", "delete")
_ID = {Engine.SQLITE: "INTEGER PRIMARY KEY AUTOINCREMENT", Engine.MYSQL: "BIGINT UNSIGNED AUTO_INCREMENT PRIMARY KEY"}
_TEXT = {Engine.SQLITE: ("TEXT", "TEXT", "TEXT"), Engine.MYSQL: ("VARCHAR(64)", "VARCHAR(16)", "LONGTEXT")}
_NOW = {Engine.SQLITE: "TEXT NOT NULL DEFAULT (strftime('%Y-%m-%dT%H:%M:%fZ','now'))", Engine.MYSQL: "TIMESTAMP(6) NOT NULL DEFAULT CURRENT_TIMESTAMP(6)"}


def log_ddl(engine: Engine) -> str:
    name, word, text = _TEXT[engine]
    columns = {
        "event_id": _ID[engine], "table_name": f"{name} NOT NULL", "operation": f"{word} NOT NULL CHECK (operation IN ('insert','update','delete'))",
        "identity_kind": f"{word} NOT NULL CHECK (identity_kind IN ('primary_key','table'))", "key_json": f"{text} NULL", "old_key_json": f"{text} NULL", "captured_at": _NOW[engine],
    }
    body = ", ".join(f"{column} {kind}" for column, kind in columns.items())
    return f"CREATE TABLE IF NOT EXISTS {quoted(LOG_TABLE, engine)} ({body})"


def trigger_ddl(table: Table, engine: Engine) -> dict[str, str]:
    """Name and text of the three triggers of a table: each logs the row's key before and after the change, or only the table."""
    kind, out = identity_kind(table), {}
    quote = lambda text: "'" + text.replace("'", "''") + "'"
    for name, operation in zip(trigger_names(table.name), OPERATIONS, strict=True):
        keys = []
        for row, absent in (("NEW", "delete"), ("OLD", "insert")):
            pairs = ", ".join(f"{quote(c)}, {row}.{quoted(c, engine)}" for c in table.primary_key)
            keys.append("NULL" if kind is IdentityKind.TABLE or operation == absent else f"json_object({pairs})")
        values = ", ".join([quote(table.name), quote(operation), quote(str(kind)), *keys])
        insert = f"INSERT INTO {quoted(LOG_TABLE, engine)} (table_name, operation, identity_kind, key_json, old_key_json) VALUES ({values})"
        body = f"BEGIN {insert}; END" if engine is Engine.SQLITE else f"FOR EACH ROW {insert}"
        out[name] = f"CREATE TRIGGER {quoted(name, engine)} AFTER {operation.upper()} ON {quoted(table.name, engine)} {body}"
    return out


