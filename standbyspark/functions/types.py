"""The portable type lattice and its two targets."""

from __future__ import annotations

import re

from pyspark.sql import types as T

from ..model import Column, Engine, NotPortable

#: Native spellings of each portable type.
PORTABLE = {
    "integer": ("tinyint", "smallint", "mediumint", "int", "integer", "bigint", "boolean", "bool"),
    "varchar": ("char", "varchar", "nchar", "nvarchar"),
    "text": ("text", "tinytext", "mediumtext", "longtext", "clob"),
    "blob": ("binary", "varbinary", "blob", "tinyblob", "mediumblob", "longblob", "bytea"),
    "float": ("float", "double", "real"),
    "numeric": ("decimal", "numeric"),
    "date": ("date",),
    "datetime": ("datetime",),
    "timestamp": ("timestamp",),
    "time": ("time",),
}
#: Substrings of a declared SQLite type and the type they give, in order of precedence.
AFFINITY = (("INT", "integer"), ("CHAR", "text"), ("CLOB", "text"), ("TEXT", "text"), ("BLOB", "blob"), ("REAL", "float"), ("FLOA", "float"), ("DOUB", "float"), ("NUM", "numeric"), ("DEC", "numeric"))
_OF = {native: portable for portable, names in PORTABLE.items() for native in names}
_SHAPE = re.compile(r"\(\s*(\d+)\s*(?:,\s*(\d+)\s*)?\)")


def base_name(native: str) -> str:
    return re.sub(r"\s*\(.*$", "", native.strip().lower(), flags=re.DOTALL).removesuffix(" unsigned")


def portable_of(native: str) -> str:
    return _OF.get(base_name(native), "unknown")


def sqlite_portable(declared: str) -> str:
    """Exact names first, then SQLite's affinity rules; an unknown name stays as it is (and so is unknown)."""
    known = portable_of(declared)
    if known != "unknown":
        return known
    if not declared.strip():
        return "blob"
    return next((kind for part, kind in AFFINITY if part in declared.upper()), "unknown")


def shape(declared: str, portable: str) -> tuple[int | None, int | None, int | None]:
    """(length, precision, scale) as declared."""
    m = _SHAPE.search(declared)
    if not m:
        return None, None, None
    if portable == "numeric":
        return None, int(m[1]), int(m[2] or 0)
    return (int(m[1]), None, None) if portable in ("varchar", "blob") else (None, None, None)


def target_type(column: Column, target: Engine, source: Engine | None = None) -> str:
    """Declared type of a column at the target; raises NotPortable where there is none."""
    kind = column.portable
    if kind == "numeric":
        p, s = column.precision, column.scale
        most = 15 if target is Engine.SQLITE else 65
        if p is None or s is None or p < 1 or s < 0 or s > p or p > most:
            raise NotPortable(f"{column.name}: numeric({p},{s}) has no {target} type")
        return f"{'NUMERIC' if target is Engine.SQLITE else 'DECIMAL'}({p},{s})"
    if kind == "varchar":
        return f"VARCHAR({min(max(column.length or 255, 1), 65535)})"
    if target is Engine.SQLITE:
        plain = {"integer": "INTEGER", "text": "TEXT", "blob": "BLOB", "float": "REAL", "date": "TEXT", "datetime": "TEXT", "timestamp": "TEXT", "time": "TEXT"}
    else:
        base = base_name(column.native)
        if kind == "integer":
            name = base.upper() if base in ("tinyint", "smallint", "mediumint", "bigint") else "BIGINT" if source is Engine.SQLITE and base == "integer" else "INT"
            return name + (" UNSIGNED" if column.unsigned else "")
        plain = {"text": "LONGTEXT", "blob": "LONGBLOB", "float": "DOUBLE", "date": "DATE", "datetime": "DATETIME", "timestamp": "TIMESTAMP", "time": "TIME"}
    if kind not in plain:
        raise NotPortable(f"{column.name}: {column.native} has no portable type")
    return plain[kind]


def compared_type(portable: str, target: Engine) -> str:
    """The type by which two sides are compared: what the target reads back after the mapping."""
    return "text" if target is Engine.SQLITE and portable in ("date", "datetime", "timestamp", "time") else portable


def spark_type(column: Column) -> T.DataType:
    if column.portable == "integer":
        base = base_name(column.native)
        if column.unsigned and base in ("bigint", "integer"):
            return T.DecimalType(20, 0)
        return T.LongType() if column.unsigned else {"tinyint": T.ByteType(), "smallint": T.ShortType(), "mediumint": T.IntegerType(), "int": T.IntegerType()}.get(base, T.LongType())
    if column.portable == "numeric":
        if column.precision is None or column.precision > 38:
            raise NotPortable(f"{column.name}: decimals of over 38 digits cannot be held")
        return T.DecimalType(column.precision, column.scale or 0)
    kinds = {"varchar": T.StringType(), "text": T.StringType(), "time": T.StringType(), "blob": T.BinaryType(), "float": T.DoubleType(), "date": T.DateType(), "datetime": T.TimestampNTZType(), "timestamp": T.TimestampType()}
    if column.portable not in kinds:
        raise NotPortable(f"{column.name}: {column.native} cannot be held")
    return kinds[column.portable]


def column_of(field: T.StructField) -> Column:
    """Portable description of a Spark field; metadata may hold ``portable``, ``length`` and ``hidden``."""
    kind, meta = field.dataType, field.metadata or {}
    precision = scale = None
    if isinstance(kind, T.DecimalType):
        portable, native, precision, scale = "numeric", f"decimal({kind.precision},{kind.scale})", kind.precision, kind.scale
    else:
        names = {T.ByteType: "tinyint", T.ShortType: "smallint", T.IntegerType: "int", T.LongType: "bigint", T.BooleanType: "boolean", T.StringType: "text", T.BinaryType: "blob", T.FloatType: "float", T.DoubleType: "double", T.DateType: "date", T.TimestampNTZType: "datetime", T.TimestampType: "timestamp"}
        native = meta.get("native") or names.get(type(kind), kind.simpleString())
        portable = meta.get("portable") or portable_of(native)
    return Column(field.name, native, portable, field.nullable, precision=precision, scale=scale, length=meta.get("length"), hidden=bool(meta.get("hidden")))


def default_value(portable: str, nullable: bool, text: str | None) -> str | None:
    """A nullable scalar's default spelled NULL is no default; a varchar's stays the word."""
    if text is not None and nullable and portable != "varchar" and text.strip("'").upper() == "NULL":
        return None
    return text
