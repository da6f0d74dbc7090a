import sqlite3

import pytest

from standbyspark.model import Engine, NotPortable
from standbyspark.operators import portability as port
from standbyspark.sources import catalog, sqlite


@pytest.fixture
def path(tmp_path):
    file = tmp_path / "db.sqlite"
    db = sqlite3.connect(file)
    db.executescript("""
create table authors (id integer primary key autoincrement, name text default 'it''s portable', shout text generated always as (upper(name)) virtual);
create table editions (author_id integer not null, number integer not null, price numeric(8,2), cover blob, primary key (number, author_id), foreign key (author_id) references authors(id) on delete cascade) without rowid;
create unique index one_name on authors(name) where name <> '';
create index lower_name on authors(lower(name));
create table strict_items (id integer primary key, v text) strict;
create view shown as select 1;
create table standby_change_log (event_id integer primary key);
insert into authors(name) values ('Ä'), (null), ('');
insert into editions values (1, 1, 9.5, x'00ff'), (1, 2, null, null);
""")
    db.commit()
    db.close()
    return str(file)


def test_introspection(path):
    found = sqlite.inspect(path)
    assert [t.name for t in found.tables] == ["authors", "editions", "strict_items"] and found.objects == (("view", "shown"),)
    authors, editions, strict = found.tables
    assert authors.column("name").default == "it's portable" and authors.column("shout").generated and authors.column("id").auto_increment
    assert editions.primary_key == ("number", "author_id") and editions.foreign_keys[0].on_delete == "CASCADE" and strict.strict
    assert {i.name: (i.unique, i.partial, i.functional) for i in authors.indexes} == {"one_name": (True, True, False), "lower_name": (False, False, True)}
    assert sqlite.destination_objects(path + "x") == [] and "view: shown" in sqlite.destination_objects(path)


def test_rows_of_both_table_kinds(spark, path):
    got = sqlite.read_table(spark, path, "authors", 2).select("id", "name").orderBy("id").collect()
    assert [tuple(r) for r in got] == [(1, "Ä"), (2, None), (3, "")]
    rows = sqlite.read_table(spark, path, "editions").orderBy("number").collect()
    assert rows[0]["cover"] == b"\x00\xff" and str(rows[0]["price"]) == "9.50" and rows[1]["price"] is None


def test_gate_stops_on_generated_columns(spark, path):
    relations = catalog.catalog_of(spark, sqlite.inspect(path))
    codes = {r["code"] for r in port.issues(relations).collect()}
    assert {"generated_column", "partial_index", "functional_index", "unsupported_schema_object"} <= codes
    with pytest.raises(NotPortable):
        port.require_importable(relations, "mysql")


def test_information_schema_assembly(spark):
    stats = spark.createDataFrame([("t", "PRIMARY", 2, "b", None, 0), ("t", "PRIMARY", 1, "a", None, 0), ("t", "part", 1, "s", 16, 1)], "TABLE_NAME string, INDEX_NAME string, SEQ_IN_INDEX int, COLUMN_NAME string, SUB_PART int, NON_UNIQUE int")
    assert sorted(map(tuple, catalog.assembled_indexes(stats).collect())) == [("t", "PRIMARY", True, "a,b"), ("t", "part", False, "s(16)")]
    usage = spark.createDataFrame([("t", "f", 1, "a", "p", "x"), ("t", "PRIMARY", 1, "a", None, None), ("t", "f", 2, "b", "p", "y")], "TABLE_NAME string, CONSTRAINT_NAME string, ORDINAL_POSITION int, COLUMN_NAME string, REFERENCED_TABLE_NAME string, REFERENCED_COLUMN_NAME string")
    rules = spark.createDataFrame([("f", "RESTRICT", "CASCADE")], "CONSTRAINT_NAME string, UPDATE_RULE string, DELETE_RULE string")
    assert [tuple(r) for r in catalog.assembled_foreign_keys(usage, rules).collect()] == [("t", "f", "a,b", "p", "x,y", "RESTRICT", "CASCADE")]
    with pytest.raises(LookupError):
        catalog.Registry({}).inspect(Engine.MYSQL, None)
