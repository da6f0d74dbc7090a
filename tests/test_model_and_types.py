import pytest
from pyspark.sql import types as T

from standbyspark.functions import names, types
from standbyspark.model import Candidate, CandidateState, Column, Endpoint, Engine, ForeignKey, Index, IndexColumn, NameMap, NotPortable, Profile, Role, StandbyError, Table, Topology
from standbyspark.operators import ddl, policy
from standbyspark.operators.capture import identity_kind
from standbyspark.operators.fingerprint import schema_fingerprint, signature
from standbyspark.operators.reconcile import status_of
from standbyspark.model import Status


def ends(a="p", b="s", e=Engine.MYSQL, f=Engine.SQLITE, i="x", j="y"):
    return Endpoint(Role.PRIMARY, a, e, i), Endpoint(Role.STANDBY, b, f, j)


def test_topology_refuses_one_database_twice():
    assert Topology(*ends()).allows(Profile.CLEAN)
    assert not Topology(*ends(e=Engine.SQLITE, f=Engine.MYSQL)).allows(Profile.CLEAN)
    for wrong in (ends(b="p"), ends(f=Engine.MYSQL), ends(j="x")):
        with pytest.raises(StandbyError):
            Topology(*wrong)


def test_candidate_goes_through_its_states():
    c = Candidate("a", "b")
    for state in (CandidateState.BUILDING, CandidateState.BUILT, CandidateState.PUBLISHING):
        c = c.to(state)
    assert not c.publishable and Candidate("a", "b", CandidateState.PUBLISHING, True).publishable
    with pytest.raises(StandbyError):
        Candidate("a", "b").to(CandidateState.PUBLISHED)
    with pytest.raises(StandbyError):
        Candidate("a", "a")


def test_name_map():
    assert NameMap({"a": "b"}).target("a") == "b" and NameMap().target("z") == "z"
    with pytest.raises(ValueError):
        NameMap({"a": "x", "b": "x"})


@pytest.mark.parametrize(("declared", "kind"), [("INT8", "integer"), ("CHARINT", "integer"), ("MY CLOB", "text"), ("", "blob"), ("DOUBLE PRECISION", "float"), ("DECFLOAT", "float"), ("DECX", "numeric"), ("geometry", "unknown"), ("varchar(12)", "varchar")])
def test_sqlite_affinity(declared, kind):
    assert types.sqlite_portable(declared) == kind


def test_type_mapping_and_defaults():
    assert types.target_type(Column("a", "INTEGER", "integer"), Engine.MYSQL, Engine.SQLITE) == "BIGINT"
    assert types.target_type(Column("a", "int", "integer", unsigned=True), Engine.MYSQL) == "INT UNSIGNED"
    for bad in (Column("a", "enum('x')", "unknown"), Column("a", "numeric(30,2)", "numeric", precision=30, scale=2)):
        with pytest.raises(NotPortable):
            types.target_type(bad, Engine.SQLITE)
    assert types.default_value("integer", True, "NULL") is None and types.default_value("varchar", True, "'NULL'") == "'NULL'"
    assert types.spark_type(Column("a", "bigint unsigned", "integer", unsigned=True)) == T.DecimalType(20, 0)
    assert types.shape("decimal(12,4)", "numeric") == (None, 12, 4) and types.shape("numeric(9)", "numeric") == (None, 9, 0)
    assert types.compared_type("datetime", Engine.SQLITE) == "text" and types.compared_type("datetime", Engine.MYSQL) == "datetime"


def items():
    return Table("items", (Column("id", "int unsigned", "integer", False, unsigned=True, auto_increment=True), Column("name", "varchar(80)", "varchar", False, length=80, collation="utf8mb4_general_ci"), Column("weight", "decimal(8,2)", "numeric", precision=8, scale=2)), ("id",), (Index("by_name", (IndexColumn("name"),), unique=True),))


def test_sqlite_ddl_runs():
    import sqlite3

    db = sqlite3.connect(":memory:")
    for sql in ddl.schema_script(items(), Engine.SQLITE, Engine.MYSQL):
        db.execute(sql)
    db.execute("insert into items(id, name) values (7, 'a')")
    db.execute("insert into items(name) values ('b')")
    assert db.execute("select max(id) from items").fetchone() == (8,)
    with pytest.raises(sqlite3.IntegrityError):
        db.execute("insert into items(name) values ('A')")


def test_mysql_ddl_text():
    text = ddl.create_table(items(), Engine.MYSQL)
    assert "`id` INT UNSIGNED NOT NULL AUTO_INCREMENT" in text and "PRIMARY KEY (`id`)" in text and text.endswith("ENGINE=InnoDB DEFAULT CHARSET=utf8mb4")


def test_names_and_quotes():
    assert names.quoted('a"b', Engine.SQLITE) == '"a""b"' and names.literal("it's") == "'it''s'" and names.literal("1.5") == "1.5"
    assert len(names.index_name("t", "i", Engine.MYSQL)) == 4 + 24 and names.trigger_names("t")[0].endswith("_i")
    assert names.reserved("standby_cdc_x") and names.reserved("standbyc12345678_t") and not names.reserved("standbyx")


def test_policy():
    assert [policy.decide(Profile.CLEAN, t) for t in ("cache_x", "sessions", "queue")] == ["schema_only", "schema_only", "copy"]
    assert policy.decide(Profile.FULL, "cache_x") == "copy"


def test_identity_kind():
    col = lambda n, p: Column(n, p, p)
    assert identity_kind(Table("a", (col("id", "integer"), col("l", "varchar")), ("id", "l"))) == "primary_key"
    assert identity_kind(Table("a", (col("id", "blob"),), ("id",))) == "table" and identity_kind(Table("a", (col("x", "text"),))) == "table"


def test_fingerprint_ignores_index_order_and_names():
    a, b = Index("i", (IndexColumn("id"),)), Index("j", (IndexColumn("name"),), unique=True)
    t = lambda *x: Table("t", items().columns, ("id",), x)
    assert schema_fingerprint([t(a, b)]) == schema_fingerprint([t(b, a)]) != schema_fingerprint([t(a)])
    assert signature(t(a, b), Engine.SQLITE) == signature(t(b, a), Engine.SQLITE)


def test_status_order(spark):
    assert status_of(spark) is Status.MATCH and status_of(spark, manifest_missing=True) is Status.REBUILD_REQUIRED
    assert status_of(spark, objects=True, artifact_mismatch=True) is Status.DRIFT and status_of(spark, drift=True, integrity_failed=True) is Status.BLOCKED
    assert status_of(spark, manifest_failing=True) is Status.REBUILD_REQUIRED


def test_foreign_key_pairs():
    with pytest.raises(ValueError):
        ForeignKey("f", ("a",), "p", ())
