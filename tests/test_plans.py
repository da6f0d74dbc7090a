import json

import pytest

from standbyspark.model import Column, DestinationNotEmpty, Engine, ForeignKey, Inventory, NonEmptyPolicy, Profile, StandbyError, Status, SyncOutcome, Table
from standbyspark.operators.diff import snapshot_events
from standbyspark.plans import backup as backups
from standbyspark.plans.replicator import Replicator
from standbyspark.plans.store import Store, refuse_secrets
from standbyspark.streaming.runner import ChangeFeed, drain, start

ITEMS = Table("items", (Column("id", "bigint", "integer", False), Column("name", "text", "text")), ("id",))
CACHE = Table("cache_x", (Column("id", "bigint", "integer", False), Column("v", "text", "text")), ("id",))
NOTES = Table("notes", (Column("note", "text", "text"),))


def put(spark, store, items, cache=((1, "c"),), notes=(("n",), ("n",))):
    generation = store.new_generation()
    store.write(spark.createDataFrame(list(items), "id long, name string"), generation, "items")
    store.write(spark.createDataFrame(list(cache), "id long, v string"), generation, "cache_x")
    store.write(spark.createDataFrame(list(notes), "note string"), generation, "notes")
    store.seal(generation)
    store.publish(generation)


@pytest.fixture
def pair(spark, tmp_path):
    primary, standby = Store(tmp_path / "p", Engine.MYSQL, "primary"), Store(tmp_path / "s", Engine.SQLITE, "standby")
    put(spark, primary, [(1, "a"), (2, "b"), (3, None)])
    tables = tuple(Table(t.name, t.columns, t.primary_key, engine="InnoDB") for t in (ITEMS, CACHE, NOTES))
    return primary, standby, Inventory(Engine.MYSQL, tables)


def make(spark, pair, profile=Profile.FULL, **more):
    primary, standby, inventory = pair
    return Replicator(spark, primary, standby, inventory, profile, **more)


def items(spark, store):
    return sorted(map(tuple, store.read(spark, "items").collect()), key=str)


def events(spark, rows):
    return spark.createDataFrame(rows, "event_id long, table_name string, operation string, identity_kind string, key_json string, old_key_json string, captured_at timestamp")


def test_import_reconcile_and_refusal(spark, pair):
    r = make(spark, pair, Profile.CLEAN)
    r.import_()
    assert items(spark, r.standby) == items(spark, r.primary) and r.standby.read(spark, "cache_x").count() == 0
    assert r.reconcile()[0] is Status.MATCH and r.standby.manifest()["intentional_exclusions"] == ["cache_x"]
    with pytest.raises(DestinationNotEmpty):
        r.import_()
    put(spark, r.primary, [(1, "a"), (2, "changed"), (3, None)])
    status, rows = r.reconcile()
    assert status is Status.DRIFT and {x["table"]: x["issue"] for x in rows}["items"] == "content"
    r.import_(NonEmptyPolicy.CLEAR)
    assert r.reconcile()[0] is Status.MATCH


@pytest.mark.parametrize("point", ["after_candidate_create", "mid_row_transfer", "before_validation", "after_validation", "before_publish", "during_publish"])
def test_failed_rebuild_keeps_the_old_standby(spark, pair, point):
    r = make(spark, pair)
    old = r.import_()
    put(spark, r.primary, [(9, "z")])

    def fail(at):
        if at == point:
            raise RuntimeError(at)

    r.failpoint = fail
    with pytest.raises(RuntimeError):
        r.rebuild()
    assert r.standby.current() == old and [p.name for p in r.standby.generations.iterdir()] == [old]
    r.failpoint = lambda at: None
    assert r.rebuild() == r.standby.current() != old and items(spark, r.standby) == [(9, "z")]


def test_sync_applies_current_rows_and_replays(spark, pair, tmp_path):
    r = make(spark, pair)
    r.rebuild()
    put(spark, r.primary, [(1, "a"), (2, "B"), (4, "d")], notes=(("other",),))
    log = events(spark, [
        (11, "items", "update", "primary_key", '{"id":2}', '{"id":2}', None), (12, "items", "delete", "primary_key", None, '{"id":3}', None), (13, "items", "insert", "primary_key", '{"id":4}', None, None),
        (14, "notes", "insert", "table", None, None, None), (5, "items", "update", "primary_key", '{"id":2}', '{"id":2}', None),
    ])
    feed = ChangeFeed(spark, tmp_path / "feed")
    feed.append(log)
    with pytest.raises(StandbyError, match="capture"):
        drain(r, feed)
    assert feed.install(r.inventory) == feed.install(r.inventory) and feed.status(r.inventory)["healthy"]
    before = r.standby.current()
    r.failpoint = lambda at: (_ for _ in ()).throw(RuntimeError(at)) if at == "after_standby_commit_before_ack" else None
    with pytest.raises(RuntimeError):
        r.sync_once(feed.log(), feed.acks(), 2)
    assert r.standby.current() != before
    r.failpoint = lambda at: None
    done = drain(r, feed, limit=2)
    assert [d.outcome for d in done] == [SyncOutcome.MORE_PENDING, SyncOutcome.MORE_PENDING, SyncOutcome.CAUGHT_UP]
    assert items(spark, r.standby) == [(1, "a"), (2, "B"), (4, "d")] and [x[0] for x in r.standby.read(spark, "notes").collect()] == ["other"]
    assert sum(d.table_dirty for d in done) == 1 and drain(r, feed)[0].outcome is SyncOutcome.NO_WORK
    feed.append(events(spark, [(7, "items", "update", "primary_key", '{"id":1}', '{"id":1}', None)]))
    assert drain(r, feed)[0].events == 1  # a lower id that shows up late is still pending
    assert feed.log().count() == 0 and feed.acks().count() == 6  # settled batches are removed from the log


def test_a_batch_writes_only_the_buckets_of_its_keys(spark, pair):
    primary, standby, inventory = pair
    many = [(i, f"v{i}") for i in range(200)]
    put(spark, primary, many)
    r = make(spark, pair)
    first = r.rebuild()
    put(spark, primary, [(i, "new" if i == 7 else v) for i, v in many if i != 8])
    result, ids = r.sync_once(events(spark, [(1, "items", "update", "primary_key", '{"id":7}', '{"id":7}', None)]))
    second = standby.current()
    assert (result.upserts, ids) == (1, [1]) and second != first
    written = sorted(str(p.relative_to(standby.generations / second)) for p in (standby.generations / second).rglob("*.parquet"))
    assert written and len({w.rpartition("/")[0] for w in written}) == 1 and written[0].startswith("items/bucket=")
    assert items(spark, standby) == sorted([(i, "new" if i == 7 else v) for i, v in many], key=str)
    # the folders of the first generation stay as long as the second refers to them, its own changed bucket goes
    r.sync_once(events(spark, [(2, "items", "delete", "primary_key", None, '{"id":8}', None)]))
    standby.retain(1)
    assert items(spark, standby) == sorted([(i, "new" if i == 7 else v) for i, v in many if i != 8], key=str)
    live = {p for t in standby.tables() for p in standby.folders(standby.layout(t))}
    assert {str(p.parent) for p in standby.generations.rglob("*.parquet")} == live


def test_guards_of_a_sync(spark, pair):
    primary, standby, inventory = pair
    r = make(spark, pair)
    r.rebuild()
    log = events(spark, [(1, "items", "update", "primary_key", '{"id":1}', '{"id":1}', None)])
    r.inventory = Inventory(Engine.MYSQL, inventory.tables, (("view", "v"),))
    with pytest.raises(StandbyError, match="objects"):
        r.sync_once(log)
    r.inventory = inventory
    # the standby lost a column
    good = standby.current()
    generation = standby.new_generation()
    for t in standby.tables(good):
        standby.adopt(generation, t, standby.layout(t, good))
    (standby.generations / f"{generation}.partial" / "items.layout.json").unlink()
    standby.write(spark.createDataFrame([(1,)], "id long"), generation, "items")
    standby.seal(generation)
    standby.write_manifest(standby.manifest(good) | {"generation": generation})
    standby.publish(generation)
    with pytest.raises(StandbyError, match="standby's schema"):
        r.sync_once(log)
    status, rows = r.reconcile()
    assert status is Status.DRIFT and {x["table"]: x["issue"] for x in rows} == {"items": "schema", "cache_x": None, "notes": None}
    standby.publish(good)
    # the primary's schema moves while the batch is applied
    read = r._changed_buckets

    def moving(*args):
        out = read(*args)
        g = primary.new_generation()
        primary.write(spark.createDataFrame([(1, "a", 2)], "id long, name string, more long"), g, "items")
        for t in ("cache_x", "notes"):
            primary.adopt(g, t, primary.layout(t))
        primary.seal(g)
        primary.publish(g)
        return out

    r._changed_buckets = moving
    with pytest.raises(StandbyError, match="stay pending"):
        r.sync_once(log)
    assert standby.current() == good


def test_reconcile_without_a_standby_and_with_unsupported_columns(spark, pair):
    primary, standby, inventory = pair
    r = make(spark, pair)
    assert r.reconcile()[0] is Status.DRIFT and {x["issue"] for x in r.reconcile()[1]} == {"table_set"}
    r.rebuild()
    odd = Table("items", (ITEMS.columns[0], Column("name", "geometry", "unknown")), ("id",), engine="InnoDB")
    r.inventory = Inventory(Engine.MYSQL, (odd, *inventory.tables[1:]))
    assert r.reconcile()[0] is Status.BLOCKED


def test_sweep_removes_what_was_never_published(spark, pair):
    r = make(spark, pair)
    kept = r.rebuild()
    generation = r.standby.new_generation()
    r.standby.write(spark.createDataFrame([(1,)], "id long"), generation, "items")
    r.standby.seal(generation)
    assert r.standby.sweep() == [generation] and [p.name for p in r.standby.generations.iterdir()] == [kept]


def test_clearing_needs_the_standby(spark, pair):
    primary, standby, _ = pair
    r = make(spark, pair)
    r.rebuild()
    for wrong in (primary, Store(primary.root, Engine.SQLITE, "standby")):
        with pytest.raises(StandbyError, match="cleared"):
            backups.cleared(wrong, primary)
    backups.cleared(standby, primary)
    assert standby.tables() == []


def test_capture_text_and_archives(spark):
    from standbyspark.operators.capture_ddl import log_ddl, trigger_ddl

    made = trigger_ddl(ITEMS, Engine.SQLITE)
    assert len(made) == 3 and all("json_object('id'" in text for text in made.values())
    assert [t.count("NULL") for t in made.values()] == [1, 0, 1]
    assert all("json_object" not in t for t in trigger_ddl(NOTES, Engine.MYSQL).values()) and "AUTO_INCREMENT" in log_ddl(Engine.MYSQL)
    import sqlite3

    db = sqlite3.connect(":memory:")
    db.execute("create table items (id integer primary key, name text)")
    for text in (log_ddl(Engine.SQLITE), *made.values()):
        db.execute(text)
    db.execute("insert into items values (1, 'a')")
    db.execute("update items set id = 2")
    db.execute("delete from items")
    assert db.execute("select operation, identity_kind, key_json, old_key_json from change_log order by event_id").fetchall() == [("insert", "primary_key", '{"id":1}', None), ("update", "primary_key", '{"id":2}', '{"id":1}'), ("delete", "primary_key", None, '{"id":2}')]
    files = spark.createDataFrame([("old0000000a_x", 5), ("old0000000a_y", 7), ("old0000000b_x", 1), ("other", 9)], "table_name string, created_at long")
    got = {r["prefix"]: (r["tables"], r["created_at"]) for r in backups.archive_groups(files, r"^([a-z]+[0-9a-f]{8}_)").collect()}
    assert got == {"old0000000a_": (["old0000000a_x", "old0000000a_y"], 7), "old0000000b_": (["old0000000b_x"], 1)}


def test_reports_are_cut_off_with_a_count(spark):
    from standbyspark.cli import listed

    found = spark.createDataFrame([(f"c{i}", "warning", "t", f"a{i:02}", None) for i in range(23)], "code string, severity string, table_name string, column_name string, object_name string")
    lines = listed(found, 20)
    assert len(lines) == 21 and lines[0] == "WARNING: t.a00 c0" and lines[-1] == "... and 3 additional issues."
    assert len(listed(found)) == 23


def test_sync_needs_the_baseline(spark, pair):
    r = make(spark, pair)
    log = events(spark, [(1, "items", "insert", "primary_key", '{"id":1}', None, None)])
    with pytest.raises(StandbyError, match="rebuild"):
        r.sync_once(log)
    r.rebuild()
    r.inventory = Inventory(Engine.MYSQL, r.inventory.tables[:2])
    with pytest.raises(StandbyError, match="schema_fingerprint"):
        r.sync_once(log)


def test_tables_with_foreign_keys_are_not_replaced(spark, pair):
    primary, standby, inventory = pair
    linked = Table("notes", NOTES.columns, (), foreign_keys=(ForeignKey("f", ("note",), "items", ("name",)),), engine="InnoDB")
    put(spark, primary, [(1, "n")])
    r = make(spark, (primary, standby, Inventory(Engine.MYSQL, (*inventory.tables[:2], linked))))
    r.rebuild()
    with pytest.raises(StandbyError, match="foreign"):
        r.sync_once(events(spark, [(1, "notes", "insert", "table", None, None, None)]))


def test_duplicates_fail_integrity(spark, pair):
    r = make(spark, pair)
    put(spark, r.primary, [(1, "a"), (1, "b")])
    with pytest.raises(StandbyError, match="duplicate"):
        r.rebuild()


def test_streaming_drains_files(spark, pair, tmp_path):
    r = make(spark, pair)
    r.rebuild()
    old, new = r.primary.read(spark, "items"), [(1, "a"), (2, "b2"), (5, "e")]
    changes = snapshot_events(old, spark.createDataFrame(new, "id long, name string"), "items", ["id"], ["name"]).collect()
    put(spark, r.primary, new)
    arriving = tmp_path / "in"
    arriving.mkdir()
    (arriving / "1.json").write_text("".join(json.dumps({"event_id": i, **c.asDict()}) + "\n" for i, c in enumerate(changes, 1)))
    feed, results = ChangeFeed(spark, tmp_path / "feed"), []
    feed.install(r.inventory)
    query = start(r, feed, str(arriving), str(tmp_path / "checkpoint"), 2, results.extend)
    query.awaitTermination(120)
    assert query.exception() is None and items(spark, r.standby) == new and results[-1].outcome is SyncOutcome.CAUGHT_UP


def test_store_lock_retention_and_secrets(spark, pair, tmp_path):
    store = pair[0]
    for i in range(4):
        put(spark, store, [(i, "x")])
    gone = store.retain(2)
    assert len(gone) == 3 and store.current() not in gone and len(list(store.generations.iterdir())) == 2
    with store.locked("one"), pytest.raises(StandbyError, match="one is running"), store.locked("two"):
        pass
    with store.locked("three"):
        pass
    left = store.new_generation()
    assert store.sweep() == [left]
    with pytest.raises(StandbyError):
        store.discard(store.current())
    for bad in ({"password": 1}, {"a": [{"db_username": 1}]}):
        with pytest.raises(StandbyError):
            refuse_secrets(bad)


def test_backup_and_restore(spark, pair, tmp_path):
    store = pair[0]
    made = backups.backup(store, tmp_path / "private")
    backups.checked(made, Engine.MYSQL)
    before = items(spark, store)
    put(spark, store, [(8, "other")])
    backups.restore(spark, store, made.path, required=("items",), expected_sha256=made.sha256)
    assert items(spark, store) == before
    with pytest.raises(StandbyError, match="lacks"):
        backups.restore(spark, store, made.path, required=("users",))
    with pytest.raises(StandbyError, match="expected"):
        backups.restore(spark, store, made.path, expected_sha256="0" * 64)
    with pytest.raises(StandbyError, match="another engine"):
        backups.restore(spark, Store(tmp_path / "other", Engine.SQLITE), made.path)
    assert items(spark, store) == before
    made.path.write_bytes(made.path.read_bytes()[:-10])
    with pytest.raises(StandbyError):
        backups.checked(made, Engine.MYSQL)
    open_dir = tmp_path / "open"
    open_dir.mkdir(mode=0o755)
    with pytest.raises(StandbyError):
        backups.backup(store, open_dir)


def test_cli(spark, pair, tmp_path, capsys):
    from standbyspark.cli import main

    primary, standby, _ = pair
    config = tmp_path / "c.json"
    config.write_text(json.dumps({"primary": {"root": str(primary.root), "engine": "mysql"}, "standby": {"root": str(standby.root), "engine": "sqlite"}, "tables": {"items": {"key": ["id"]}, "cache_x": {"key": ["id"]}}}))
    run = lambda *a: main([*a, "--config", str(config)])
    assert run("doctor") == 0 and run("preflight") == 0 and run("reconcile") == 1
    assert run("import") == 0 and run("reconcile") == 0 and run("import") == 1 and run("preflight") == 1
    assert "not empty" in capsys.readouterr().err
    assert run("capture:status") == 1 and run("sync", "--once") == 1 and run("capture:install") == 0 and run("capture:status") == 0
    assert run("backup") == 0 and run("restore") == 2 and run("sync", "--once", "--limit", "9999") == 2 and run("sync", "--once") == 0 and run("nonsense") == 2
