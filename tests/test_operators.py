import base64
import hashlib
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from standbyspark.functions.encoding import row_text, table_digest
from standbyspark.model import Column, StandbyError
from standbyspark.operators import capture, diff, reduction, sync, transfer, validation

COLUMNS = (Column("id", "bigint", "integer"), Column("body", "blob", "blob"), Column("note", "text", "text"))


def rows(spark, data):
    return spark.createDataFrame(data, "id long, body binary, note string")


def by_hand(data):
    total = 0
    for i, body, note in data:
        cells = [f'["integer","{i}"]' if i is not None else '["null"]']
        for kind, v in (("blob", body), ("text", note.encode() if note is not None else None)):
            cells.append('["null"]' if v is None else f'["{kind}","' + base64.b64encode(v).decode().replace("/", "\\/") + '"]')
        total += int(hashlib.sha256(("[" + ",".join(cells) + "]").encode()).hexdigest(), 16)
    return format(total % (1 << 256), "064x")


def digest(spark, data):
    r = table_digest(rows(spark, data), COLUMNS).collect()
    return r[0]["row_count"], r[0]["digest"]


def test_digest_equals_hand_sum_in_any_order(spark):
    rng = random.Random(5)
    data = [(i if i % 9 else None, rng.randbytes(rng.randrange(120)) if i % 5 else None, "é/ü" * (i % 4) if i % 7 else None) for i in range(300)]
    shuffled = data[:]
    rng.shuffle(shuffled)
    assert digest(spark, data) == (300, by_hand(data)) == digest(spark, shuffled)
    assert digest(spark, data[:-1] + [data[0]]) != digest(spark, data)
    assert digest(spark, data + data)[1] == by_hand(data + data) != digest(spark, data)[1]


def test_empty_digest_and_null_is_not_empty(spark):
    assert digest(spark, []) == (0, "0" * 64)
    assert digest(spark, [(1, None, "")]) != digest(spark, [(1, b"", None)])
    assert rows(spark, [(1, b"a\x00b", "🙂")]).select(row_text(COLUMNS)).collect()[0][0] == '[["integer","1"],["blob","YQBi"],["text","8J+Zgg=="]]'


def log(spark, *events):
    return spark.createDataFrame([(*e, None)[:7] for e in events], "event_id long, table_name string, operation string, identity_kind string, key_json string, old_key_json string, captured_at timestamp")


TABLES = "table_name string, key_columns array<string>, schema_only boolean"


def reduced(spark, events, tables):
    found = reduction.dirty_identities(log(spark, *events), spark.createDataFrame(tables, TABLES)).collect()
    return sorted((r["table_name"], r["kind"], r["key"] or "", tuple(r["event_ids"])) for r in found)


def test_composite_keys_reduce_to_two_identities(spark):
    en, de = '{"langcode":"en","entity_id":1}', '{"entity_id":1,"langcode":"de"}'
    got = reduced(spark, [(12, "t", "update", "primary_key", en, de), (5, "t", "update", "primary_key", en, en)], [("t", ["entity_id", "langcode"], False)])
    assert got == [("t", "primary_key", '{"entity_id":"1","langcode":"de"}', (12,)), ("t", "primary_key", '{"entity_id":"1","langcode":"en"}', (5, 12))]


def test_table_identities_absorb_rows(spark):
    got = reduced(spark, [(8, "u", "insert", "table", None, None), (3, "u", "insert", "primary_key", '{"id":1}', None), (4, "k", "delete", "primary_key", None, '{"id":9}')], [("u", ["id"], False), ("k", ["id"], False)])
    assert got == [("k", "primary_key", '{"id":"9"}', (4,)), ("u", "table", "", (3, 8))]
    assert reduced(spark, [(2, "cache_default", "update", "primary_key", '{"cid":"a"}', '{"cid":"a"}'), (9, "cache_default", "insert", "primary_key", '{"cid":"b"}', None)], [("cache_default", ["cid"], True)]) == [("cache_default", "table", "", (2, 9))]


def test_wrong_keys_and_unknown_tables_end_the_batch(spark):
    for event, tables in (((1, "t", "insert", "primary_key", '{"x":1}', None), [("t", ["id"], False)]), ((1, "t", "insert", "primary_key", None, None), [("t", ["id"], False)]), ((1, "gone", "insert", "primary_key", '{"id":1}', None), [("t", ["id"], False)])):
        with pytest.raises(PySparkException):
            reduced(spark, [event], tables)
    with pytest.raises(StandbyError):
        reduction.require_tables(log(spark, (1, "gone", "insert", "primary_key", None, None)), spark.createDataFrame([("t", ["id"], False)], TABLES))


def test_pending_and_acks(spark):
    events = log(spark, *((i, "t", "insert", "primary_key", f'{{"id":{i}}}', None) for i in (7, 3, 9, 4)))
    assert [r[0] for r in capture.pending(events, 2).select("event_id").collect()] == [3, 4]
    left = capture.unacknowledged(events, capture.acknowledgement(spark, [9, 9, 3]))
    assert sorted(r[0] for r in left.select("event_id").collect()) == [4, 7]
    assert capture.backlog(events.limit(0)).collect()[0][:] == (0, None, None)
    assert capture.acknowledgement(spark, []).count() == 0
    for wrong in (0, 5001):
        with pytest.raises(StandbyError):
            capture.pending(events, wrong)
    with pytest.raises(StandbyError):
        capture.acknowledgement(spark, [0])


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.dictionaries(st.integers(0, 30), st.integers(0, 5), max_size=20), st.dictionaries(st.integers(0, 30), st.integers(0, 5), max_size=20))
def test_replayed_events_make_standby_equal(spark, before, after):
    make = lambda d: spark.createDataFrame([(k, v) for k, v in d.items()], "id long, v long")
    old, new = make(before), make(after)
    events = diff.snapshot_events(old, new, "t", ["id"], ["v"])
    dirty = reduction.usable_keys(events).select(F.get_json_object("key", "$.id").cast("long").alias("id")).distinct()
    current = sync.current_rows(dirty, new, ["id"])
    once = sync.applied(old, current, ["id"])
    twice = sync.applied(once, current, ["id"])
    expected = sorted(after.items())
    assert sorted(map(tuple, once.collect())) == expected == sorted(map(tuple, twice.collect()))


def test_batch_ledger_closes_after_the_filling_row(spark):
    sizes = spark.createDataFrame([("a", i, s) for i, s in enumerate([3, 5, 1, 1, 1, 9, 2])] + [("b", 1, 4), ("b", 2, 4)], "t string, k long, size long")
    got = sorted(map(tuple, transfer.batch_ledger(sizes, "k", 3, 8, group="t").collect()))
    assert got == [("a", 1, 2, 8, 0, 1), ("a", 2, 3, 3, 2, 4), ("a", 3, 1, 9, 5, 5), ("a", 4, 1, 2, 6, 6), ("b", 1, 2, 8, 1, 2)]
    assert transfer.batch_ledger(sizes.limit(0), "k", 3, 8).count() == 0


def test_overflow_compares_digits(spark):
    cases = ["9223372036854775807", "9223372036854775808", "0009223372036854775807", "18446744073709551615", "x9", None, ""]
    df = spark.createDataFrame([(c,) for c in cases], "v string")
    assert [r[0] for r in df.select(transfer.overflows(F.col("v"))).collect()] == [False, True, False, True, False, False, False]


def test_bytes_count_text_of_values(spark):
    df = spark.createDataFrame([(12, None, "é"), (None, b"\x00\xff", "")], "id long, body binary, note string")
    assert [r[0] for r in df.select(transfer.row_bytes(["id", "note"])).collect()] == [4, 0]


def test_constraint_checks(spark):
    child = spark.createDataFrame([(1, 1), (2, None), (3, 9)], "id long, p long")
    parent = spark.createDataFrame([(1,), (1,)], "id long")
    assert [r["id"] for r in validation.orphans(child, ["p"], parent, ["id"]).collect()] == [3]
    assert [tuple(r) for r in validation.unique_violations(parent, ["id"]).collect()] == [(1, 2)]


def test_diff_treats_null_as_a_value(spark):
    a, b = spark.createDataFrame([(1, None), (2, 5)], "id long, v long"), spark.createDataFrame([(1, None), (3, 5)], "id long, v long")
    assert sorted(map(tuple, diff.content_diff(a, b, ["id"], ["v"]).collect())) == [(1, "same"), (2, "missing"), (3, "extra")]
