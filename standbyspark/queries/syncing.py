"""Change capture and synchronisation queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import capture, reduction, sync
from ..operators.transfer import batch_ledger, row_bytes
from . import fixtures as fx
from .fixtures import table

LIMIT = 500
_INVENTORY = "table_name string, key_columns array<string>, schema_only boolean"


def _id_text():
    return F.array_join(F.transform("event_ids", lambda x: x.cast("string")), ",").alias("event_ids")


def q09_canonical_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    users = reduction.usable_keys(fx.user_log(spark, sf_dir)).select("event_id", F.lit("users").alias("table_name"), reduction.canonical_key(F.col("key"), F.array(F.lit("id"))).alias("key"))
    talks = table(spark, sf_dir, "conversations").select(F.to_json(F.struct("turn", "conv_id"), {"ignoreNullFields": "false"}).alias("key"), (F.col("conv_id") * 1000 + F.col("turn")).alias("event_id"))
    named = reduction.canonical_key(F.col("key"), F.array(F.lit("conv_id"), F.lit("turn")))
    return users.unionByName(talks.select("event_id", F.lit("conversations").alias("table_name"), named.alias("key")))


def q10_dirty_identities(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = spark.createDataFrame([("users", ["id"], False)], _INVENTORY)
    return reduction.dirty_identities(fx.user_log(spark, sf_dir), tables).select("table_name", "kind", "key", _id_text())


def q11_table_absorption(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table event absorbs the rows of accounts; cache_users is not copied, so it is one identity."""
    tables = spark.createDataFrame([("users", ["id"], False), ("accounts", ["id"], False), ("cache_users", ["id"], True)], _INVENTORY)
    name = F.element_at(F.array(F.lit("users"), F.lit("accounts"), F.lit("cache_users")), (F.col("user_id") % 3 + 1).cast("int"))
    users = table(spark, sf_dir, "events").select("event_id", "user_id")
    log = fx.user_log(spark, sf_dir).drop("table_name").join(users, "event_id").withColumn("table_name", name).withColumn("identity_kind", F.when((F.col("table_name") == "accounts") & (F.col("event_id") % 50 == 0), "table").otherwise("primary_key"))
    found = reduction.dirty_identities(log, tables)
    return found.select("table_name", "kind", "key", F.size("event_ids").cast("long").alias("n_events"), "first_event")


def q12_sync_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    dirty = capture.pending(fx.repair_log(spark, sf_dir), LIMIT).select(F.col("k").alias("o_orderkey")).distinct()
    current = sync.current_rows(dirty, fx.primary_orders(spark, sf_dir), ["o_orderkey"])
    return sync.applied(fx.standby_orders(spark, sf_dir), current, ["o_orderkey"])


def q13_batch_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    sizes = table(spark, sf_dir, "documents").select("doc_id", row_bytes(["doc_id", "text"]).alias("size"))
    return batch_ledger(sizes, "doc_id", 500, 40_000)


def q14_pending_top_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    return capture.pending(fx.repair_log(spark, sf_dir), LIMIT)


def q15_backlog(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = fx.repair_log(spark, sf_dir)
    full = capture.backlog(log).select(F.lit("all").alias("log"), "*")
    return full.unionByName(capture.backlog(log.filter("event_id < 0")).select(F.lit("none").alias("log"), "*"))


def q16_exact_ack(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = fx.repair_log(spark, sf_dir)
    return capture.unacknowledged(log, log.filter("event_id % 5 = 0").select("event_id")).select("event_id", "operation")


PLAN_TABLES = [("orders",), ("conversations",), ("lineitem",), ("blobs",), ("labels",)]
PLAN_KEYS = [("orders", 1, "o_orderkey", "integer"), ("conversations", 2, "turn", "integer"), ("conversations", 1, "conv_id", "integer"), ("blobs", 1, "id", "blob"), ("labels", 1, "doc_id", "varchar"), ("labels", 2, "scored_at", "datetime")]
_TABLES, _KEYS = "table_name string", "table_name string, position int, column_name string, portable_type string"


def _plan(spark: SparkSession) -> DataFrame:
    return capture.capture_plan(spark.createDataFrame(PLAN_TABLES, _TABLES), spark.createDataFrame(PLAN_KEYS, _KEYS))


def q17_capture_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plan(spark)


def q18_capture_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three triggers are expected of each table; those of labels are not installed, and a foreign one is."""
    from ..functions.names import trigger_name

    expected = _plan(spark).select(F.explode(F.array(*(trigger_name(F.col("table_name"), x) for x in "iud"))).alias("trigger_name"))
    gone = spark.createDataFrame([("labels",)], _TABLES).select(F.explode(F.array(*(trigger_name(F.col("table_name"), x) for x in "iud"))).alias("trigger_name"))
    there = expected.join(gone, "trigger_name", "left_anti").unionByName(spark.createDataFrame([("someone_elses",)], "trigger_name string"))
    return capture.capture_status(expected, there, _plan(spark))


def q34_sync_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    dirty = capture.pending(fx.repair_log(spark, sf_dir), LIMIT).select(F.col("k").alias("o_orderkey")).distinct()
    actions = sync.current_rows(dirty, fx.primary_orders(spark, sf_dir), ["o_orderkey"]).select("action")
    identities = spark.createDataFrame([("lineitem", "table"), ("cache_pages", "table"), ("sessions", "table"), ("orders", "primary_key")], "table_name string, kind string")
    tables = spark.createDataFrame([("lineitem", False), ("cache_pages", True), ("sessions", True), ("orders", False)], "table_name string, schema_only boolean")
    return sync.counters(identities, tables, actions)


def q35_table_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = table(spark, sf_dir, "lineitem")
    done = sync.replaced(source, source.filter("l_orderkey % 10 <> 0").select("l_orderkey", "l_returnflag", "l_linestatus", "l_quantity"))
    return done.groupBy("l_returnflag", "l_linestatus").agg(F.count("*").alias("n"), F.sum(F.col("l_quantity").cast("decimal(18,2)")).cast("decimal(18,2)").alias("sum_quantity"))


QUERIES = {f.__name__: f for f in (q09_canonical_keys, q10_dirty_identities, q11_table_absorption, q12_sync_apply, q13_batch_ledger, q14_pending_top_n, q15_backlog, q16_exact_ack, q17_capture_plan, q18_capture_status, q34_sync_counters, q35_table_replace)}

_KEYS_SQL = """keys as (select event_id, regexp_replace(k, ':([0-9]+)', ':"\\1"') as key from (
  select event_id, case when operation <> 'delete' then key_json end as k from user_log
  union select event_id, case when operation <> 'insert' then old_key_json end from user_log) where k is not null)"""
_DIRTY_SQL = f"""{fx.REPAIR_SQL}, {fx.STANDBY_SQL}, dirty as (select distinct k from log_orders where event_id <= {LIMIT})"""

ORACLE_SQL = {
    "q09_canonical_keys": f"""with {fx.USER_LOG_SQL}, {_KEYS_SQL}
select event_id, 'users' as table_name, key from keys
union all select conv_id*1000+turn, 'conversations', '{{"conv_id":"'||conv_id||'","turn":"'||turn||'"}}' from conversations""",
    "q10_dirty_identities": f"""with {fx.USER_LOG_SQL}, {_KEYS_SQL}
select 'users' as table_name, 'primary_key' as kind, key, array_to_string(list_transform(list_sort(list_distinct(list(event_id))), lambda x: cast(x as varchar)), ',') as event_ids from keys group by key""",
    "q11_table_absorption": f"""with {fx.USER_LOG_SQL}, {_KEYS_SQL}, u as (select event_id, case user_id%3 when 0 then 'users' when 1 then 'accounts' else 'cache_users' end as t from events),
whole as (select distinct t from u where t = 'cache_users' or (t = 'accounts' and event_id%50=0)),
n as (select u.t, case when w.t is null then k.key end as key, w.t is not null as whole, u.event_id from u join keys k using (event_id) left join whole w on w.t = u.t)
select t as table_name, case when whole then 'table' else 'primary_key' end as kind, key, count(distinct event_id) as n_events, min(event_id) as first_event from n group by t, key, whole""",
    "q12_sync_apply": f"""with {_DIRTY_SQL}
select * from standby where o_orderkey not in (select k from dirty) union all select o_orderkey, o_custkey, o_totalprice from orders where o_orderkey in (select k from dirty)""",
    "q13_batch_ledger": """with recursive d as (select doc_id, octet_length(encode(text)) + length(cast(doc_id as varchar)) as size, row_number() over (order by doc_id) as rn from documents),
f as (select rn, doc_id, 1 as batch, 1 as n, size as total from d where rn = 1
 union all select d.rn, d.doc_id, case when f.n >= 500 or f.total >= 40000 then f.batch + 1 else f.batch end, case when f.n >= 500 or f.total >= 40000 then 1 else f.n + 1 end,
  case when f.n >= 500 or f.total >= 40000 then d.size else f.total + d.size end from f join d on d.rn = f.rn + 1)
select cast(batch as bigint) as batch, cast(max(n) as bigint) as n_rows, cast(max(total) as bigint) as n_bytes, min(doc_id) as first_key, max(doc_id) as last_key from f group by batch""",
    "q14_pending_top_n": f"with {fx.REPAIR_SQL} select event_id, k, operation from log_orders where event_id <= {LIMIT}",
    "q15_backlog": f"with {fx.REPAIR_SQL} select 'all' as log, count(*) as events, min(event_id) as first_event_id, max(event_id) as last_event_id from log_orders union all select 'none', 0, null, null",
    "q16_exact_ack": f"with {fx.REPAIR_SQL} select event_id, operation from log_orders where event_id % 5 <> 0",
    "q17_capture_plan": f"""with {fx.values_sql("t", _TABLES, PLAN_TABLES)}, {fx.values_sql("k", _KEYS, PLAN_KEYS)},
g as (select table_name, string_agg(column_name, ',' order by position) as cols, bool_and(portable_type in ('integer', 'varchar', 'text')) as stable from k group by 1)
select t.table_name, case when stable then 'primary_key' else 'table' end as identity_kind, case when stable then cols else '' end as key_columns from t left join g using (table_name)""",
    "q18_capture_status": "select 5 as tracked_tables, 15 as expected_triggers, 12 as installed_triggers, 3 as table_dirty_tables, false as healthy",
    "q34_sync_counters": f"""with {_DIRTY_SQL}
select 1 as table_dirty, 2 as policy_noops, 3 as table_reconciliations, count(o.o_orderkey) as upserts, count(*) - count(o.o_orderkey) as deletes from dirty left join orders o on o.o_orderkey = dirty.k""",
    "q35_table_replace": "select l_returnflag, l_linestatus, count(*) as n, cast(sum(cast(l_quantity as decimal(18,2))) as decimal(18,2)) as sum_quantity from lineitem group by 1, 2",
}
