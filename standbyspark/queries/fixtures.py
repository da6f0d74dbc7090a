"""Tables and drift that the queries work on, derived from the driver's tables by fixed arithmetic."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..model import Column, Table

ALL_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _int(name: str, null: bool = False) -> Column:
    return Column(name, "bigint", "integer", null)


def _text(name: str) -> Column:
    return Column(name, "text", "text")


def _money(name: str) -> Column:
    return Column(name, "decimal(18,2)", "numeric", precision=18, scale=2)


ORDERS = Table("orders", (_int("o_orderkey"), _int("o_custkey"), _text("o_orderstatus"), _money("o_totalprice"), Column("o_orderdate", "datetime", "datetime"), _text("o_orderpriority")), ("o_orderkey",))
CUSTOMER = Table("customer", (_int("c_custkey"), Column("c_name", "varchar(25)", "varchar", length=25), _int("c_nationkey"), _money("c_acctbal"), Column("c_mktsegment", "varchar(10)", "varchar", length=10)), ("c_custkey",))
NATION = Table("nation", (_int("n_nationkey"), _text("n_name"), _int("n_regionkey")), ("n_nationkey",))
REGION = Table("region", (_int("r_regionkey"), _text("r_name")), ("r_regionkey",))
PART = Table("part", (_int("p_partkey"), _text("p_name")), ("p_partkey",))
#: What primary and standby share of orders.
SHORT_ORDERS = Table("orders", (_int("o_orderkey"), _int("o_custkey"), _money("o_totalprice")), ("o_orderkey",))
CACHE_PAGES = Table("cache_pages", (_int("page_id"), _text("url")), ("page_id",))
SESSIONS = Table("sessions", (_int("conv_id"), _int("turn"), _text("role")), ("conv_id", "turn"))


def primary_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")


def standby_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with rows missing, changed and added."""
    orders, key = primary_orders(spark, sf_dir), F.col("o_orderkey")
    kept = orders.filter(key % 97 != 0).withColumn("o_totalprice", F.when(key % 89 == 0, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")))
    return kept.unionByName(orders.filter(key % 101 == 0).withColumn("o_orderkey", key + 10_000_000))


STANDBY_SQL = """standby as (
 select o_orderkey, o_custkey, case when o_orderkey%89=0 then o_totalprice+1 else o_totalprice end as o_totalprice from orders where o_orderkey%97<>0
 union all select o_orderkey+10000000, o_custkey, o_totalprice from orders where o_orderkey%101=0)"""


def repair_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(event_id, k, operation): the events that repair ``standby_orders``; ids follow no order of keys."""
    from pyspark.sql import Window

    k = F.col("o_orderkey")
    orders = table(spark, sf_dir, "orders").select("o_orderkey")
    changes = F.filter(
        F.array(
            F.when(k % 97 == 0, F.struct(k.alias("k"), F.lit("insert").alias("operation"), F.lit(0).alias("v"))), F.when(k % 89 == 0, F.struct(k.alias("k"), F.lit("update").alias("operation"), F.lit(1).alias("v"))),
            F.when((k % 89 == 0) & (k % 2 == 0), F.struct(k.alias("k"), F.lit("update").alias("operation"), F.lit(2).alias("v"))), F.when(k % 101 == 0, F.struct((k + 10_000_000).alias("k"), F.lit("delete").alias("operation"), F.lit(3).alias("v"))),
        ), lambda x: x.isNotNull())
    rows = orders.select(F.inline(changes))
    # ids are dealt on one sequence, as a log's are; the log is the changes only, not the table
    number = F.row_number().over(Window.orderBy(F.col("k") % 1009, "k", "v"))
    return rows.select(number.cast("long").alias("event_id"), "k", "operation")


REPAIR_SQL = """changes as (
 select o_orderkey as k, 'insert' as operation, 0 as v from orders where o_orderkey%97=0
 union all select o_orderkey, 'update', 1 from orders where o_orderkey%89=0
 union all select o_orderkey, 'update', 2 from orders where o_orderkey%89=0 and o_orderkey%2=0
 union all select o_orderkey+10000000, 'delete', 3 from orders where o_orderkey%101=0),
log_orders as (select row_number() over (order by k%1009, k, v) as event_id, k, operation from changes)"""


def user_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One dirty-key event for each row of ``events``, in the shape of the change log."""
    kind, user = F.col("event_id") % 3, F.col("user_id")
    operation = F.when(kind == 0, "insert").when(kind == 1, "update").otherwise("delete")
    key = lambda c: F.to_json(F.struct(c.alias("id")), {"ignoreNullFields": "false"})
    return table(spark, sf_dir, "events").select(
        "event_id", F.lit("users").alias("table_name"), operation.alias("operation"), F.lit("primary_key").alias("identity_kind"),
        F.when(kind != 2, key(user)).alias("key_json"), F.when(kind != 0, key(F.when(kind == 1, user + F.col("event_id") % 2).otherwise(user))).alias("old_key_json"), F.col("ts").alias("captured_at"),
    )


USER_LOG_SQL = """user_log as (
 select event_id, case event_id%3 when 0 then 'insert' when 1 then 'update' else 'delete' end as operation,
  case when event_id%3<>2 then '{"id":'||user_id||'}' end as key_json,
  case when event_id%3=1 then '{"id":'||(user_id+event_id%2)||'}' when event_id%3=2 then '{"id":'||user_id||'}' end as old_key_json from events)"""


def values_sql(name: str, columns: str, rows: list[tuple]) -> str:
    """The same literal rows for DuckDB."""

    def text(v: object) -> str:
        if v is None:
            return "null"
        if isinstance(v, bool):
            return "true" if v else "false"
        return str(v) if isinstance(v, int) else "'" + str(v).replace("'", "''") + "'"

    names = [c.strip().split(" ")[0] for c in columns.split(",")]
    body = ",\n ".join("(" + ", ".join(text(v) for v in r) + ")" for r in rows)
    quoted = ", ".join(f'"{n}"' for n in names)
    return f"{name} as (select * from (values {body}) as t({quoted}))"
