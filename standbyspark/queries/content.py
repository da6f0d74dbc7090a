"""Content queries: row comparison, digests, counts and reconciliation."""

from __future__ import annotations

from itertools import product

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.encoding import row_hash, table_digest
from ..model import Engine, Table
from ..operators.diff import content_diff, diff_counts
from ..operators.fingerprint import signatures
from ..operators.reconcile import content, overall_status, table_results
from ..operators.validation import row_counts
from . import fixtures as fx
from .fixtures import table


def q01_content_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return diff_counts(content_diff(fx.primary_orders(spark, sf_dir), fx.standby_orders(spark, sf_dir), ["o_orderkey"], ["o_custkey", "o_totalprice"]))


def q02_row_hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    nulled = F.when(F.col("c_custkey") % 7 == 0, None).otherwise(F.col("c_mktsegment"))
    return table(spark, sf_dir, "customer").withColumn("c_mktsegment", nulled).select("c_custkey", row_hash(fx.CUSTOMER.visible).alias("row_hash"))


def q03_table_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = [("orders", table(spark, sf_dir, "orders"), fx.ORDERS), ("customer", table(spark, sf_dir, "customer"), fx.CUSTOMER), ("nothing", table(spark, sf_dir, "nation").filter("n_nationkey < 0"), fx.NATION)]
    parts = [table_digest(df, t.visible).select(F.lit(name).alias("table_name"), "row_count", "digest") for name, df, t in named]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def q04_digest_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    sides = {side: table_digest(df, fx.SHORT_ORDERS.visible).select(F.lit("orders").alias("table_name"), F.col("row_count").alias(f"{side}_rows"), F.col("digest").alias(f"{side}_digest")) for side, df in (("primary", fx.primary_orders(spark, sf_dir)), ("standby", fx.standby_orders(spark, sf_dir)))}
    joined = sides["primary"].join(sides["standby"], "table_name")
    return joined.withColumn("matches", F.col("primary_digest") == F.col("standby_digest"))


def q05_table_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return row_counts({name: table(spark, sf_dir, name) for name in fx.ALL_TABLES})


def _columns(spark: SparkSession, tables: list[Table]) -> DataFrame:
    rows = [(t.name, i, c.name, c.portable, c.nullable, c.name in t.primary_key) for t in tables for i, c in enumerate(t.visible, 1)]
    return spark.createDataFrame(rows, "table_name string, position int, column_name string, portable_type string, nullable boolean, in_key boolean")


def _retyped(t: Table, column: str, portable: str) -> Table:
    from dataclasses import replace

    return replace(t, columns=tuple(replace(c, portable=portable) if c.name == column else c for c in t.columns))


def q06_schema_signature(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders' datetime comes back as text from SQLite, which is no drift; customer's balance as text is."""
    primary = signatures(_columns(spark, [fx.ORDERS, fx.CUSTOMER, fx.NATION]), "sqlite").withColumnRenamed("signature", "primary_signature")
    standby = signatures(_columns(spark, [_retyped(fx.ORDERS, "o_orderdate", "text"), _retyped(fx.CUSTOMER, "c_acctbal", "text"), fx.NATION]), "sqlite").withColumnRenamed("signature", "standby_signature")
    return primary.join(standby, "table_name").withColumn("matches", F.col("primary_signature") == F.col("standby_signature"))


def _side(spark: SparkSession, tables: dict[str, tuple[DataFrame, Table]]) -> DataFrame:
    signed = signatures(_columns(spark, [t for _, t in tables.values()]), str(Engine.SQLITE))
    found = content(tables)
    return signed.join(found, "table_name", "left").select("table_name", "signature", F.coalesce("row_count", F.lit(0)).alias("row_count"), F.coalesce("digest", F.lit("0" * 64)).alias("digest"))


def q07_reconcile_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = lambda name: table(spark, sf_dir, name)
    pages, talks = t("pages").select("page_id", "url"), t("conversations").select("conv_id", "turn", "role")
    primary = {"nation": (t("nation"), fx.NATION), "orders": (fx.primary_orders(spark, sf_dir), fx.SHORT_ORDERS), "region": (t("region"), fx.REGION), "customer": (t("customer"), fx.CUSTOMER), "cache_pages": (pages, fx.CACHE_PAGES), "sessions": (talks, fx.SESSIONS)}
    standby = {"nation": (t("nation"), fx.NATION), "orders": (fx.standby_orders(spark, sf_dir), fx.SHORT_ORDERS), "part": (t("part"), fx.PART), "customer": (t("customer"), _retyped(fx.CUSTOMER, "c_name", "text")), "cache_pages": (pages.filter("page_id % 50 = 0"), fx.CACHE_PAGES), "sessions": (talks.filter("conv_id < 0"), fx.SESSIONS)}
    return table_results(_side(spark, primary), _side(spark, standby), "clean")


FLAGS = ("manifest_missing", "unsupported", "drift", "objects", "fingerprint_changed", "integrity_failed", "artifact_mismatch")


def q08_reconcile_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.createDataFrame([*product([False, True], repeat=len(FLAGS))], ", ".join(f"{f} boolean" for f in FLAGS))
    return rows.withColumn("status", overall_status(*(F.col(f) for f in FLAGS)))


QUERIES = {f.__name__: f for f in (q01_content_diff, q02_row_hashes, q03_table_digest, q04_digest_compare, q05_table_counts, q06_schema_signature, q07_reconcile_tables, q08_reconcile_status)}


def _cell(name: str, kind: str, decimals: str = "decimal(18,2)") -> str:
    if kind in ("integer", "numeric"):
        text = f"cast({name} as varchar)" if kind == "integer" else f"cast(cast({name} as {decimals}) as varchar)"
        body = f"""'["{kind}","'||{text}||'"]'"""
    else:
        body = f"""'["{kind}","'||replace(to_base64(encode(cast({name} as varchar))),'/',chr(92)||'/')||'"]'"""
    return f"""coalesce({body}, '["null"]')"""


def _hash(columns: list[tuple[str, str]]) -> str:
    return "sha256('['||" + "||','||".join(_cell(n, k) for n, k in columns) + "||']')"


def _digest(source: str) -> str:
    """(row_count, digest) of the hashes ``h`` in ``source``."""
    sums = ", ".join(f"coalesce(sum(cast('0x'||substr(h,{1 + 8 * i},8) as hugeint)), 0) as s{i}" for i in range(8))
    sql = f"(select count(*) as row_count, {sums} from {source})"
    carry = "0"
    for i in range(7, -1, -1):
        sql = f"(select *, (s{i} + {carry}) % 4294967296 as d{i}, (s{i} + {carry}) // 4294967296 as c{i} from {sql})"
        carry = f"c{i}"
    text = "||".join(f"lpad(to_hex(cast(d{i} as ubigint)), 8, '0')" for i in range(8))
    return f"select row_count, lower({text}) as digest from {sql}"


_ORDERS = [("o_orderkey", "integer"), ("o_custkey", "integer"), ("o_orderstatus", "text"), ("o_totalprice", "numeric"), ("o_orderdate", "datetime"), ("o_orderpriority", "text")]
_CUSTOMER = [("c_custkey", "integer"), ("c_name", "varchar"), ("c_nationkey", "integer"), ("c_acctbal", "numeric"), ("c_mktsegment", "varchar")]
_SHORT = [("o_orderkey", "integer"), ("o_custkey", "integer"), ("o_totalprice", "numeric")]

ORACLE_SQL = {
    "q01_content_diff": f"""with {fx.STANDBY_SQL}
select case when s.o_orderkey is null then 'missing' when p.o_orderkey is null then 'extra'
 when p.o_custkey is not distinct from s.o_custkey and p.o_totalprice is not distinct from s.o_totalprice then 'same' else 'changed' end as status, count(*) as n
from orders p full outer join standby s on p.o_orderkey = s.o_orderkey group by 1""",
    "q02_row_hashes": f"""select c_custkey, {_hash(_CUSTOMER)} as row_hash from (select * replace (case when c_custkey%7=0 then null else c_mktsegment end as c_mktsegment) from customer)""",
    "q03_table_digest": f"""select 'orders' as table_name, * from ({_digest(f"(select {_hash(_ORDERS)} as h from orders)")})
union all select 'customer', * from ({_digest(f"(select {_hash(_CUSTOMER)} as h from customer)")})
union all select 'nothing', 0, repeat('0', 64)""",
    "q04_digest_compare": f"""with {fx.STANDBY_SQL}, p as ({_digest(f"(select {_hash(_SHORT)} as h from orders)")}), s as ({_digest(f"(select {_hash(_SHORT)} as h from standby)")})
select 'orders' as table_name, p.row_count as primary_rows, p.digest as primary_digest, s.row_count as standby_rows, s.digest as standby_digest, p.digest = s.digest as matches from p, s""",
    "q05_table_counts": " union all ".join(f"select '{t}' as table_name, count(*) as row_count from {t}" for t in fx.ALL_TABLES),
    "q06_schema_signature": """with o(t, s) as (values
 ('orders', 'o_orderkey integer not null, o_custkey integer not null, o_orderstatus text null, o_totalprice numeric null, o_orderdate text null, o_orderpriority text null'),
 ('nation', 'n_nationkey integer not null, n_name text null, n_regionkey integer not null'))
select t as table_name, s as primary_signature, s as standby_signature, true as matches from o
union all select 'customer', 'c_custkey integer not null, c_name varchar null, c_nationkey integer not null, c_acctbal numeric null, c_mktsegment varchar null',
 'c_custkey integer not null, c_name varchar null, c_nationkey integer not null, c_acctbal text null, c_mktsegment varchar null', false""",
    "q07_reconcile_tables": f"""with {fx.STANDBY_SQL}, stray as (select count(*) as n from pages where page_id % 50 = 0),
diff as (select count(*) as n from ((select o_orderkey, o_custkey, o_totalprice from orders except all select * from standby) union all (select * from standby except all select o_orderkey, o_custkey, o_totalprice from orders)))
select 'nation' as table_name, 'copy' as decision, (select count(*) from nation) as expected_rows, (select count(*) from nation) as actual_rows, true as schema_matches, true as content_matches, 'none' as first_issue
union all select 'orders', 'copy', (select count(*) from orders), (select count(*) from standby), true, n = 0, case when (select count(*) from orders) <> (select count(*) from standby) then 'row_count' when n > 0 then 'content' else 'none' end from diff
union all select 'region', 'copy', null, null, false, true, 'table_set'
union all select 'part', 'copy', null, null, false, true, 'table_set'
union all select 'customer', 'copy', (select count(*) from customer), (select count(*) from customer), false, false, 'schema'
union all select 'cache_pages', 'schema_only', 0, n, true, n = 0, case when n > 0 then 'row_count' else 'none' end from stray
union all select 'sessions', 'schema_only', 0, 0, true, true, 'none'""",
    "q08_reconcile_status": f"""with f as (select * from {", ".join(f"(values (false), (true)) t{i}({f})" for i, f in enumerate(FLAGS))}),
a as (select *, case when unsupported then 'BLOCKED' when manifest_missing then 'REBUILD_REQUIRED' else 'MATCH' end as s1 from f),
b as (select *, case when drift and s1 <> 'BLOCKED' then 'DRIFT' else s1 end as s2 from a),
c as (select *, case when objects then 'BLOCKED' else s2 end as s3 from b),
d as (select *, case when fingerprint_changed and not manifest_missing and s3 <> 'BLOCKED' then 'REBUILD_REQUIRED' else s3 end as s4 from c)
select {", ".join(FLAGS)}, case when artifact_mismatch and not manifest_missing then 'DRIFT' when integrity_failed then 'BLOCKED' else s4 end as status from d""",
}
