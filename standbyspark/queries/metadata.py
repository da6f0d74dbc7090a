"""Catalog, portability, policy and publication queries over literal catalogs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.names import derived_index_name, trigger_name
from ..functions.types import target_type
from ..model import Column, Engine
from ..operators import portability as port
from ..operators.policy import decision
from ..operators.sync import fk_unsafe
from ..operators.transfer import overflows
from ..operators.validation import orphans, unique_violations
from ..sources import catalog as cat
from . import fixtures as fx
from .fixtures import table

IS_TABLES, IS_COLUMNS = "TABLE_NAME string, TABLE_TYPE string", "TABLE_NAME string, ORDINAL_POSITION int, COLUMN_NAME string, COLUMN_TYPE string, DATA_TYPE string, IS_NULLABLE string"
TABLE_ROWS = [("app_orders", "BASE TABLE"), ("app_notes", "BASE TABLE"), ("app_report", "VIEW"), ("other_users", "BASE TABLE"), ("standby_change_log", "BASE TABLE")]
COLUMN_ROWS = [
    ("app_orders", 1, "id", "bigint(20) unsigned", "bigint", "NO"), ("app_orders", 2, "total", "decimal(12,4)", "decimal", "YES"), ("app_orders", 3, "state", "enum('a','b')", "enum", "NO"),
    ("app_notes", 1, "id", "int(11)", "int", "NO"), ("app_notes", 2, "body", "longtext", "longtext", "YES"), ("app_notes", 3, "seen", "datetime", "datetime", "YES"), ("app_notes", 4, "raw", "varbinary(16)", "varbinary", "YES"),
    ("app_report", 1, "n", "bigint(21)", "bigint", "NO"), ("other_users", 1, "id", "int(11)", "int", "NO"), ("standby_change_log", 1, "event_id", "bigint(20)", "bigint", "NO"),
]

P_TABLES = [("records", "utf8mb4_general_ci", "InnoDB", False), ("items", None, "InnoDB", False), ("logs", "utf8mb4_bin", "MyISAM", True)]
P_COLUMNS = [
    # table, position, column, native, portable, precision, scale, length, unsigned, generated, hidden, collation, default, nullable, in_key
    ("records", 1, "id", "int unsigned", "integer", None, None, None, True, False, False, None, None, False, True), ("records", 2, "kind", "enum('x','y')", "unknown", None, None, None, False, False, False, "utf8mb4_general_ci", None, True, False),
    ("records", 3, "computed", "int", "integer", None, None, None, False, True, False, None, None, True, False), ("records", 4, "place", "point", "unknown", None, None, None, False, False, False, None, None, True, False),
    ("records", 5, "price", "decimal", "numeric", None, None, None, False, False, False, None, None, True, False), ("records", 6, "doc", "json", "unknown", None, None, None, False, False, True, None, None, True, False),
    ("items", 1, "id", "bigint", "integer", None, None, None, False, False, False, None, None, False, True), ("items", 2, "name", "varchar(255)", "varchar", None, None, 255, False, False, False, "utf8mb4_unicode_520_ci", "'now'", False, False),
    ("items", 3, "made", "datetime", "datetime", None, None, None, False, False, False, None, "CURRENT_TIMESTAMP", True, False), ("items", 4, "tag", "varchar(600)", "varchar", None, None, 600, False, False, False, "latin1_swedish", None, True, False), ("items", 5, "body", "text", "text", None, None, None, False, False, False, None, "uuid()", True, False),
    ("logs", 1, "line", "text", "text", None, None, None, False, False, False, "utf8mb4_bin", None, True, False),
]
P_INDEXES = [("items", "by_tag", "btree", False, False, False), ("items", "by_name", "btree", True, False, False), ("items", "by_body", "fulltext", False, False, False), ("items", "by_lower", "btree", False, False, True), ("logs", "recent", "btree", False, True, False), ("items", "wide", "btree", False, False, False), ("items", "wide_unique", "btree", True, False, False)]
P_INDEX_COLUMNS = [("items", "by_tag", 1, "tag", 191), ("items", "by_name", 1, "name", 16), ("items", "by_body", 1, "body", None), ("logs", "recent", 1, "line", 40), ("items", "wide", 1, "id", None), ("items", "wide", 2, "tag", None), ("items", "wide", 3, "name", None), ("items", "wide_unique", 1, "tag", None), ("items", "wide_unique", 2, "name", None)]
P_OBJECTS = [("view", "report"), ("trigger", "audit")]


def _catalog(spark: SparkSession) -> port.Catalog:
    return port.Catalog(*(spark.createDataFrame(rows, schema) for rows, schema in ((P_TABLES, cat.TABLES), (P_COLUMNS, cat.COLUMNS), (P_INDEXES, cat.INDEXES), (P_INDEX_COLUMNS, cat.INDEX_COLUMNS), (P_OBJECTS, cat.OBJECTS))))


def q19_catalog_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cat.information_schema_columns(spark.createDataFrame(TABLE_ROWS, IS_TABLES), spark.createDataFrame(COLUMN_ROWS, IS_COLUMNS), "app_")


TYPE_CASES = [("tinyint", None, None, None), ("INTEGER", None, None, None), ("bigint unsigned", None, None, None), ("varchar(64)", 64, None, None), ("varchar(70000)", 70000, None, None), ("longtext", None, None, None), ("varbinary(9)", 9, None, None), ("double", None, None, None), ("numeric(10,2)", None, 10, 2), ("numeric(30,2)", None, 30, 2), ("numeric(2,5)", None, 2, 5), ("date", None, None, None), ("datetime", None, None, None), ("timestamp", None, None, None), ("time", None, None, None), ("enum('a')", None, None, None), ("json", None, None, None)]


def q20_type_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..functions.types import base_name, portable_of
    from ..model import NotPortable

    rows = []
    for native, length, precision, scale in TYPE_CASES:
        column = Column("c", native, portable_of(base_name(native)), unsigned="unsigned" in native, length=length, precision=precision, scale=scale)
        out = []
        for target, source in ((Engine.SQLITE, Engine.MYSQL), (Engine.MYSQL, Engine.SQLITE)):
            try:
                out.append(target_type(column, target, source))
            except NotPortable:
                out.append("rejected")
        rows.append((native, column.portable, *out))
    return spark.createDataFrame(rows, "native string, portable string, sqlite string, mysql string")


def q21_portability_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    return port.issues(_catalog(spark))


def q22_import_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first failure of the whole catalog, and of the one without errors, for either target."""
    full = _catalog(spark)
    plain = port.Catalog(full.tables.filter("table_name <> 'records'"), full.columns.filter("table_name <> 'records' and column_name not in ('made', 'body')"), full.indexes.filter("index_name not in ('by_body', 'by_lower')"), full.index_columns, full.objects.limit(0))
    out = None
    for name, catalog in (("full", full), ("plain", plain)):
        for target in ("sqlite", "mysql"):
            row = port.first_failure(port.gate_findings(catalog, target)).select(F.lit(name).alias("catalog"), F.lit(target).alias("target"), "step", "rule", "table_name", "detail")
            out = row if out is None else out.unionByName(row)
    return out


def q23_index_bounding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return port.bounded_indexes(_catalog(spark))


def q24_trigger_and_index_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = spark.createDataFrame([(t, i) for t, i, *_ in P_INDEXES], "table_name string, index_name string")
    t, i = F.col("table_name"), F.col("index_name")
    return pairs.select(t, i, trigger_name(t, "i").alias("insert_trigger"), derived_index_name(t, i, 24).alias("mysql_index"), derived_index_name(t, i, 32).alias("sqlite_index"))


POLICY_TABLES = ["cache_data", "cachetags", "sessions", "semaphore", "batch", "watchdog", "queue", "flood", "key_value", "key_value_expire", "custom_business_data", "cache", "my_cache_x"]


def _policies(spark: SparkSession) -> DataFrame:
    rows = [(p, t) for p in ("full", "clean") for t in POLICY_TABLES]
    return spark.createDataFrame(rows, "profile string, table_name string").select("*", decision(F.col("profile"), F.col("table_name")).alias("decision"))


def q25_policy_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _policies(spark)


#: Driver tables under names of a content system, so that a clean transfer leaves the rows of some behind.
RENAMED = [("orders", "orders"), ("pages", "cache_pages"), ("conversations", "sessions"), ("events", "watchdog"), ("nation", "nation"), ("labels", "queue")]


def q26_clean_transfer_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..operators.policy import decide
    from ..model import Decision, Profile

    out = None
    for source, name in RENAMED:
        copied = decide(Profile.CLEAN, name) is Decision.COPY
        # rows that are not copied are not read
        n = table(spark, sf_dir, source).agg(F.count("*").alias("expected_rows")) if copied else spark.createDataFrame([(0,)], "expected_rows long")
        row = n.select(F.lit(name).alias("table_name"), F.lit(str(decide(Profile.CLEAN, name))).alias("decision"), "expected_rows")
        out = row if out is None else out.unionByName(row)
    return out


def q27_referential_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders whose customer is gone; every 13th key is moved away and every 17th is null."""
    key = F.col("o_orderkey")
    customer = F.when(key % 17 == 0, None).when(key % 13 == 0, F.col("o_custkey") + 10_000_000).otherwise(F.col("o_custkey"))
    child = table(spark, sf_dir, "orders").select("o_orderkey", customer.alias("o_custkey"))
    return orphans(child, ["o_custkey"], table(spark, sf_dir, "customer"), ["c_custkey"])


def q28_unique_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unique_violations(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


def q29_unsigned_overflow(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    value = F.when(key % 50 == 0, F.concat(F.lit("922337203685477580"), (key % 10).cast("string"))).when(key % 51 == 0, F.concat(F.lit("00018446744073709551"), (key % 1000).cast("string"))).when(key % 52 == 0, F.lit("n/a")).when(key % 53 == 0, F.lit("9223372036854775808")).otherwise(key.cast("string"))
    return table(spark, sf_dir, "orders").select("o_orderkey", value.alias("value")).filter(overflows(F.col("value")))


FK_ROWS = [("orders", "fk_customer", ["o_custkey"], "customer", ["c_custkey"]), ("nation", "fk_region", ["n_regionkey"], "region", ["r_regionkey"])]
DIRTY_TABLES = [("orders",), ("customer",), ("region",), ("lineitem",), ("events",)]


def q30_fk_safety(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fk_unsafe(spark.createDataFrame(DIRTY_TABLES, "table_name string"), spark.createDataFrame(FK_ROWS, cat.FOREIGN_KEYS))


GENERATIONS = "destination string, generation string, written_at int, active boolean"
GENERATION_ROWS = [("a", "g1", 10, False), ("a", "g2", 20, True), ("a", "g3", 30, False), ("a", "g4", 40, False), ("a", "g5", 40, False), ("b", "h1", 5, True), ("b", "h2", 4, False), ("c", "i1", 1, False)]


def q31_retention_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keep 3: the active generation and the newest others."""
    rows = spark.createDataFrame(GENERATION_ROWS, GENERATIONS)
    rank = F.row_number().over(Window.partitionBy("destination", "active").orderBy(F.desc("written_at"), "generation"))
    return rows.select("destination", "generation", (F.col("active") | (rank <= 2)).alias("kept"))


def q32_destination_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = "destination string, type string, name string"
    rows = spark.createDataFrame([("one", "table", "orders"), ("one", "index", "sqlite_autoindex_1"), ("one", "view", "report"), ("two", "table", "sqlite_sequence"), ("three", "trigger", "audit")], schema)
    user = rows.filter(F.substring("name", 1, 7) != "sqlite_")
    reasons = user.groupBy("destination").agg(F.array_join(F.array_sort(F.collect_list(F.concat_ws(": ", "type", "name"))), ", ").alias("reasons"))
    return rows.select("destination").distinct().join(reasons, "destination", "left").select("destination", F.when(F.col("reasons").isNull(), "empty").otherwise("not_empty").alias("state"), F.coalesce("reasons", F.lit("")).alias("reasons"))


def q33_preflight_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = port.issues(_catalog(spark)).agg(F.count_if(F.col("severity") == "error").alias("errors"), F.count_if(F.col("severity") == "warning").alias("warnings"), F.count_distinct("table_name").alias("affected"))
    n = spark.createDataFrame([(len(P_TABLES),)], "tables long")
    return n.crossJoin(found).select("tables", F.greatest(F.lit(0).cast("long"), F.col("tables") - F.col("affected")).alias("safe_tables"), "warnings", "errors")


QUERIES = {f.__name__: f for f in (q19_catalog_columns, q20_type_mapping, q21_portability_issues, q22_import_gate, q23_index_bounding, q24_trigger_and_index_names, q25_policy_decisions, q26_clean_transfer_counts, q27_referential_check, q28_unique_violations, q29_unsigned_overflow, q30_fk_safety, q31_retention_plan, q32_destination_state, q33_preflight_summary)}

_CATALOG_SQL = ",\n".join(fx.values_sql(*x) for x in (("p_tables", cat.TABLES, P_TABLES), ("p_columns", cat.COLUMNS, P_COLUMNS), ("p_indexes", cat.INDEXES, P_INDEXES), ("p_index_columns", cat.INDEX_COLUMNS, P_INDEX_COLUMNS), ("p_objects", cat.OBJECTS, P_OBJECTS)))
_BASE = "lower(trim(regexp_replace(native_type, '\\s*\\(.*$', '')))"


def _issues_sql(name: str, columns: str, tables: str, indexes: str, parts: str, objects: str) -> str:
    return f"""{name} as (
 select case when {_BASE} in ('enum','set') then 'unsupported_type' when {_BASE} in ('geometry','point','linestring','polygon','multipoint','multilinestring','multipolygon','geometrycollection') then 'spatial_type'
  when portable_type = 'unknown' then 'unknown_type' when portable_type = 'numeric' and (precision is null or scale is null) then 'numeric_mapping_incomplete' end as code, 'error' as severity, table_name, column_name, null as object_name from {columns}
 union all select 'generated_column', 'error', table_name, column_name, null from {columns} where generated
 union all select 'hidden_column', 'error', table_name, column_name, null from {columns} where hidden
 union all select 'unsigned_semantics', 'warning', table_name, column_name, null from {columns} where unsigned
 union all select 'column_collation', 'warning', table_name, column_name, null from {columns} where "collation" is not null
 union all select 'backend_default_expression', 'error', table_name, column_name, null from {columns} where regexp_matches("default", '(?i)\\b(current_timestamp|current_date|current_time|now|uuid)\\b|\\w+\\s*\\(')
 union all select 'table_collation', 'warning', table_name, null, null from {tables} where "collation" is not null
 union all select 'functional_index', 'error', table_name, null, index_name from {indexes} where is_functional
 union all select 'fulltext_index', 'error', table_name, null, index_name from {indexes} where kind like '%fulltext%'
 union all select 'spatial_index', 'error', table_name, null, index_name from {indexes} where kind like '%spatial%'
 union all select 'partial_index', 'warning', table_name, null, index_name from {indexes} where is_partial
 union all select 'prefix_index', 'warning', table_name, column_name, index_name from {parts} where prefix_length is not null
 union all select 'unsupported_schema_object', 'error', null, null, object_type||':'||object_name from {objects}),
{name}_found as (select * from {name} where code is not null)"""


_ISSUES = _issues_sql("issues", "p_columns", "p_tables", "p_indexes", "p_index_columns", "p_objects")


def _gate_sql(label: str, found: str, columns: str, tables: str, indexes: str) -> str:
    return f"""{label} as (
 select 1 as step, 'portability_error' as rule, coalesce(table_name, '') as table_name, code||':'||coalesce(column_name, object_name) as detail from {found} where severity = 'error'
 union all select 2, 'hidden_or_generated', table_name, column_name from {columns} where hidden or generated
 union all select 3, 'unsupported_collation', table_name, column_name from {columns} where "collation" not like '%\\_ci' escape '\\' and "collation" not like '%\\_bin' escape '\\'
 union all select 4, 'unique_prefix_index', table_name, index_name from {indexes} i where is_unique and exists (select 1 from p_index_columns c where c.table_name = i.table_name and c.index_name = i.index_name and prefix_length is not null)
 union all select 5, 'partial_index', table_name, index_name from {indexes} where is_partial
 union all select 6, 'strict_table', table_name, table_name from {tables} where strict)"""


def _first_sql(catalog: str, target: str) -> str:
    only = "" if target == "sqlite" else "where step not in (3, 4)"
    return f"select * from (select '{catalog}' as catalog, '{target}' as target, step, rule, table_name, detail from gate_{catalog} {only} order by step, table_name, detail limit 1)"


ORACLE_SQL = {
    "q19_catalog_columns": f"""with {fx.values_sql("t", IS_TABLES, TABLE_ROWS)}, {fx.values_sql("c", IS_COLUMNS, COLUMN_ROWS)}
select substr(c."TABLE_NAME", 5) as table_name, "ORDINAL_POSITION" as position, "COLUMN_NAME" as column_name, "COLUMN_TYPE" as native_type,
 case when "DATA_TYPE" in ('bigint','int') then 'integer' when "DATA_TYPE" = 'decimal' then 'numeric' when "DATA_TYPE" = 'longtext' then 'text' when "DATA_TYPE" = 'datetime' then 'datetime' when "DATA_TYPE" = 'varbinary' then 'blob' else 'unknown' end as portable_type, "IS_NULLABLE" = 'YES' as nullable
from c join t on t."TABLE_NAME" = c."TABLE_NAME" where "TABLE_TYPE" = 'BASE TABLE' and starts_with(c."TABLE_NAME", 'app_')""",
    "q20_type_mapping": """select * from (values ('tinyint','integer','INTEGER','TINYINT'), ('INTEGER','integer','INTEGER','BIGINT'), ('bigint unsigned','integer','INTEGER','BIGINT UNSIGNED'), ('varchar(64)','varchar','VARCHAR(64)','VARCHAR(64)'),
 ('varchar(70000)','varchar','VARCHAR(65535)','VARCHAR(65535)'), ('longtext','text','TEXT','LONGTEXT'), ('varbinary(9)','blob','BLOB','LONGBLOB'), ('double','float','REAL','DOUBLE'), ('numeric(10,2)','numeric','NUMERIC(10,2)','DECIMAL(10,2)'),
 ('numeric(30,2)','numeric','rejected','DECIMAL(30,2)'), ('numeric(2,5)','numeric','rejected','rejected'), ('date','date','TEXT','DATE'), ('datetime','datetime','TEXT','DATETIME'), ('timestamp','timestamp','TEXT','TIMESTAMP'), ('time','time','TEXT','TIME'),
 ('enum(''a'')','unknown','rejected','rejected'), ('json','unknown','rejected','rejected')) t(native, portable, sqlite, mysql)""",
    "q21_portability_issues": f"with {_CATALOG_SQL},\n{_ISSUES} select * from issues_found",
    "q22_import_gate": f"""with {_CATALOG_SQL}, {_ISSUES},
c2 as (select * from p_columns where table_name <> 'records' and column_name not in ('made', 'body')), t2 as (select * from p_tables where table_name <> 'records'), i2 as (select * from p_indexes where index_name not in ('by_body', 'by_lower')), o2 as (select * from p_objects where false),
{_issues_sql("plain", "c2", "t2", "i2", "p_index_columns", "o2")}, {_gate_sql("gate_full", "issues_found", "p_columns", "p_tables", "p_indexes")}, {_gate_sql("gate_plain", "plain_found", "c2", "t2", "i2")}
{" union all ".join(_first_sql(c, t) for c in ("full", "plain") for t in ("sqlite", "mysql"))}""",
    # sizes: by_tag 4*191, by_name 4*16, by_body 65535 (text), recent 4*40, wide 8+2400+1020, wide_unique 2400+1020
    "q23_index_bounding": """select * from (values ('items','by_tag',764,'fits',''), ('items','by_name',64,'fits',''), ('items','by_body',65535,'shortened','body(750)'), ('logs','recent',160,'fits',''),
 ('items','wide',3428,'shortened','name(148)'), ('items','wide_unique',3420,'too_long','')) t(table_name, index_name, total_bytes, status, prefixes)""",
    "q24_trigger_and_index_names": f"""with {_CATALOG_SQL}, h as (select table_name, index_name, sha256(table_name) as t, sha256(encode(table_name)||'\\x00'::blob||encode(index_name)) as i from p_indexes)
select table_name, index_name, 'standby_cdc_'||substr(t,1,16)||'_i' as insert_trigger, 'idx_'||substr(i,1,24) as mysql_index, 'idx_'||substr(i,1,32) as sqlite_index from h""",
    "q25_policy_decisions": f"""with {fx.values_sql("t", "table_name string", [(t,) for t in POLICY_TABLES])}
select profile, table_name, case when profile = 'clean' and (starts_with(table_name, 'cache_') or table_name in ('cachetags','sessions','semaphore','batch','watchdog')) then 'schema_only' else 'copy' end as decision from t, (values ('full'), ('clean')) p(profile)""",
    "q26_clean_transfer_counts": """select 'orders' as table_name, 'copy' as decision, count(*) as expected_rows from orders union all select 'cache_pages', 'schema_only', 0 union all select 'sessions', 'schema_only', 0
 union all select 'watchdog', 'schema_only', 0 union all select 'nation', 'copy', count(*) from nation union all select 'queue', 'copy', count(*) from labels""",
    "q27_referential_check": """with c as (select o_orderkey, case when o_orderkey%17=0 then null when o_orderkey%13=0 then o_custkey+10000000 else o_custkey end as o_custkey from orders)
select o_custkey, o_orderkey from c where o_custkey is not null and not exists (select 1 from customer where c_custkey = c.o_custkey)""",
    "q28_unique_violations": "select l_orderkey, l_linenumber, count(*) as n from lineitem group by 1, 2 having count(*) > 1",
    "q29_unsigned_overflow": """with v as (select o_orderkey, case when o_orderkey%50=0 then '922337203685477580'||(o_orderkey%10) when o_orderkey%51=0 then '00018446744073709551'||(o_orderkey%1000) when o_orderkey%52=0 then 'n/a' when o_orderkey%53=0 then '9223372036854775808' else cast(o_orderkey as varchar) end as value from orders)
select * from v where coalesce(try_cast(value as hugeint), 0) > 9223372036854775807""",
    "q30_fk_safety": "select * from (values ('orders'), ('customer'), ('region')) t(table_name)",
    "q31_retention_plan": f"""with {fx.values_sql("g", GENERATIONS, GENERATION_ROWS)}
select destination, generation, active or row_number() over (partition by destination, active order by written_at desc, generation) <= 2 as kept from g""",
    "q32_destination_state": "select * from (values ('one','not_empty','table: orders, view: report'), ('two','empty',''), ('three','not_empty','trigger: audit')) t(destination, state, reasons)",
    "q33_preflight_summary": f"""with {_CATALOG_SQL}, {_ISSUES}
select 3 as tables, greatest(0, 3 - count(distinct table_name)) as safe_tables, count(*) filter (severity = 'warning') as warnings, count(*) filter (severity = 'error') as errors from issues_found""",
}
