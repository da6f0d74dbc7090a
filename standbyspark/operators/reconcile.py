"""Read-only reconciliation: per-table results and the overall status."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column as C
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.encoding import digests, row_hash
from ..model import Profile, Status, Table
from .policy import decision


def content(tables: Mapping[str, tuple[DataFrame, Table]]) -> DataFrame:
    """(table_name, row_count, digest) of the given tables in one job; tables without rows are left out."""
    parts = [df.select(F.lit(name).alias("table_name"), row_hash(table.visible).alias("h")) for name, (df, table) in sorted(tables.items())]
    return digests(reduce(DataFrame.unionByName, parts), "table_name")


def table_results(primary: DataFrame, standby: DataFrame, profile: Profile | str) -> DataFrame:
    """One row per table name of either side.

    Inputs are ``(table_name, signature, row_count, digest)``.  A table on one side only has null counts and counts as
    matching content; a schema_only table is expected to be empty.
    """
    p = primary.select("table_name", F.col("signature").alias("p_sig"), F.col("row_count").alias("p_rows"), F.col("digest").alias("p_digest"), F.lit(True).alias("p"))
    s = standby.select("table_name", F.col("signature").alias("s_sig"), F.col("row_count").alias("s_rows"), F.col("digest").alias("s_digest"), F.lit(True).alias("s"))
    both = F.col("p").isNotNull() & F.col("s").isNotNull()
    dec = decision(F.lit(str(profile)), F.col("table_name"))
    copied = F.col("decision") == "copy"
    out = p.join(s, "table_name", "full_outer").withColumn("decision", dec)
    expected = F.when(both, F.when(copied, F.col("p_rows")).otherwise(F.lit(0)).cast("long"))
    actual = F.when(both, F.col("s_rows"))
    schema = both & (F.col("p_sig") == F.col("s_sig"))
    same = F.when(~both, True).when(copied, F.col("p_digest") == F.col("s_digest")).otherwise(F.col("s_rows") == 0)
    issue = F.when(~both, "table_set").when(~schema, "schema").when(~expected.eqNullSafe(actual), "row_count").when(~same, "content").otherwise("none")
    return out.select("table_name", "decision", expected.alias("expected_rows"), actual.alias("actual_rows"), schema.alias("schema_matches"), same.alias("content_matches"), issue.alias("first_issue"))


def overall_status(manifest_missing: C, unsupported: C, drift: C, objects: C, fingerprint_changed: C, integrity_failed: C, artifact_mismatch: C, manifest_failing: C | None = None) -> C:
    """The status after all steps in their order; later steps win unless they give way to BLOCKED.

    The artifact step comes last and does not give way.  Fingerprint and artifact need a manifest.
    """
    status = F.when(manifest_missing, Status.REBUILD_REQUIRED).otherwise(Status.MATCH)
    status = F.when(unsupported, Status.BLOCKED).otherwise(status)
    status = F.when(drift & (status != Status.BLOCKED), Status.DRIFT).otherwise(status)
    status = F.when(objects, Status.BLOCKED).otherwise(status)
    status = F.when(~manifest_missing & fingerprint_changed & (status != Status.BLOCKED), Status.REBUILD_REQUIRED).otherwise(status)
    status = F.when(integrity_failed, Status.BLOCKED).otherwise(status)
    status = F.when(~manifest_missing & artifact_mismatch, Status.DRIFT).otherwise(status)
    if manifest_failing is not None:
        status = F.when((status == Status.MATCH) & manifest_failing, Status.REBUILD_REQUIRED).otherwise(status)
    return status


def status_of(spark: SparkSession, **flags: bool) -> Status:
    """``overall_status`` of one reconciliation; flags that are not given are false."""
    names = ("manifest_missing", "unsupported", "drift", "objects", "fingerprint_changed", "integrity_failed", "artifact_mismatch", "manifest_failing")
    return Status(spark.range(1).select(overall_status(**{n: F.lit(flags.get(n, False)) for n in names}).alias("status")).first()["status"])
