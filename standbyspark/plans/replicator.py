"""Import, rebuild, sync and reconcile between a primary and a standby store.

The primary is read through a pinned generation (its consistent snapshot); the standby changes only by publishing a new
generation.  Order of a sync: publish the data, then the manifest, then the acknowledgement, so a crash between any two
leaves events pending and a replay gives the same standby.

A sync batch reads and writes only the buckets that its keys fall into; the new generation refers to all other folders of the
one before.  Before it begins, the standby must have the manifest, the tables and the columns of the last rebuild, and the
primary the columns that were inventoried; these are looked at again before events may be acknowledged.
"""

from __future__ import annotations

import json
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce

from pyspark import __version__ as spark_version
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..model import Candidate, CandidateState, Decision, DestinationNotEmpty, Engine, IdentityKind, Inventory, NonEmptyPolicy, Profile, StandbyError, Status, SyncOutcome, SyncResult, Table
from ..operators import capture, reduction, sync
from ..operators.fingerprint import schema_fingerprint
from ..operators.policy import decide
from ..operators.portability import require_importable
from ..operators.reconcile import content, status_of, table_results
from ..operators.validation import orphans, row_counts, unique_violations
from ..sources.catalog import catalog_of
from .backup import cleared
from .store import KEEP, Failpoint, Layout, Store, bucket_of, no_failure

PARALLEL_TABLES = 4


@dataclass
class Replicator:
    spark: SparkSession
    primary: Store
    standby: Store
    inventory: Inventory
    profile: Profile = Profile.FULL
    keep: int = KEEP
    failpoint: Failpoint = no_failure
    _version: str = field(default=spark_version, repr=False)

    def __post_init__(self) -> None:
        if self.primary.identity == self.standby.identity or self.primary.root.resolve() == self.standby.root.resolve():
            raise StandbyError("primary and standby are the same data")
        if self.profile is Profile.CLEAN and self.standby.engine is not Engine.SQLITE:
            raise StandbyError("a clean standby must be SQLite")

    def decision(self, table: Table) -> Decision:
        return decide(self.profile, table.name)

    def copied(self) -> list[Table]:
        return [t for t in self.inventory.tables if self.decision(t) is Decision.COPY]

    def fingerprint(self) -> str:
        return schema_fingerprint(self.inventory.tables)

    # inspection

    def key_of(self, table: Table) -> tuple[str, ...]:
        """The key by which rows are addressed; none if the table is replaced as a whole."""
        return table.primary_key if capture.identity_kind(table) is IdentityKind.PRIMARY_KEY else ()

    def observed(self, store: Store, generation: str | None) -> dict[str, tuple[tuple[str, str], ...]]:
        """Names and types of the columns that a store's tables have now."""
        return {t: store.layout(t, generation).columns for t in store.tables(generation)} if generation else {}

    def schema_differences(self, store: Store, generation: str | None) -> list[str]:
        """Tables of a store that are missing, unknown, or have other visible columns than the primary's inventory."""
        there, expected = self.observed(store, generation), {t.name: [c.name for c in t.visible] for t in self.inventory.tables}
        out = [f"{n} is missing" for n in sorted(expected.keys() - there.keys())] + [f"{n} is unknown" for n in sorted(there.keys() - expected.keys())]
        for name in sorted(expected.keys() & there.keys()):
            own = [c for c, _ in there[name]]
            if (own if store is self.standby else [c for c in own if c in expected[name]]) != expected[name]:
                out.append(f"{name} has other columns")
        return out

    # building

    def _read(self, store: Store, table: Table, generation: str | None = None) -> DataFrame:
        return store.read(self.spark, table.name, generation).select([c.name for c in table.visible])

    def _changed(self, snapshot: str, schema: dict) -> str | None:
        """What of the primary is not as it was when ``snapshot`` was pinned."""
        if self.observed(self.primary, self.primary.current()) != schema:
            return "schema"
        return "data" if self.primary.current() != snapshot else None

    def _build(self, snapshot: str) -> tuple[str, dict[str, int]]:
        """Write a candidate from one snapshot of the primary, check it and seal it."""
        if self.inventory.objects:
            raise StandbyError("the primary has objects that no standby can hold")
        require_importable(catalog_of(self.spark, self.inventory), str(self.standby.engine))
        foreign = [t.name for t in self.inventory.tables if self.inventory.engine is Engine.MYSQL and (t.engine or "innodb").lower() != "innodb"]
        if foreign:
            raise StandbyError(f"tables without a consistent snapshot: {foreign}")
        generation = self.standby.new_generation()
        try:
            self.failpoint("after_candidate_create")

            def copy(table: Table) -> None:
                rows = self._read(self.primary, table, snapshot)
                self.standby.write(rows if self.decision(table) is Decision.COPY else rows.limit(0), generation, table.name, self.key_of(table))

            for table in self.inventory.tables[:1]:
                copy(table)
                self.failpoint("mid_row_transfer")
            with ThreadPoolExecutor(PARALLEL_TABLES) as pool:  # small tables need not wait for large ones
                list(pool.map(copy, self.inventory.tables[1:]))
            self.standby.seal(generation)
            self.failpoint("before_validation")
            counts = self._validated(generation, snapshot)
            self.failpoint("after_validation")
            return generation, counts
        except BaseException:
            self.standby.discard(generation)
            raise

    def _validated(self, generation: str, snapshot: str) -> dict[str, int]:
        """Row counts of the candidate, after comparing counts, table names and keys with the snapshot's."""
        names = [t.name for t in self.inventory.tables]
        problems = self.schema_differences(self.standby, generation)
        if problems:
            raise StandbyError(f"the candidate differs from the primary: {problems}")
        made = {r["table_name"]: r["row_count"] for r in row_counts({t.name: self._read(self.standby, t, generation) for t in self.inventory.tables}).collect()}
        there = {r["table_name"]: r["row_count"] for r in row_counts({t.name: self._read(self.primary, t, snapshot) for t in self.copied()}).collect()} if self.copied() else {}
        wrong = [n for n in names if made[n] != there.get(n, 0)]
        if wrong:
            raise StandbyError(f"row counts differ in {wrong}")
        problems = self.integrity(generation)
        if problems:
            raise StandbyError(f"integrity: {problems}")
        return made

    def integrity(self, generation: str | None = None) -> list[str]:
        """Violated keys, unique indexes and foreign keys of the standby, all in one job."""
        found: list[DataFrame] = []
        tables = {t.name: t for t in self.inventory.tables}
        say = lambda df, text: df.limit(1).select(F.lit(text).alias("problem"))
        for t in self.copied():
            rows = self._read(self.standby, t, generation)
            for columns in [t.primary_key, *(tuple(c.name for c in i.columns if c.name) for i in t.indexes if i.unique and not i.functional and not i.partial)]:
                if columns:
                    found.append(say(unique_violations(rows, columns), f"{t.name}: duplicate {','.join(columns)}"))
            for fk in t.foreign_keys:
                if fk.parent in tables and self.decision(tables[fk.parent]) is Decision.COPY:
                    parent = self._read(self.standby, tables[fk.parent], generation)
                    found.append(say(orphans(rows, fk.columns, parent, fk.parent_columns), f"{t.name}: orphans of {fk.parent}"))
        return sorted(r["problem"] for r in reduce(DataFrame.unionAll, found).collect()) if found else []

    def _contents(self, store: Store, generation: str) -> dict[str, tuple[int, str]]:
        tables = {t.name: (self._read(store, t, generation), t) for t in self.copied()}
        found = {r["table_name"]: (r["row_count"], r["digest"]) for r in content(tables).collect()} if tables else {}
        return {name: found.get(name, (0, "0" * 64)) for name in tables}

    def _manifest(self, generation: str, counts: dict[str, int], **more: object) -> dict:
        return {
            "generation": generation, "profile": str(self.profile), "primary_engine": str(self.primary.engine), "standby_engine": str(self.standby.engine), "primary_id": self.primary.destination_id,
            "schema_fingerprint": self.fingerprint(), "tables": sorted(counts), "rows": counts, "total_rows": sum(counts.values()), "validated": True, "passing": True,
            "intentional_exclusions": sorted(t.name for t in self.inventory.tables if self.decision(t) is Decision.SCHEMA_ONLY), "spark_version": self._version,
        } | more

    # operations

    def import_(self, policy: NonEmptyPolicy = NonEmptyPolicy.ABORT, backup=None) -> str:
        """A first copy into an empty standby; a non-empty one aborts, or is saved and cleared, as the policy says."""
        with self.standby.locked("import"):
            if self.standby.current() is not None and self.standby.tables():
                if policy is NonEmptyPolicy.ABORT:
                    raise DestinationNotEmpty(f"the standby holds {self.standby.tables()}")
                if policy is NonEmptyPolicy.BACKUP_THEN_CLEAR:
                    if backup is None:
                        raise StandbyError("this policy needs a backup")
                    backup(self.standby)
                cleared(self.standby, self.primary)  # looks again whether it is empty now
                self.standby.retain(1)
            return self._rebuilt("import")

    def rebuild(self) -> str:
        """Build, compare and publish a new generation; on any failure the old one stays."""
        with self.standby.locked("rebuild"):
            self.standby.sweep()
            return self._rebuilt("rebuild")

    def _rebuilt(self, operation: str) -> str:
        snapshot = self.primary.current()
        if snapshot is None:
            raise StandbyError("the primary has published nothing")
        before = self.observed(self.primary, snapshot)
        generation, counts = self._build(snapshot)
        candidate = Candidate(generation, self.standby.current() or uuid.uuid4().hex).to(CandidateState.BUILDING).to(CandidateState.BUILT)
        try:
            # the barrier: the primary must still be what was copied
            if self._changed(snapshot, before):
                raise StandbyError("the primary changed while it was copied")
            source, made = self._contents(self.primary, snapshot), self._contents(self.standby, generation)
            if source != made:
                raise StandbyError(f"content differs in {sorted(n for n in source if source[n] != made.get(n))}")
            self.failpoint("before_publish")
            candidate = Candidate(candidate.id, candidate.published_id, candidate.state, validated=True).to(CandidateState.PUBLISHING)
            if not candidate.publishable:
                raise StandbyError("the candidate is not publishable")
            self.standby.write_manifest(self._manifest(generation, counts, operation=operation, artifact_sha256=self.standby.digest_of_files(self.spark, generation), digests={n: d for n, (_, d) in made.items()}))
            self.standby.publish(generation, self.failpoint)
        except BaseException:
            if self.standby.current() != generation:
                self.standby.discard(generation)
            raise
        self.standby.retain(self.keep)
        return generation

    def _guards(self) -> dict:
        manifest = self.standby.manifest()
        if manifest is None or not manifest.get("validated"):
            raise StandbyError("the standby has no valid manifest: a rebuild is required")
        expected = {"profile": str(self.profile), "primary_engine": str(self.primary.engine), "standby_engine": str(self.standby.engine), "schema_fingerprint": self.fingerprint()}
        wrong = [k for k, v in expected.items() if manifest.get(k) != v]
        if wrong:
            raise StandbyError(f"{', '.join(wrong)} changed since the last rebuild: a rebuild is required")
        if self.inventory.objects:
            raise StandbyError(f"the primary has objects that no standby can hold: {sorted(n for _, n in self.inventory.objects)}")
        for role, store in (("standby", self.standby), ("primary", self.primary)):
            differences = self.schema_differences(store, store.current())
            if differences:
                raise StandbyError(f"the {role}'s schema is not the inventoried one ({'; '.join(differences)}): a rebuild is required")
        return manifest

    def sync_once(self, log: DataFrame, acks: DataFrame | None = None, limit: int = capture.DEFAULT_BATCH) -> tuple[SyncResult, list[int]]:
        """Apply one bounded batch of pending events; returns the result and the exact ids to acknowledge."""
        capture.checked_limit(limit)
        with self.standby.locked("sync"):
            manifest, snapshot = self._guards(), self.primary.current()
            schema = self.observed(self.primary, snapshot)
            waiting = log if acks is None else capture.unacknowledged(log, acks)
            batch = capture.pending(waiting, limit)
            ids = [r[0] for r in batch.select("event_id").collect()]  # at most ``limit`` ids
            if not ids:
                return SyncResult(SyncOutcome.NO_WORK), []
            events = waiting.filter(F.col("event_id").isin(ids))
            by_name = {t.name: t for t in self.inventory.tables}
            keyed = {t.name: list(self.key_of(t)) for t in by_name.values()}
            tables = self.spark.createDataFrame([(n, keyed[n], self.decision(t) is Decision.SCHEMA_ONLY) for n, t in by_name.items()], "table_name string, key_columns array<string>, schema_only boolean")
            reduction.require_tables(events, tables)
            identities = reduction.dirty_identities(events, tables).select("table_name", "kind", "key").collect()  # at most two for each event
            changed, counts = self._next_generation(identities, by_name, snapshot)
            # the schema must not have moved while the rows were read
            if self._changed(snapshot, schema) == "schema":
                if changed is not None:
                    self.standby.discard(changed)
                raise StandbyError("the primary's schema changed during the batch: its events stay pending")
            if changed is not None:
                self.standby.write_manifest(manifest | {"generation": changed, "operation": "sync", "artifact_sha256": None, "digests": None})
                self.standby.publish(changed, self.failpoint)
                self.standby.retain(self.keep)
            self.failpoint("after_standby_commit_before_ack")
            left = waiting.filter(~F.col("event_id").isin(ids)).count()
            return SyncResult(SyncOutcome.MORE_PENDING if left else SyncOutcome.CAUGHT_UP, len(ids), len(identities), pending=left, **counts), ids

    def _next_generation(self, identities: list, by_name: dict[str, Table], snapshot: str) -> tuple[str | None, dict[str, int]]:
        counts = {"upserts": 0, "deletes": 0, "table_dirty": 0, "policy_noops": 0, "table_reconciliations": 0}
        whole = {i["table_name"] for i in identities if i["kind"] == "table"}
        keys: dict[str, list[str]] = {}
        for i in identities:
            if i["kind"] != "table":
                keys.setdefault(i["table_name"], []).append(i["key"])
        rewritten: dict[str, tuple[DataFrame, Layout | None, list[int]]] = {}
        for name in sorted(whole):
            counts["table_reconciliations"] += 1
            if self.decision(by_name[name]) is Decision.SCHEMA_ONLY:
                counts["policy_noops"] += 1
                continue
            if by_name[name].foreign_keys or any(fk.parent == name for t in by_name.values() for fk in t.foreign_keys):
                raise StandbyError(f"{name} takes part in foreign keys and must not be replaced: a rebuild is required")
            counts["table_dirty"] += 1
            rewritten[name] = sync.replaced(self._read(self.primary, by_name[name], snapshot), self._read(self.standby, by_name[name])), None, []
        for name, texts in sorted(keys.items()):
            rewritten[name] = self._changed_buckets(by_name[name], texts, snapshot, counts)
        if not rewritten:
            return None, counts
        generation = self.standby.new_generation()
        try:
            for name in sorted(by_name):
                if name in rewritten:
                    rows, base, touched = rewritten[name]
                    self.standby.write(rows, generation, name, self.key_of(by_name[name]), base, touched)
                else:
                    self.standby.adopt(generation, name, self.standby.layout(name))
            self.standby.seal(generation)
        except BaseException:
            self.standby.discard(generation)
            raise
        return generation, counts

    def _changed_buckets(self, table: Table, texts: list[str], snapshot: str, counts: dict[str, int]) -> tuple[DataFrame, Layout | None, list[int]]:
        """The rows of the buckets that the keys fall into after the batch; of a standby table without such buckets, all rows."""
        key, layout = list(self.key_of(table)), self.standby.layout(table.name)
        types = {n: json.loads(t) for n, t in layout.columns}
        parsed = self.spark.createDataFrame([(t,) for t in texts], "key string").select(F.from_json("key", "map<string,string>").alias("m"))
        dirty = parsed.select(*(F.element_at("m", c).cast(types[c]).alias(c) for c in key))
        touched, base = None, None
        if list(layout.key) == key:
            touched, base = sorted(r[0] for r in dirty.select(bucket_of(key, layout.buckets)).distinct().collect()), layout
        columns = [c.name for c in table.visible]
        source, source_buckets = self.primary.layout(table.name, snapshot), None
        if list(source.key) == key and all((c, json.dumps(types[c])) in source.columns for c in key):
            source_buckets = sorted(r[0] for r in dirty.select(bucket_of(key, source.buckets)).distinct().collect())
        rows = self.primary.read(self.spark, table.name, snapshot, source_buckets).select(columns)
        hit = rows.join(F.broadcast(dirty), key, "left_semi")  # at most one row for each event of the batch
        current = sync.current_rows(dirty, hit, key).cache()
        for r in current.groupBy("action").count().collect():
            counts[f"{r['action']}s"] += r["count"]
        standby = self.standby.read(self.spark, table.name, None, touched).select(columns)
        return sync.applied(standby, current, key), base, touched or []

    def reconcile(self, foreign_objects: int = 0) -> tuple[Status, list[dict]]:
        """(status, one row per table); reads only.  Contents are compared where both sides have the same columns."""
        manifest = self.standby.manifest()
        generation, snapshot = self.standby.current(), self.primary.current()
        seen = {"p": self.observed(self.primary, snapshot), "s": self.observed(self.standby, generation)}
        expected = {t.name: [c.name for c in t.visible] for t in self.inventory.tables}
        signed = {side: {n: [(c, k) for c, k in columns if side == "s" or n not in expected or c in expected[n]] for n, columns in found.items()} for side, found in seen.items()}
        alike = [t for t in self.inventory.tables if t.name in seen["s"] and signed["p"].get(t.name) == signed["s"][t.name]]
        contents = {side: self._side(store, alike, gen) for side, store, gen in (("p", self.primary, snapshot), ("s", self.standby, generation))} if alike else {"p": {}, "s": {}}
        frames = []
        for side in ("p", "s"):
            rows = [(n, json.dumps(columns), *contents[side].get(n, (0, ""))) for n, columns in sorted(signed[side].items()) if side == "s" or n in expected]
            frames.append(self.spark.createDataFrame(rows, "table_name string, signature string, row_count long, digest string"))
        found = table_results(*frames, self.profile).orderBy("table_name").collect()
        rows = [{"table": r["table_name"], "issue": None if r["first_issue"] == "none" else r["first_issue"], "expected": r["expected_rows"], "actual": r["actual_rows"]} for r in found]
        issues = {r["issue"] for r in rows}
        artifact = (manifest or {}).get("artifact_sha256")
        try:
            require_importable(catalog_of(self.spark, self.inventory), str(self.standby.engine))
            unsupported = False
        except StandbyError:
            unsupported = True
        status = status_of(
            self.spark, manifest_missing=manifest is None, unsupported=unsupported, drift=bool(issues - {None}), objects=foreign_objects > 0 or bool(self.inventory.objects),
            fingerprint_changed=manifest is not None and manifest["schema_fingerprint"] != self.fingerprint(), integrity_failed=bool(generation and not issues & {"table_set", "schema"} and self.integrity(generation)),
            artifact_mismatch=bool(artifact and generation and artifact != self.standby.digest_of_files(self.spark, generation)), manifest_failing=manifest is not None and not manifest.get("passing"),
        )
        return status, rows

    def _side(self, store: Store, tables: list[Table], generation: str) -> dict[str, tuple[int, str]]:
        found = {r["table_name"]: (r["row_count"], r["digest"]) for r in content({t.name: (self._read(store, t, generation), t) for t in tables}).collect()}
        return {t.name: found.get(t.name, (0, "0" * 64)) for t in tables}
