"""Command line: ``python -m standbyspark.cli COMMAND --config FILE``.

The config is JSON: primary and standby (root, engine), profile, keep, and tables (name: {key: [...]}).
Exit codes: 0 done and sound, 1 refused or not sound, 2 wrong usage.
"""

from __future__ import annotations

import argparse
import json
import sys
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from .model import DestinationNotEmpty, Engine, Inventory, NonEmptyPolicy, Profile, StandbyError, Status
from .operators.capture import MAX_BATCH, backlog, identity_kind, unacknowledged
from .operators.portability import issues, severity_counts
from .plans import backup as backups
from .plans.replicator import Replicator
from .plans.store import KEEP, Store
from .sources.catalog import catalog_of, table_of
from .streaming.runner import ChangeFeed, drain

REPORTED = 20  #: warnings that a report lists


def _session() -> SparkSession:
    return SparkSession.builder.appName("standbyspark").getOrCreate()


def replicator(spark: SparkSession, config: dict, profile: str | None = None) -> Replicator:
    stores = {}
    for role, engine in (("primary", Engine.MYSQL), ("standby", Engine.SQLITE)):
        own = config[role]
        stores[role] = Store(Path(own["root"]), Engine(own.get("engine", engine)), role)
    primary = stores["primary"]
    tables = tuple(table_of(name, primary.read(spark, name), config.get("tables", {}).get(name, {}).get("key", ())) for name in primary.tables())
    return Replicator(spark, primary, stores["standby"], Inventory(primary.engine, tables), Profile(profile or config.get("profile", "full")), int(config.get("keep", KEEP)))


def listed(found: DataFrame, most: int | None = None) -> list[str]:
    """One line an issue; beyond ``most``, how many more there are."""
    ordered = found.orderBy("table_name", "column_name", "code")
    lines = [f"{r['severity'].upper()}: {'.'.join(x for x in (r['table_name'], r['column_name']) if x)} {r['code']}" for r in (ordered.limit(most) if most else ordered).collect()]
    more = found.count() - len(lines)
    return [*lines, f"... and {more} additional issues."] if more else lines


def main(args: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser("standbyspark")
    parser.add_argument("command", choices=["doctor", "preflight", "backup", "restore", "import", "rebuild", "reconcile", "capture:install", "capture:status", "sync"])
    parser.add_argument("file", nargs="?", type=Path)
    parser.add_argument("--config", type=Path, required=True)
    parser.add_argument("--profile", choices=[str(p) for p in Profile])
    parser.add_argument("--on-non-empty", choices=[str(p) for p in NonEmptyPolicy], default="abort")
    parser.add_argument("--role", choices=["primary", "standby"], default="standby")
    parser.add_argument("--compression", choices=["none", "gzip"], default="gzip")
    parser.add_argument("--output", type=Path)
    parser.add_argument("--limit", type=int, default=500)
    parser.add_argument("--once", action="store_true")
    try:
        options = parser.parse_args(args)
    except SystemExit as stop:
        return int(stop.code or 0)
    try:
        return _run(options, json.loads(options.config.read_text()))
    except DestinationNotEmpty as refused:
        print(f"The standby is not empty; nothing was changed. {refused}", file=sys.stderr)
    except StandbyError as refused:
        print(refused, file=sys.stderr)
    return 1


def _run(o: argparse.Namespace, config: dict) -> int:
    spark = _session()
    r = replicator(spark, config, o.profile)
    output = o.output or r.standby.root / "backups"
    if o.command == "doctor":
        print(f"primary {r.primary.identity}\nstandby {r.standby.identity}\nprofile {r.profile}")
        return 0
    if o.command == "preflight":
        reported = issues(catalog_of(spark, r.inventory))
        found = {x["severity"]: x["n"] for x in severity_counts(reported).collect()}
        empty = not r.standby.tables()
        print("\n".join(listed(reported.filter("severity = 'error'")) + listed(reported.filter("severity <> 'error'"), REPORTED)), file=sys.stderr)
        print(json.dumps({"tables": len(r.inventory.tables), "errors": found.get("error", 0), "warnings": found.get("warning", 0), "standby_empty": empty}))
        return 0 if empty and not found.get("error") else 1
    if o.command == "backup":
        made = backups.backup(r.primary if o.role == "primary" else r.standby, output, o.compression)
        print(json.dumps({"path": str(made.path), "bytes": made.bytes, "sha256": made.sha256}))
        return 0
    if o.command == "restore":
        if o.file is None:
            print("restore needs a file", file=sys.stderr)
            return 2
        if r.standby.tables():
            if o.on_non_empty == "abort":
                raise DestinationNotEmpty(str(r.standby.tables()))
            if o.on_non_empty == "backup_then_clear":
                backups.checked(backups.backup(r.standby, output), r.standby.engine)
        print(backups.restore(spark, r.standby, o.file))
        return 0
    if o.command == "import":
        print(r.import_(NonEmptyPolicy(o.on_non_empty), lambda store: backups.checked(backups.backup(store, output), store.engine)))
        return 0
    if o.command == "rebuild":
        print(r.rebuild())
        return 0
    if o.command == "reconcile":
        status, rows = r.reconcile()
        print(json.dumps({"status": status, "tables": rows}))
        return 0 if status is Status.MATCH else 1
    feed = ChangeFeed(spark, r.primary.root / "changes")
    if o.command == "capture:install":
        print(json.dumps(feed.install(r.inventory).asDict()))
        return 0
    if o.command == "capture:status":
        status = feed.status(r.inventory).asDict()
        waiting = backlog(unacknowledged(feed.log(), feed.acks())).first().asDict()
        print(json.dumps(status | waiting | {"tables": {t.name: identity_kind(t) for t in r.inventory.tables}}))
        return 0 if status["healthy"] else 1
    if not 1 <= o.limit <= MAX_BATCH:
        print(f"--limit is 1 to {MAX_BATCH}", file=sys.stderr)
        return 2
    for result in drain(r, feed, o.limit, most_batches=1):
        print(json.dumps({k: str(v) if k == "outcome" else v for k, v in vars(result).items()}))
    return 0


if __name__ == "__main__":
    sys.exit(main())
