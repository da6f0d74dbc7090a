"""Draining a change log that arrives as files.

The stream's offset is the arrival of files, never an event id: an id may become visible after a higher one, and only
its own acknowledgement settles it.  Each micro-batch appends its events to the log table, then bounded sync batches run
until nothing is pending.
"""

from __future__ import annotations

import json
import os
import shutil
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..model import Inventory, StandbyError, SyncOutcome, SyncResult
from ..operators.capture import DEFAULT_BATCH, LOG_SCHEMA, acknowledgement, capture_status, identity_kind
from ..operators.capture_ddl import log_ddl, trigger_ddl
from ..plans.replicator import Replicator


class ChangeFeed:
    """A log, its acknowledgements and the record of the installed capture under one folder."""

    def __init__(self, spark: SparkSession, root: Path):
        self.spark, self.root = spark, root

    def install(self, inventory: Inventory) -> Row:
        """Record the log and the triggers of all tables; what is there stays, so that doing it again changes nothing."""
        self.root.mkdir(parents=True, exist_ok=True)
        found = self._installed()
        for table in inventory.tables:
            found |= {name: text for name, text in trigger_ddl(table, inventory.engine).items() if name not in found}
        partial = self.root / "capture.partial"
        partial.write_text(json.dumps({"log": log_ddl(inventory.engine), "triggers": found}, indent=1, sort_keys=True))
        os.replace(partial, self.root / "capture.json")
        return self.status(inventory)

    def _installed(self) -> dict[str, str]:
        path = self.root / "capture.json"
        return json.loads(path.read_text())["triggers"] if path.exists() else {}

    def status(self, inventory: Inventory) -> Row:
        """Tracked tables, expected and installed triggers by name, and whether all are there."""
        names = lambda found: self.spark.createDataFrame([(n,) for n in found], "trigger_name string")
        plan = self.spark.createDataFrame([(t.name, str(identity_kind(t))) for t in inventory.tables], "table_name string, identity_kind string")
        expected = [n for t in inventory.tables for n in trigger_ddl(t, inventory.engine)]
        return capture_status(names(expected), names(self._installed()), plan).first()

    def log(self) -> DataFrame:
        path = self.root / "log"
        return self.spark.read.schema(LOG_SCHEMA).parquet(str(path)).dropDuplicates(["event_id"]) if path.exists() else self.spark.createDataFrame([], LOG_SCHEMA)

    def acks(self) -> DataFrame:
        path = self.root / "acks"
        return self.spark.read.schema("event_id long").parquet(str(path)) if path.exists() else self.spark.createDataFrame([], "event_id long")

    def append(self, events: DataFrame, batch_id: int | None = None) -> None:
        """A replayed micro-batch writes over its own folder, so it adds nothing twice."""
        target = self.root / "log" / (f"batch={batch_id}" if batch_id is not None else "batch=-1")
        events.select([f.name for f in LOG_SCHEMA.fields]).write.mode("append" if batch_id is None else "overwrite").parquet(str(target))

    def acknowledge(self, ids: list[int]) -> None:
        if ids:
            acknowledgement(self.spark, ids).coalesce(1).write.mode("append").parquet(str(self.root / "acks"))


    def compact(self) -> None:
        """Remove the log's batches of which every event is acknowledged; the acknowledgements stay for replayed batches."""
        path = self.root / "log"
        if not path.exists():
            return
        batches = self.spark.read.schema("event_id long, batch long").option("basePath", str(path)).parquet(str(path))
        acks = self.acks().distinct().withColumn("done", F.lit(True))
        for r in batches.join(acks, "event_id", "left").groupBy("batch").agg(F.count("*").alias("n"), F.count("done").alias("done")).collect():
            if r["n"] == r["done"]:
                shutil.rmtree(path / f"batch={r['batch']}")
        if not any(path.iterdir()):
            path.rmdir()


def drain(replicator: Replicator, feed: ChangeFeed, limit: int = DEFAULT_BATCH, most_batches: int | None = None) -> list[SyncResult]:
    """Sync batch after batch, acknowledging each after its commit, until caught up."""
    if not feed.status(replicator.inventory)["healthy"]:
        raise StandbyError("change capture is not installed on all tables: events may be missing")
    done: list[SyncResult] = []
    while most_batches is None or len(done) < most_batches:
        result, ids = replicator.sync_once(feed.log(), feed.acks(), limit)
        feed.acknowledge(ids)
        done.append(result)
        if result.outcome is not SyncOutcome.MORE_PENDING:
            feed.compact()
            break
    return done


def start(replicator: Replicator, feed: ChangeFeed, arriving: str, checkpoint: str, limit: int = DEFAULT_BATCH, after: Callable[[list[SyncResult]], None] | None = None) -> StreamingQuery:
    """Read all event files that have arrived (JSON lines) and drain them."""
    stream = feed.spark.readStream.schema(LOG_SCHEMA).json(arriving)

    def settle(events: DataFrame, batch_id: int) -> None:
        feed.append(events, batch_id)
        done = drain(replicator, feed, limit)
        if after:
            after(done)

    return stream.writeStream.foreachBatch(settle).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
