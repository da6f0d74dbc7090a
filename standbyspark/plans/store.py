"""A store of table generations: immutable version folders, one pointer, manifests, retention, lock, failpoints.

Data is written by Spark into ``generations/<id>/<table>``, keyed tables in buckets of their keys' hash; control files are
small and handled by the driver on the same (mounted) file system.  A generation is a set of layouts, one for each table,
that name the folders its rows lie in: a new generation writes the buckets it changes and refers to all others where
they are.  Folders go when no generation refers to them.  The pointer swap is one ``os.replace``, so all tables change together.
"""

from __future__ import annotations

import fcntl
import hashlib
import json
import os
import re
import shutil
import time
import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import UTC, datetime
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..model import GENERATION, Engine, StandbyError

KEEP, BUCKETS = 3, 16
#: Fixed value: keys that a manifest must not have.
_SECRET = re.compile(r"password|secret|credential|dsn|username", re.IGNORECASE)

Failpoint = Callable[[str], None]


def no_failure(point: str) -> None:
    """The failpoint hook of normal operation."""


def refuse_secrets(value: object, path: str = "") -> None:
    if isinstance(value, dict):
        for k, v in value.items():
            if _SECRET.search(str(k)):
                raise StandbyError(f"a manifest holds no secrets: {path}{k}")
            refuse_secrets(v, f"{path}{k}.")
    elif isinstance(value, list):
        for v in value:
            refuse_secrets(v, path)


def private_dir(path: Path) -> Path:
    """A folder for artifacts: absolute, no link, closed to others; made if missing."""
    if not path.is_absolute() or path.is_symlink():
        raise StandbyError(f"{path} must be absolute and no link")
    path.mkdir(mode=0o700, parents=True, exist_ok=True)
    if path.stat().st_mode & 0o077:
        raise StandbyError(f"{path} is open to others")
    return path


def bucket_of(key: Sequence[str], buckets: int) -> Column:
    """The bucket of a row; columns must have the types they are stored with."""
    return F.pmod(F.xxhash64(*(F.col(c) for c in key)), F.lit(buckets)).cast("int")


@dataclass(frozen=True)
class Layout:
    """Where the rows of one table of a generation lie.

    parts: folder of each bucket (of all rows, if there is no key) as (generation or null for the own one, path in it).
    """

    schema: dict
    key: tuple[str, ...]
    buckets: int
    parts: dict[str, tuple[str | None, str]]

    @property
    def columns(self) -> tuple[tuple[str, str], ...]:
        return tuple((f["name"], json.dumps(f["type"])) for f in self.schema["fields"])


@dataclass(frozen=True)
class Store:
    root: Path
    engine: Engine = Engine.SQLITE
    key: str = "standby"
    buckets: int = BUCKETS  #: of keyed tables written from now on

    @property
    def identity(self) -> str:
        return f"{self.engine}:{self.root.resolve()}"

    @property
    def destination_id(self) -> str:
        return hashlib.sha256(self.identity.encode()).hexdigest()

    @property
    def generations(self) -> Path:
        return self.root / "generations"

    def current(self) -> str | None:
        """The published generation, if any."""
        pointer = self.root / "CURRENT"
        if not pointer.exists():
            return None
        name = pointer.read_text().strip()
        if not GENERATION.fullmatch(name):
            raise StandbyError(f"the pointer names no generation: {name!r}")
        return name

    def _folder(self, generation: str) -> Path:
        partial = self.generations / f"{generation}.partial"
        return partial if partial.is_dir() else self.generations / generation

    def tables(self, generation: str | None = None) -> list[str]:
        generation = generation or self.current()
        return sorted(p.name.removesuffix(".layout.json") for p in self._folder(generation).glob("*.layout.json")) if generation else []

    def layout(self, table: str, generation: str | None = None) -> Layout:
        """The layout of a table with all generations named."""
        generation = generation or self.current()
        if generation is None:
            raise StandbyError("nothing is published")
        path = self._folder(generation) / f"{table}.layout.json"
        if not path.exists():
            raise StandbyError(f"{generation} has no table {table}")
        found = json.loads(path.read_text())
        return Layout(found["schema"], tuple(found["key"]), found["buckets"], {b: (g or generation, rel) for b, (g, rel) in found["parts"].items()})

    def folders(self, layout: Layout, buckets: Sequence[int] | None = None) -> list[str]:
        wanted = layout.parts if buckets is None or not layout.key else {str(b) for b in buckets} & layout.parts.keys()
        return [str(self._folder(layout.parts[b][0]) / layout.parts[b][1]) for b in sorted(wanted)]

    def read(self, spark: SparkSession, table: str, generation: str | None = None, buckets: Sequence[int] | None = None) -> DataFrame:
        """All rows of a table, or those of some buckets."""
        layout = self.layout(table, generation)
        schema, folders = T.StructType.fromJson(layout.schema), self.folders(layout, buckets)
        return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)

    def new_generation(self) -> str:
        generation = uuid.uuid4().hex
        (self.generations / f"{generation}.partial").mkdir(parents=True)
        return generation

    def _noted(self, generation: str, table: str, layout: Layout) -> None:
        body = {"schema": layout.schema, "key": layout.key, "buckets": layout.buckets, "parts": layout.parts}
        (self._folder(generation) / f"{table}.layout.json").write_text(json.dumps(body, sort_keys=True))

    def write(self, df: DataFrame, generation: str, table: str, key: Sequence[str] = (), base: Layout | None = None, touched: Sequence[int] = ()) -> None:
        """Write a table into a generation that is being made.

        With ``base``, ``df`` has the rows of the ``touched`` buckets only, and the others are those of ``base``.
        """
        folder = self._folder(generation) / table
        n = base.buckets if base else self.buckets if key else 1
        parts: dict[str, tuple[str | None, str]] = {b: p for b, p in base.parts.items() if int(b) not in set(touched)} if base else {}
        if key:
            name = "bucket"
            while name in {c.lower() for c in df.columns}:
                name += "_"
            df.withColumn(name, bucket_of(key, n)).repartition(F.col(name)).write.mode("error").partitionBy(name).parquet(str(folder))
            parts |= {p.name.partition("=")[2]: (None, f"{table}/{p.name}") for p in folder.iterdir() if p.is_dir() and "=" in p.name}
        else:
            df.write.mode("error").parquet(str(folder))
            parts = {"all": (None, table)}
        self._noted(generation, table, Layout(df.schema.jsonValue(), tuple(key), n, parts))

    def adopt(self, generation: str, table: str, layout: Layout) -> None:
        """The table is the one that ``layout`` describes; nothing is copied."""
        self._noted(generation, table, layout)

    def seal(self, generation: str) -> None:
        os.replace(self.generations / f"{generation}.partial", self.generations / generation)

    def publish(self, generation: str, failpoint: Failpoint = no_failure) -> str | None:
        """Point at a sealed generation; returns the one that was current."""
        before = self.current()
        if not (self.generations / generation).is_dir():
            raise StandbyError(f"{generation} is not sealed")
        partial = self.root / "CURRENT.partial"
        with partial.open("w") as out:
            out.write(generation)
            out.flush()
            os.fsync(out.fileno())
        failpoint("during_publish")
        os.replace(partial, self.root / "CURRENT")
        (self.generations / generation / "PUBLISHED").touch()
        return before

    def discard(self, generation: str) -> None:
        """Remove a candidate; the published generation is never removed."""
        if not GENERATION.fullmatch(generation) or generation == self.current():
            raise StandbyError(f"{generation} must not be discarded")
        for folder in (self.generations / generation, self.generations / f"{generation}.partial"):
            if folder.is_dir() and not folder.is_symlink():
                for layout in folder.glob("*.layout.json"):
                    layout.unlink()
        self._collect()

    def _listed(self) -> list[Path]:
        """Folders of generations that have layouts, so are generations still."""
        return [p for p in self.generations.iterdir() if GENERATION.fullmatch(p.name.removesuffix(".partial")) and any(p.glob("*.layout.json"))] if self.generations.is_dir() else []

    def _collect(self) -> None:
        """Remove the folders that no layout refers to any more."""
        listed = self._listed()
        used = {(g or p.name.removesuffix(".partial"), rel) for p in listed for f in p.glob("*.layout.json") for g, rel in json.loads(f.read_text())["parts"].values()}
        current = self.current()
        for folder in [p for p in self.generations.iterdir() if p not in listed and not p.is_symlink() and GENERATION.fullmatch(p.name.removesuffix(".partial")) and p.name != current]:
            keep = {rel for g, rel in used if g == folder.name.removesuffix(".partial")}
            if not keep:
                shutil.rmtree(folder)
                continue
            for table in [p for p in folder.iterdir() if p.is_dir() and p.name not in keep]:
                for part in [p for p in table.iterdir() if p.is_dir() and f"{table.name}/{p.name}" not in keep]:
                    shutil.rmtree(part)
                if not any(p.is_dir() for p in table.iterdir()):
                    shutil.rmtree(table)

    def sweep(self) -> list[str]:
        """Remove what crashed operations left behind: unfinished generations, and finished ones that were never published."""
        current = self.current()
        found = [p for p in self.generations.iterdir() if p.is_dir()] if self.generations.is_dir() else []
        left = [p.name.removesuffix(".partial") for p in found if p.name.endswith(".partial") or p in self._listed() and p.name != current and not (p / "PUBLISHED").exists()]
        for generation in left:
            if GENERATION.fullmatch(generation):
                self.discard(generation)
        return sorted(left)

    def retain(self, keep: int = KEEP) -> list[str]:
        """Keep the current generation and the newest others up to ``keep``; returns what was removed."""
        if keep < 1:
            raise StandbyError("at least one generation is kept")
        current = self.current()
        since = lambda p: (p / "PUBLISHED" if (p / "PUBLISHED").exists() else p).stat().st_mtime
        others = sorted((p for p in self._listed() if GENERATION.fullmatch(p.name) and p.name != current), key=lambda p: (-since(p), p.name))
        gone = [p.name for p in others[keep - 1 :]]
        for generation in gone:
            self.discard(generation)
        return gone

    def write_manifest(self, content: dict) -> Path:
        refuse_secrets(content)
        body = {"version": 2, "destination_id": self.destination_id, "engine": str(self.engine), "written_at": datetime.now(UTC).isoformat(timespec="seconds")} | content
        folder = self.root / "manifests"
        folder.mkdir(parents=True, exist_ok=True)
        target = folder / f"{content.get('generation', 'import')}.json"
        partial = target.with_suffix(".partial")
        with os.fdopen(os.open(partial, os.O_WRONLY | os.O_CREAT | os.O_TRUNC, 0o600), "w") as out:
            json.dump(body, out, indent=1, sort_keys=True)
            out.flush()
            os.fsync(out.fileno())
        os.replace(partial, target)
        return target

    def manifest(self, generation: str | None = None) -> dict | None:
        generation = generation or self.current()
        path = self.root / "manifests" / f"{generation}.json"
        if generation is None or not path.exists():
            return None
        found = json.loads(path.read_text())
        if found.get("destination_id") != self.destination_id:
            raise StandbyError("the manifest belongs to another destination")
        return found

    def manifests(self) -> list[dict]:
        folder = self.root / "manifests"
        found = [json.loads(p.read_text()) for p in sorted(folder.glob("*.json"))] if folder.is_dir() else []
        return [m for m in found if m.get("destination_id") == self.destination_id]

    def digest_of_files(self, spark: SparkSession, generation: str) -> str:
        """SHA-256 over the names and digests of a generation's data files, which executors hash."""
        folders = {str(f): f"{t}/{b}" for t in self.tables(generation) for lay in [self.layout(t, generation)] for b in lay.parts for f in [self._folder(lay.parts[b][0]) / lay.parts[b][1]]}
        total = hashlib.sha256()
        if folders:
            files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(list(folders)).select("path", F.sha2("content", 256).alias("digest"))
            for path, digest in sorted((f"{folders[str(Path(r['path'].removeprefix('file:')).parent)]}/{Path(r['path']).name}", r["digest"]) for r in files.collect()):
                total.update(f"{path}\0{digest}\0".encode())
        return total.hexdigest()

    @contextmanager
    def locked(self, operation: str) -> Iterator[None]:
        """One mutating operation at a time, over all processes; a second one fails at once and names the first."""
        private_dir(self.root / "lock")
        with (self.root / "lock" / "operation.lock").open("a+") as handle:
            try:
                fcntl.flock(handle, fcntl.LOCK_EX | fcntl.LOCK_NB)
            except BlockingIOError:
                handle.seek(0)
                holder = json.loads(handle.read() or "{}")
                raise StandbyError(f"{holder.get('operation', 'an operation')} is running (pid {holder.get('pid', '?')})") from None
            handle.truncate(0)
            handle.write(json.dumps({"operation": operation, "pid": os.getpid(), "started_at": time.time(), "id": uuid.uuid4().hex}))
            handle.flush()
            try:
                yield
            finally:
                handle.truncate(0)
                fcntl.flock(handle, fcntl.LOCK_UN)
