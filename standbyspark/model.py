"""Value objects of the replication engine: identities, states and reports.  None of them holds row data."""

from __future__ import annotations

import re
from dataclasses import dataclass, field, replace
from enum import StrEnum


class StandbyError(RuntimeError):
    """Base of all errors raised on purpose."""


class DestinationNotEmpty(StandbyError):
    pass


class NotPortable(StandbyError):
    pass


class Engine(StrEnum):
    MYSQL = "mysql"
    SQLITE = "sqlite"


class Role(StrEnum):
    PRIMARY = "primary"
    STANDBY = "standby"


class Profile(StrEnum):
    FULL = "full"
    CLEAN = "clean"


class Decision(StrEnum):
    COPY = "copy"
    SCHEMA_ONLY = "schema_only"


class Operation(StrEnum):
    INSERT = "insert"
    UPDATE = "update"
    DELETE = "delete"


class IdentityKind(StrEnum):
    PRIMARY_KEY = "primary_key"
    TABLE = "table"


class Status(StrEnum):
    MATCH = "MATCH"
    DRIFT = "DRIFT"
    REBUILD_REQUIRED = "REBUILD_REQUIRED"
    BLOCKED = "BLOCKED"


class SyncOutcome(StrEnum):
    NO_WORK = "NO_WORK"
    CAUGHT_UP = "CAUGHT_UP"
    MORE_PENDING = "MORE_PENDING"


class NonEmptyPolicy(StrEnum):
    ABORT = "abort"
    BACKUP_THEN_CLEAR = "backup_then_clear"
    CLEAR = "clear"


class CandidateState(StrEnum):
    CREATED = "created"
    BUILDING = "building"
    BUILT = "built"
    VALIDATING = "validating"
    VALID = "valid"
    INVALID = "invalid"
    PUBLISHING = "publishing"
    PUBLISHED = "published"
    DISCARDED = "discarded"


_NEXT = {
    CandidateState.CREATED: {CandidateState.BUILDING},
    CandidateState.BUILDING: {CandidateState.BUILT},
    CandidateState.BUILT: {CandidateState.PUBLISHING},
    CandidateState.PUBLISHING: {CandidateState.PUBLISHED},
}


@dataclass(frozen=True)
class Column:
    """One column in portable terms; ``portable`` is a name of ``functions.types.PORTABLE`` or ``unknown``."""

    name: str
    native: str
    portable: str
    nullable: bool = True
    default: str | None = None
    unsigned: bool = False
    length: int | None = None
    precision: int | None = None
    scale: int | None = None
    auto_increment: bool = False
    generated: bool = False
    collation: str | None = None
    hidden: bool = False


@dataclass(frozen=True)
class IndexColumn:
    name: str | None
    prefix_length: int | None = None
    expression: str | None = None
    descending: bool = False


@dataclass(frozen=True)
class Index:
    name: str
    columns: tuple[IndexColumn, ...]
    unique: bool = False
    primary: bool = False
    kind: str = "btree"
    partial: bool = False
    predicate: str | None = None

    @property
    def functional(self) -> bool:
        return any(c.expression for c in self.columns)


@dataclass(frozen=True)
class ForeignKey:
    name: str
    columns: tuple[str, ...]
    parent: str
    parent_columns: tuple[str, ...]
    on_update: str = "RESTRICT"
    on_delete: str = "RESTRICT"

    def __post_init__(self) -> None:
        if not self.columns or len(self.columns) != len(self.parent_columns):
            raise ValueError("a foreign key pairs each column with one of its parent")


@dataclass(frozen=True)
class Table:
    name: str
    columns: tuple[Column, ...]
    primary_key: tuple[str, ...] = ()
    indexes: tuple[Index, ...] = ()
    foreign_keys: tuple[ForeignKey, ...] = ()
    engine: str | None = None
    collation: str | None = None
    strict: bool = False

    @property
    def visible(self) -> tuple[Column, ...]:
        found = tuple(c for c in self.columns if not c.hidden)
        if not found:
            raise StandbyError(f"{self.name} has no visible column")
        return found

    def column(self, name: str) -> Column:
        return next(c for c in self.columns if c.name == name)


@dataclass(frozen=True)
class Inventory:
    engine: Engine
    tables: tuple[Table, ...]
    objects: tuple[tuple[str, str], ...] = ()  #: (type, name) of views, triggers, routines, events

    def table(self, name: str) -> Table | None:
        return next((t for t in self.tables if t.name == name), None)


@dataclass(frozen=True)
class Endpoint:
    """One side of the topology: a key, an engine and the canonical identity of where its data lies."""

    role: Role
    key: str
    engine: Engine
    identity: str


@dataclass(frozen=True)
class Topology:
    primary: Endpoint
    standby: Endpoint

    def __post_init__(self) -> None:
        if self.primary.key == self.standby.key:
            raise StandbyError("primary and standby need different keys")
        if self.primary.engine == self.standby.engine:
            raise StandbyError("primary and standby need different engines")
        if self.primary.identity == self.standby.identity:
            raise StandbyError("primary and standby are the same data")

    def allows(self, profile: Profile) -> bool:
        return profile is Profile.FULL or self.standby.engine is Engine.SQLITE


@dataclass(frozen=True)
class NameMap:
    """One-to-one table names of source and candidate; other names stay."""

    names: dict[str, str] = field(default_factory=dict)

    def __post_init__(self) -> None:
        if len(set(self.names.values())) != len(self.names):
            raise ValueError("two tables would get one name")

    def target(self, name: str) -> str:
        return self.names.get(name, name)


@dataclass(frozen=True)
class Candidate:
    id: str
    published_id: str
    state: CandidateState = CandidateState.CREATED
    validated: bool = False

    def __post_init__(self) -> None:
        if self.id == self.published_id:
            raise StandbyError("a candidate is never the published generation")

    def to(self, state: CandidateState) -> Candidate:
        if state not in _NEXT.get(self.state, set()) and state is not CandidateState.DISCARDED:
            raise StandbyError(f"a candidate does not go from {self.state} to {state}")
        return replace(self, state=state)

    @property
    def publishable(self) -> bool:
        return self.validated and self.state is CandidateState.PUBLISHING


@dataclass(frozen=True)
class SyncResult:
    outcome: SyncOutcome
    events: int = 0
    identities: int = 0
    upserts: int = 0
    deletes: int = 0
    table_dirty: int = 0
    policy_noops: int = 0
    table_reconciliations: int = 0
    pending: int = 0


GENERATION = re.compile(r"^[a-f0-9]{32}$")
