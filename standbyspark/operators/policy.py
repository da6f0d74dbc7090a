"""Replication policies: which tables have their rows copied."""

from __future__ import annotations

from pyspark.sql import Column as C
from pyspark.sql import functions as F

from ..model import Decision, Profile

#: Tables whose rows a clean standby does not need.
TRANSIENT_PREFIX = "cache_"
TRANSIENT = ("cachetags", "sessions", "semaphore", "batch", "watchdog")


def decide(profile: Profile, table: str) -> Decision:
    transient = table.startswith(TRANSIENT_PREFIX) or table in TRANSIENT
    return Decision.SCHEMA_ONLY if profile is Profile.CLEAN and transient else Decision.COPY


def decision(profile: C, table: C) -> C:
    transient = table.startswith(TRANSIENT_PREFIX) | table.isin(*TRANSIENT)
    return F.when((profile == "clean") & transient, "schema_only").otherwise("copy")
