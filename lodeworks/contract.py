"""What the engine needs to know about one entity.

A contract is plain data plus small expression builders. Builders are callables
because Spark columns can only be made once a session exists, and because the
processing date (``as_of``) is handed in rather than read from the clock, which
keeps a rerun of an old day reproducible.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql.types import StructType

QUARANTINE = "quarantine"
DISCARD = "discard"

# Given the processing date, the columns one derivation step adds or replaces.
Step = Callable[[Column], dict[str, Column]]


@dataclass(frozen=True)
class Check:
    """One quality rule.

    ``on_invalid`` says where rows go for which the rule is false, and
    ``on_unknown`` where they go when it is NULL (three-valued logic: neither a
    filter on the rule nor one on its negation would return them).
    """

    reason: str
    passes: Callable[[Column], Column]
    on_invalid: str = QUARANTINE
    on_unknown: str = DISCARD


@dataclass(frozen=True)
class Latest:
    """Keep one row per key: the greatest by ``newest_by``, NULLs last."""

    keys: tuple[str, ...]
    newest_by: tuple[str, ...]


@dataclass(frozen=True)
class Contract:
    entity: str
    bronze: StructType
    checks: tuple[Check, ...]
    latest: Latest
    # Cast to the bronze types and project to exactly those columns.
    enforce_types: bool = False
    keep_tokens_in: tuple[str, ...] = ()
    trim: tuple[str, ...] = ()
    upper: tuple[str, ...] = ()
    initcap: tuple[str, ...] = ()
    # True when rejected rows must keep their untrimmed text.
    tidy_text_after_checks: bool = False
    timestamp_from: str | None = None
    timestamp_to: str | None = None
    before_checks: tuple[Step, ...] = ()
    after_dedup: tuple[Step, ...] = ()
    drop: tuple[str, ...] = ()
    record_source: str | None = None
    quarantine_audit: tuple[str, ...] = ()
