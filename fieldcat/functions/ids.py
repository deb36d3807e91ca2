"""Identifiers (F14) and clock (F15)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def natural_id(*cols: Column | str) -> Column:
    """Deterministic id: SHA-256 of the natural key parts joined by '/'.
    Replays produce the same id, which makes upserts idempotent."""
    parts = [F.col(c) if isinstance(c, str) else c for c in cols]
    return F.sha2(F.concat_ws("/", *parts), 256)


def new_id() -> Column:
    """A random identifier, for records with no natural key."""
    return F.expr("uuid()")


def utc_now() -> Column:
    return F.current_timestamp()
