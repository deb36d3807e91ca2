"""Quality reports: duplicate ids (A7) and first-wins dedupe (A8)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def duplicate_ids(df: DataFrame, keys: list[str], count_col: str = "n_rows") -> DataFrame:
    """Keys held by more than one row. The count is aggregated map-side
    first, so a hot key costs one partial count per task."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_col))
            .where(F.col(count_col) > 1))


def first_wins(df: DataFrame, key: str | list[str], order: list[str]) -> DataFrame:
    """The first row of every key by ``order`` (which must break ties).
    ``min_by`` is a partial aggregate: no group is ever gathered whole."""
    keys = [key] if isinstance(key, str) else list(key)
    rest = [c for c in df.columns if c not in keys]
    picked = F.min_by(F.struct(*rest), F.struct(*order)).alias("_first")
    return df.groupBy(*keys).agg(picked).select(*keys, "_first.*")
