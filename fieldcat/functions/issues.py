"""Issue rows (G3, F16)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fieldcat.schemas import DEFAULT_STAGE


def _lit(x):
    if x is None:
        return F.lit(None).cast("string")
    return F.lit(x) if isinstance(x, str) else x


def issue(severity, msg, stage=DEFAULT_STAGE, exception=None) -> Column:
    """STRUCT<stage, severity, msg, exception>; exception text stays null when
    there is none."""
    return F.struct(
        _lit(stage if stage is not None else DEFAULT_STAGE).cast("string").alias("stage"),
        _lit(severity).cast("string").alias("severity"),
        _lit(msg).cast("string").alias("msg"),
        _lit(exception).cast("string").alias("exception"),
    )
