"""Field and frame tables (S2, S3) as stored tables, read with their
declared schemas. A reader that decodes instrument files fills these
tables; the engine only ever sees the long form."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldcat.schemas import FIELDS, FRAMES


def read_fields(spark: SparkSession, path: str, keys: list[str] | None = None) -> DataFrame:
    """The long field table; with ``keys`` the key filter sits next to the
    scan (an IN list when short, a min/max range otherwise - write the table
    sorted by key so row groups are skipped)."""
    df = spark.read.schema(FIELDS).parquet(path)
    return df.where(F.col("key").isin(list(dict.fromkeys(keys)))) if keys else df


def read_frames(spark: SparkSession, path: str, first_n: int | None = None) -> DataFrame:
    """Frames, optionally only the first ``first_n`` of every stack (pushed
    down as ``frame_idx < n``)."""
    df = spark.read.schema(FRAMES).parquet(path)
    return df.where(F.col("frame_idx") < first_n) if first_n is not None else df


def write_fields(fields: DataFrame, path: str, mode: str = "append") -> None:
    """Store a field table clustered by key (min/max statistics then prune
    scans that ask for a few keys)."""
    fields.repartitionByRange("key", "file_path").sortWithinPartitions("key", "file_path") \
        .write.mode(mode).parquet(path)
