"""Job inputs from storage (S5, S11, S10): request tables or streams, the
client table and the status-event table, read with declared schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fieldcat.schemas import CLIENTS, JOB_EVENTS, JOB_REQUESTS


def load_clients(spark: SparkSession, path: str) -> DataFrame:
    """API clients: (key_digest, client, api)."""
    return spark.read.schema(CLIENTS).parquet(path)


def read_job_requests(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.schema(JOB_REQUESTS).format(fmt).load(path)


def stream_job_requests(spark: SparkSession, path: str, fmt: str = "json",
                        max_files: int = 100) -> DataFrame:
    """New request files as a stream (e.g. JSON documents dropped by clients)."""
    return (spark.readStream.schema(JOB_REQUESTS).option("maxFilesPerTrigger", max_files)
            .format(fmt).load(path))


def read_job_events(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(JOB_EVENTS).parquet(path)
