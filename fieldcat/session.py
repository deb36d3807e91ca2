"""Session helpers: one place for the configuration every job relies on."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(master: str | None = None, app: str = "fieldcat",
                  shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Local/test session. On a cluster the submitter's configuration wins:
    ``getOrCreate`` reuses an existing session and only fills unset keys."""
    master = master or os.environ.get("FIELDCAT_MASTER", "local[8]")
    cores = _cores(master)
    builder = (
        SparkSession.builder.master(master).appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or max(cores * 2, 8)))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("FIELDCAT_DRIVER_MEMORY", "16g"))
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.sql.streaming.stateStore.providerClass",
                "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    )
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _cores(master: str) -> int:
    inner = master[master.find("[") + 1: master.find("]")] if "[" in master else "1"
    return os.cpu_count() or 8 if inner == "*" else int(inner)


def checkpoint_root(spark: SparkSession) -> str | None:
    """The shared folder the cluster names for checkpoints, if any."""
    conf = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if conf:
        return conf
    return spark.sparkContext.getCheckpointDir()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's ``spark.checkpoint.dir``; set a private one only when
    it is unset (local runs and tests)."""
    root = checkpoint_root(spark)
    if root:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(root)
        return root
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    # unset (local runs, tests): a private folder. ``spark.checkpoint.dir`` is
    # a core setting that cannot be changed at runtime; the context's
    # checkpoint directory is the one place to record it.
    root = tempfile.mkdtemp(prefix="fieldcat-ckpt-")
    spark.sparkContext.setCheckpointDir(root)
    return spark.sparkContext.getCheckpointDir() or root


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh, never-reused folder under the shared checkpoint root."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/{name}-{uuid.uuid4().hex[:12]}"
