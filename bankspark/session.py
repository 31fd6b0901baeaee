"""Session settings the plans rely on, and the shared folder for written intermediates."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settable on a running session. Joins carry no broadcast hints: Catalyst broadcasts a side
# whose estimated size is under the threshold, AQE one whose measured size is; anything
# larger is a sort-merge join whose skewed partitions AQE splits (also when that costs an
# extra exchange, hence forceOptimizeSkewedJoin).
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # State on disk instead of on the heap; read when a stream first starts.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}

_fallback_dir: str | None = None


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session someone else built."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def local_session(cpus: int | str = 8, app: str = "bankspark", **conf: str) -> SparkSession:
    """A single-machine session for tests and the bench."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", str(cpus))
    )
    for key, value in {**RUNTIME_CONF, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors see: the cluster's `spark.checkpoint.dir`.

    Where it is unset a temporary folder is made, but only in local mode.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    global _fallback_dir
    if _fallback_dir is None:
        _fallback_dir = tempfile.mkdtemp(prefix="bankspark-")
    return _fallback_dir


def work_dir(spark: SparkSession, name: str, below: str | None = None) -> str:
    """A fresh folder name for one run, below the shared folder or a given one that all executors
    see (a session whose `spark.checkpoint.dir` is unset cannot be given one any more)."""
    return os.path.join(below or shared_dir(spark), f"{name}-{uuid.uuid4().hex[:12]}")
