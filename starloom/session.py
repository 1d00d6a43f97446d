"""Session helpers: the settings every load relies on, and the shared checkpoint folder.

The library never creates its own session on a cluster; ``get_session`` is for tests, the
bench and local runs.  ``ensure_checkpoint_dir`` reads ``spark.checkpoint.dir`` from the
running session and only falls back to a fresh local folder when the master is local.
"""
from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings the operators depend on for correct results (not tuning):
#  - UTC session zone: staging times are timestamp_ntz; zone-dependent casts must not drift.
#  - ANSI mode: overflow and bad casts fail the load instead of turning into NULL.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.parquet.inferTimestampNTZ.enabled": "true",
}

# Tuning defaults for local runs; a cluster sets its own.
LOCAL_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.driver.memory": "16g",
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_session(master: str | None = None, shuffle_partitions: int = 8, app: str = "starloom",
                extra: dict | None = None) -> SparkSession:
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = SparkSession.builder.master(master or f"local[{cpus}]").appName(app)
    conf = {**LOCAL_CONF, **REQUIRED_CONF,
            "spark.sql.shuffle.partitions": str(shuffle_partitions), **(extra or {})}
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_required_conf(spark)
    ensure_checkpoint_dir(spark)
    return spark


def apply_required_conf(spark: SparkSession) -> None:
    for k, v in REQUIRED_CONF.items():
        spark.conf.set(k, v)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, setting one only for local masters.

    On a cluster ``spark.checkpoint.dir`` names a shared folder (HDFS/object store) and is
    used as given.  A local master without one (tests, bench) gets a fresh temp folder.
    """
    sc = spark.sparkContext
    current = sc._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return configured
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    path = tempfile.mkdtemp(prefix="starloom-ckpt-")
    sc.setCheckpointDir(path)
    return path


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder for written intermediate tables, next to the checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    if base.startswith("file:"):
        base = base[len("file:"):]
    if "://" in base:
        import uuid
        return f"{base}/{name}-{uuid.uuid4().hex}"
    os.makedirs(base, exist_ok=True)
    return tempfile.mkdtemp(prefix=f"{name}-", dir=base)
