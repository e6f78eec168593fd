"""Session defaults and the shared folder for written intermediates."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the plans rely on; everything else is left to the cluster.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
}


def build_session(app_name: str = "tablewarden", master: str | None = None, **extra: str) -> SparkSession:
    """A session with the library defaults; keyword names use ``__`` for dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


_local_dirs: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local-mode session without the setting gets a temporary folder: on a cluster a
    machine-local path would lose its files together with the executor.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    application = spark.sparkContext.applicationId
    if application not in _local_dirs:
        _local_dirs[application] = tempfile.mkdtemp(prefix="tablewarden-")
    return _local_dirs[application]


def new_shared_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder; never reused, so nothing is overwritten by accident."""
    return f"{shared_dir(spark)}/tablewarden/{label}-{uuid.uuid4().hex}"
