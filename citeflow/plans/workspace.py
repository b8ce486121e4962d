"""Where queries write: the shared folder the session names."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

SHARED_DIR = "spark.checkpoint.dir"

_own_dirs: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors can reach. Only a local session may do without naming one."""
    named = spark.conf.get(SHARED_DIR, None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {SHARED_DIR} to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _own_dirs:
        _own_dirs[app] = tempfile.mkdtemp(prefix="citeflow-")
    return _own_dirs[app]


def new_dir(spark: SparkSession, purpose: str) -> str:
    """Fresh folder name below the shared one."""
    return f"{shared_dir(spark)}/citeflow-{purpose}-{uuid.uuid4().hex}"
