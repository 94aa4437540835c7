"""Session settings and the scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the plans count on. Shuffle partitions are left to the cluster: adaptive execution
# merges small ones, so a high number there costs little.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.optimizer.dynamicPartitionPruning.enabled": "true",
}

_local_roots: dict[str, str] = {}


def build_session(app_name: str = "cotrend", master: str | None = None, **conf: str) -> SparkSession:
    """Get or create a session; ``conf`` keys use ``__`` for a dot."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the cluster's shared folder (``spark.checkpoint.dir``).

    A machine-local folder is only used in local mode, where driver and executors share the machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        app = spark.sparkContext.applicationId
        if app not in _local_roots:
            _local_roots[app] = tempfile.mkdtemp(prefix="run-", dir="/tmp")
        root = _local_roots[app]
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"
