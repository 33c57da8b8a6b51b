"""Working folders in the shared file system the cluster names.

Stream checkpoints, staged files and table versions have to outlive any one
executor, so they go under ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_local_roots: dict[str, str] = {}


def application_id(spark: SparkSession) -> str:
    return spark.conf.get("spark.app.id")


def scratch_root(spark: SparkSession) -> str:
    """The shared folder of this application.

    A machine-local folder is used only by a local master that names none; on a
    cluster it would be invisible to the other machines.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    application = application_id(spark)
    if configured:
        return f"{configured.rstrip('/')}/stratalake/{application}"
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    if application not in _local_roots:
        _local_roots[application] = tempfile.mkdtemp(prefix="stratalake-")
    return _local_roots[application]


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A path no earlier run has used; nothing is created yet."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex[:12]}"


def fresh_name(label: str) -> str:
    """A table or view name no earlier run has used."""
    return f"{label}_{uuid.uuid4().hex[:12]}"
