"""Where a job may put files that other executors must see."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def shared_root(spark: SparkSession) -> str:
    """The cluster's shared folder: ``spark.checkpoint.dir`` of the session.

    Only a local master, where driver and executors are one machine, may fall back to a
    temporary folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    root = tempfile.mkdtemp(prefix="cairn-")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """A path below the shared folder that nothing else uses. It is not created."""
    return f"{shared_root(spark)}/cairn/{purpose}-{uuid.uuid4().hex}"
