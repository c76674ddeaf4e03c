"""Where intermediate tables go: the shared folder named by the cluster."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def staging_root(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``, else the context's checkpoint folder.

    A local session without either (tests) gets a temporary folder; a cluster does not, because
    its executors could not all see it.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if spark.sparkContext.master.startswith("local"):
        root = tempfile.mkdtemp(prefix="run-", dir="/tmp")
        spark.sparkContext.setCheckpointDir(root)
        return root
    raise RuntimeError("Set spark.checkpoint.dir to a folder that every executor can reach.")


def staging_path(spark: SparkSession, label: str) -> str:
    return f"{staging_root(spark)}/rowloom/{label}-{uuid.uuid4().hex}"
