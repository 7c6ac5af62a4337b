"""Shared scratch space for intermediate tables, exports and stream checkpoints."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def work_root(spark: SparkSession) -> str:
    """The folder the cluster shares for checkpoints; a local one only for a local session without any."""
    root = spark.conf.get(CHECKPOINT_DIR, None)
    if not root:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder all executors share")
        root = tempfile.mkdtemp(prefix="tiers-")
        spark.conf.set(CHECKPOINT_DIR, root)
    return root.rstrip("/")


def new_folder(spark: SparkSession, label: str) -> str:
    """A path nobody has used yet."""
    return f"{work_root(spark)}/{label}-{uuid.uuid4().hex[:12]}"
