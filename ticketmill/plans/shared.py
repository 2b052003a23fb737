"""The folder all executors share, for checkpoints and intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The cluster's checkpoint folder. A local session without one gets a temporary folder."""
    context = spark.sparkContext
    folder = spark.conf.get(CHECKPOINT_DIR, None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_DIR} to a folder that every executor can reach")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="ticketmill-"))
        folder = context.getCheckpointDir()
    return folder.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that nothing else uses."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
