"""The folder for intermediate files that the driver and all executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new folder's path below spark.checkpoint.dir. Where that is unset, a session of this machine alone gets one of its own."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root and not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return f"{(root or '/tmp/checkpoints').rstrip('/')}/tidemark/{name}-{uuid.uuid4().hex}"
