"""Scratch paths in the folder that driver and executors share."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession


def scratch(spark: SparkSession, name: str) -> str:
    """A new path under ``spark.checkpoint.dir``; unset, a local folder serves where the driver's threads are the only executors."""
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise RuntimeError("on a cluster, spark.checkpoint.dir must name a folder that all executors share")
        root = tempfile.mkdtemp(prefix="tidemark-")
    return f"{root.rstrip('/')}/tidemark-{name}-{uuid.uuid4().hex}"
