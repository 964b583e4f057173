"""A session with the settings that the engine relies on."""

from __future__ import annotations

from pyspark.sql import SparkSession


def session(app: str = "tidemark", **conf: str) -> SparkSession:
    """UTC, ANSI and adaptive execution on; masters and sizes are the cluster's business."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
    } | conf
    return SparkSession.builder.appName(app).config(map=settings).getOrCreate()
