"""The Spark session this engine runs on."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def build(master: str | None = None, shuffle_partitions: int | None = None, app: str = "wayfold") -> SparkSession:
    """UTC, adaptive execution with skew handling; everything else is the cluster's business."""
    b = SparkSession.builder.appName(app).config("spark.sql.session.timeZone", "UTC").config("spark.sql.adaptive.enabled", "true").config("spark.sql.adaptive.skewJoin.enabled", "true")
    master = master or os.environ.get("SPARK_MASTER")
    if master:
        b = b.master(master)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return b.getOrCreate()
