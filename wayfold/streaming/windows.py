"""Hourly windows over events, the same code for a table and a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def hourly_counts(events: DataFrame, late: str | None = None) -> DataFrame:
    """window_start, event_type, events, k_total. late: how long a stream waits for late events."""
    e = events.withColumn("t", F.col("ts").cast("timestamp"))
    if late:
        e = e.withWatermark("t", late)
    k = F.get_json_object("props", "$.k").cast("long")
    return e.groupBy(F.window("t", "1 hour").alias("w"), "event_type").agg(F.count("*").alias("events"), F.sum(k).alias("k_total")).select(F.col("w.start").cast("timestamp_ntz").alias("window_start"), "event_type", "events", "k_total")
