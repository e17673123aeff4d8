"""Streaming forms of the polling source: late updates, deduplication and windowed counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def newest_updates(stream: DataFrame, overlap: str = "5 minutes") -> DataFrame:
    """Each (id, updated_at) once, though polls overlap; state older than the overlap is dropped."""
    return stream.withWatermark("updated_at", overlap).dropDuplicatesWithinWatermark(["id", "updated_at"])


def requests_per_window(stream: DataFrame, length: str = "60 seconds", slide: str = "10 seconds", late: str = "1 minute") -> DataFrame:
    """Requests per user in sliding windows of event time."""
    return stream.withWatermark("ts", late).groupBy(F.window("ts", length, slide), "user_id").agg(F.count(F.lit(1)).alias("n"))
