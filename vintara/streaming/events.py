"""Windowed aggregates that run alike on a table and on a stream, and an incremental step with a done marker."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _marked(events: DataFrame, late: str | None) -> DataFrame:
    """``events`` with a watermark on ``ts`` where one is asked for; a watermark needs times with a zone, the session's."""
    return events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late) if late else events


def tumbling(events: DataFrame, size: str = "1 day", late: str | None = None) -> DataFrame:
    """``start, event_type, n, total`` per tumbling window; ``late`` is the watermark of a stream."""
    e = _marked(events, late)
    return e.groupBy(F.window("ts", size).alias("w"), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(F.col("w.start").alias("start"), "event_type", "n", "total")


def sliding(events: DataFrame, size: str = "2 days", step: str = "1 day", late: str | None = None) -> DataFrame:
    """``start, n`` per sliding window."""
    e = _marked(events, late)
    return e.groupBy(F.window("ts", size, step).alias("w")).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), "n")


def sessions(events: DataFrame, gap: str = "1 hour", late: str | None = None) -> DataFrame:
    """``user_id, start, n`` per session: events of a user with less than ``gap`` between two."""
    e = _marked(events, late)
    return e.groupBy("user_id", F.session_window("ts", gap).alias("w")).agg(F.count("*").alias("n")).select("user_id", F.col("w.start").alias("start"), "n")


def pending(items: DataFrame, done: DataFrame, key: str = "id") -> DataFrame:
    """Items without a done marker."""
    return items.join(done.select(key), key, "left_anti")
