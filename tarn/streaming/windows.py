"""Streams of events and fixes: windowed counts with late data, and sessions. An extension; the reference has no streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def windowed(events: DataFrame, time: str, size: str, lateness: str, *keys: str) -> DataFrame:
    """Count and sum of value per window and keys; rows later than lateness behind the newest are left out."""
    grouped = events.withWatermark(time, lateness).groupBy(F.window(time, size), *keys)
    return grouped.agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(F.col("window.start").alias("start"), F.col("window.end").alias("end"), *keys, "n", "total")


def sessions(events: DataFrame, time: str, gap: str, lateness: str, key: str) -> DataFrame:
    """Sessions of a key: rows with less than gap between them."""
    grouped = events.withWatermark(time, lateness).groupBy(F.session_window(time, gap), key)
    return grouped.agg(F.count("*").alias("n")).select(key, F.col("session_window.start").alias("start"), F.col("session_window.end").alias("end"), "n")
