"""Windowed counts over tables or streams: the same expression serves both."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def windowed_counts(events: DataFrame, time: str, keys: Sequence[str], every: str = "1 day", late: str = "1 hour") -> DataFrame:
    """(window_start, keys, n): events by window; on a stream, rows later than `late` behind the newest are dropped."""
    rows = events.withWatermark(time, late) if events.isStreaming else events
    return rows.groupBy(F.window(time, every).alias("w"), *keys).agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("window_start"), *keys, "n")
