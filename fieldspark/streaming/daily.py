"""Incremental daily means of a sensor feed: the calendar-day resample as a watermarked streaming aggregation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def daily_stream(feed: DataFrame, ts: str = "ts", value: str = "value", delay: str = "2 days") -> DataFrame:
    """(station, sensor, date, value, n) of each day, given out once no reading within ``delay`` can change it.

    ``feed`` is a streaming (or, for tests, batch) table of (station, sensor, ts, value); later readings are dropped
    by the watermark, so the state holds only the last days.
    """
    marked = feed.withWatermark(ts, delay) if feed.isStreaming else feed
    days = marked.groupBy("station", "sensor", F.window(ts, "1 day").alias("w")).agg(F.avg(value).alias("value"), F.count(value).alias("n"))
    return days.select("station", "sensor", F.to_date("w.start").alias("date"), "value", "n")
