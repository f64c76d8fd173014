"""Listings as a stream: each micro-batch through the batch operators, and rates of events by window."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.readers import LISTING, to_items


def listing_stream(spark: SparkSession, folder: str) -> DataFrame:
    """New JSON-lines files of a folder as flat inventory rows."""
    return to_items(spark.readStream.schema(LISTING).json(folder))


def run_available(stream: DataFrame, step: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    """Give what has arrived to `step`, batch by batch, and stop. A step must bear being repeated with the same batch id."""
    stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def first_seen(stream: DataFrame, time: str, within: str = "1 day") -> DataFrame:
    """Each file once: repeats within the watermark are dropped."""
    return stream.withWatermark(time, within).dropDuplicatesWithinWatermark(["file_id"])


def windowed_counts(events: DataFrame, time: str, key: str, size: str = "1 hour", late: str = "2 hours", slide: str | None = None) -> DataFrame:
    """(window_start, key, n) by tumbling or sliding windows; rows later than the watermark are dropped. Batch frames work alike."""
    e = events.withWatermark(time, late) if events.isStreaming else events
    w = F.window(time, size, slide) if slide else F.window(time, size)
    return e.groupBy(w.alias("w"), key).agg(F.count("*").alias("n")).select(F.col("w.start").alias("window_start"), key, "n")


def sessions(events: DataFrame, time: str, key: str, gap: str = "30 minutes", late: str = "2 hours") -> DataFrame:
    """(key, session_start, n) by gaps of inactivity."""
    e = events.withWatermark(time, late) if events.isStreaming else events
    return e.groupBy(F.session_window(time, gap).alias("w"), key).agg(F.count("*").alias("n")).select(key, F.col("w.start").alias("session_start"), "n")
