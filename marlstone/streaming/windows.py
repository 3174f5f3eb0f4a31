"""Event counts by window, for batches and for streams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def windowed_counts(events: DataFrame, width: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """(start, event_type, n, total); on a stream, windows close when the watermark passes them."""
    timed = events.withColumn("ts", F.col("ts").cast("timestamp"))
    timed = timed.withWatermark("ts", late) if events.isStreaming else timed
    by = timed.groupBy(F.window("ts", width), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"))
    return by.select(F.date_format("window.start", "yyyy-MM-dd HH:mm:ss").alias("start"), "event_type", "n", F.round("total", 4).alias("total"))


def exact_copies(chunks: DataFrame) -> DataFrame:
    """(hash, n) kept up to date as chunks arrive."""
    from ..functions import text as T

    return chunks.groupBy(T.content_hash(F.col("raw_text")).alias("hash")).agg(F.count("*").alias("n"))
