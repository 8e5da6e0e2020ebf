"""The engine's row operators run on streams unchanged; here is what needs a clock or a state."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def rate_windows(events: DataFrame, ts: str = "ts", key: str | None = "event_type", minutes: int = 5, late: str = "10 minutes") -> DataFrame:
    """Events per ``minutes`` window (and key); on a stream with a watermark for late ones."""
    source = events.withWatermark(ts, late) if events.isStreaming else events
    keys = [F.window(ts, f"{minutes} minutes"), *([F.col(key)] if key else [])]
    out = source.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return out.select(F.col("window.start").alias("window_start"), *([key] if key else []), "n", F.round(F.col("n") / (60.0 * minutes), 6).alias("per_second"))


def unseen(stream: DataFrame, index: DataFrame, content) -> DataFrame:
    """Rows of a stream (or table) whose content hash an index table lacks."""
    from ..functions.text import sha1_64

    return stream.withColumn("content_hash", sha1_64(content)).join(index, "content_hash", "left_anti")


def first_within(stream: DataFrame, content, ts: str, late: str = "1 hour") -> DataFrame:
    """Exact duplicates on a stream: the first row of each content within the watermark."""
    from ..functions.text import sha1_64

    keyed = stream.withColumn("content_hash", sha1_64(content)).withWatermark(ts, late)
    return keyed.dropDuplicatesWithinWatermark(["content_hash"])
