"""Streaming forms: sessions and counts with watermarks, novelty against a static table, judged upserts by batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def session_counts(events: DataFrame, time: str, key: str, gap: str = "30 minutes", late: str = "1 hour") -> DataFrame:
    """Events per key and session; a session closes a gap after its last event."""
    return (
        events.withWatermark(time, late)
        .groupBy(F.session_window(time, gap), key)
        .agg(F.count("*").alias("events"))
        .select(key, F.col("session_window.start").alias("start"), F.col("session_window.end").alias("end"), "events")
    )


def windowed_counts(events: DataFrame, time: str, key: str, length: str = "1 hour", late: str = "1 hour") -> DataFrame:
    return events.withWatermark(time, late).groupBy(F.window(time, length), key).agg(F.count("*").alias("events")).select(key, F.col("window.start").alias("start"), "events")


def unseen(events: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """Rows of a stream whose key a static table doesn't have."""
    return events.join(known.select(key).distinct(), key, "left_anti")


def first_of_each(events: DataFrame, time: str, keys: list[str], late: str = "1 hour") -> DataFrame:
    """The first row of each key within the watermark."""
    return events.withWatermark(time, late).dropDuplicatesWithinWatermark(keys)


def each_batch(stream: DataFrame, fold: Callable[[DataFrame, int], None], checkpoint: str):
    """Runs what is there through fold(batch, number) and stops; the schedule is the retry."""
    return stream.writeStream.foreachBatch(fold).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
