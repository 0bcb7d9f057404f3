"""Streaming forms (extras): stale placeholders, deduplicated events, windowed counts, and the queue merge by micro-batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import merge


def _timed(events: DataFrame, delay: str) -> DataFrame:
    """With a watermark; zoneless times count as UTC."""
    return events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", delay)


def unique_events(events: DataFrame, delay: str = "1 hour") -> DataFrame:
    """The first of each event id; state is dropped behind the watermark."""
    return _timed(events, delay).dropDuplicatesWithinWatermark(["event_id"])


def activity_counts(events: DataFrame, delay: str = "10 minutes", size: str = "1 day") -> DataFrame:
    return _timed(events, delay).groupBy(F.window("ts", size), "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))


def sessions(events: DataFrame, gap: str = "30 minutes", delay: str = "1 hour") -> DataFrame:
    return _timed(events, delay).groupBy(F.session_window("ts", gap), "user_id").agg(F.count(F.lit(1)).alias("n"))


def placeholder_matches(placeholders: DataFrame, outbound: DataFrame, hours: int = 72) -> DataFrame:
    """Placeholders and outbound threads of one contact within the hours of each other, both sides bounded by watermarks."""
    a = placeholders.withWatermark("at", "1 hour").alias("a")
    b = outbound.withWatermark("sent", "1 hour").alias("b")
    near = F.expr(f"a.contact_id = b.contact_id AND b.sent BETWEEN a.at - INTERVAL {hours} HOURS AND a.at + INTERVAL {hours} HOURS")
    return a.join(b, near).select("a.activity_id", "b.thread_id", "a.contact_id")


def merge_batches(load: Callable[[], DataFrame], store: Callable[[DataFrame, int], None], bridged: DataFrame, excluded: DataFrame, today: str):
    """For ``foreachBatch``: merges each batch of scored contacts into the queue. ``store`` gets the batch number, so a replay is the same write."""

    def run(batch: DataFrame, number: int) -> None:
        store(merge.merge_queue(batch, load(), bridged, excluded, today), number)

    return run
