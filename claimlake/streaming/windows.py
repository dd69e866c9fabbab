"""Event-time windows that give the same rows over a table and over a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def tumbling(events: DataFrame, at: str, keys: list[str], width: str, value: str, late: str = "1 hour") -> DataFrame:
    """begins, keys, n and best (the largest value) of each window of width; rows without a time take no part.

    On a stream, rows later than late behind the newest time are left out and closed windows leave the state.
    """
    rows = events.filter(F.col(at).isNotNull())
    if rows.isStreaming:
        rows = rows.withWatermark(at, late)
    return rows.groupBy(F.window(at, width).alias("w"), *keys).agg(F.count(F.lit(1)).alias("n"), F.max(value).alias("best")).select(F.col("w.start").alias("begins"), *keys, "n", "best")


def once_each(events: DataFrame, at: str, key: str, late: str = "1 hour") -> DataFrame:
    """One row for each key: on a stream, repeats within late of the first are dropped and the state stays bounded."""
    if events.isStreaming:
        return events.withWatermark(at, late).dropDuplicatesWithinWatermark([key])
    return events.dropDuplicates([key])


def sessions(events: DataFrame, at: str, keys: list[str], gap: str, late: str = "1 hour") -> DataFrame:
    """Stretches of a key's events with no silence longer than gap between: begun, last_event, n. Rows without a time take no part.

    A run that speaks again after a silence begins another stretch. On a stream, a stretch comes out once the watermark
    has passed its end.
    """
    rows = events.filter(F.col(at).isNotNull())
    if rows.isStreaming:
        rows = rows.withWatermark(at, late)
    return rows.groupBy(F.session_window(at, gap).alias("w"), *keys).agg(F.min(at).alias("begun"), F.max(at).alias("last_event"), F.count(F.lit(1)).alias("n")).select(*keys, "begun", "last_event", "n")
