"""Silence on a stream, told by session windows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewflow.functions.levels import SILENCE_SECONDS


def silences(rows: DataFrame, key: str, time: str = "timestamp", gap_seconds: int = SILENCE_SECONDS,
             lateness: str = "1 minute") -> DataFrame:
    """Each silence of more than ``gap_seconds`` of a ``key``, with the activity before it.

    One row for each: when the activity began, its number of ``events``, since
    when the key is silent, and when that was noticed. On a stream a silence
    is passed on once, in append mode, as soon as the watermark has passed the
    moment of notice; so the last activity of a key is open until others go on.
    On a table every activity has ended. Rows without a time do not count; a
    NULL key is a key of its own.
    """
    rows = rows.where(F.col(time).isNotNull())
    if rows.isStreaming:
        # Watermarks need an instant; the result goes back to wall time.
        rows = rows.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, lateness)
    active = rows.groupBy(F.session_window(time, f"{gap_seconds} seconds").alias("_active"), key).agg(
        F.count("*").alias("events"), F.max(time).alias("_last"))
    moments = {"active_since": "_active.start", "silent_since": "_last", "noticed_at": "_active.end"}
    return active.select(key, *[F.col(place).cast("timestamp_ntz").alias(name) for name, place in moments.items()], "events")
