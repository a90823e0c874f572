"""Health rules: measured value -> status."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Alarm limits of the health rules.
SILENCE_SECONDS = 30
ERROR_RATE_WARN, ERROR_RATE_ERROR = 10, 30
WRITE_LATENCY_ERROR_MS = 75_000
GAUGE_BANDS_MS = (1_500, 3_000, 5_000)
GAUGE_MARK_MS = 4_000
BACKPRESSURE_RATIO, BACKPRESSURE_MIN_RATE = 1.5, 10
FRESHNESS_BANDS_SECONDS = (10, 30, 60)


def heartbeat_level(silent_seconds: Column) -> Column:
    return F.when(silent_seconds > SILENCE_SECONDS, "error").otherwise("ok")


def error_level(percent: Column) -> Column:
    return (
        F.when(percent > ERROR_RATE_ERROR, "error")
        .when(percent > ERROR_RATE_WARN, "warning")
        .otherwise("ok")
    )


def latency_level(add_batch_ms: Column) -> Column:
    return F.when(add_batch_ms > WRITE_LATENCY_ERROR_MS, "error").otherwise("ok")


def gauge_band(add_batch_ms: Column) -> Column:
    low, middle, high = GAUGE_BANDS_MS
    return (
        F.when(add_batch_ms < low, "green")
        .when(add_batch_ms < middle, "yellow")
        .when(add_batch_ms <= high, "red")
        .otherwise("beyond")
    )


def over_gauge_mark(add_batch_ms: Column) -> Column:
    return add_batch_ms >= GAUGE_MARK_MS


def backpressure(rate_in: Column, rate_out: Column) -> Column:
    return (rate_in > rate_out * BACKPRESSURE_RATIO) & (rate_in > BACKPRESSURE_MIN_RATE)


def freshness_band(seconds: Column) -> Column:
    fresh, usable, stale = FRESHNESS_BANDS_SECONDS
    return (
        F.when(seconds < fresh, "fresh")
        .when(seconds < usable, "normal")
        .when(seconds <= stale, "danger")
        .otherwise("beyond")
    )


def ledger_state(rows_in: Column, rows_out: Column) -> Column:
    return (
        F.when((rows_in == 0) & (rows_out == 0), "idle")
        .when(rows_in <= rows_out, "matched")
        .otherwise("congested")
    )
