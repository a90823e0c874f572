"""Health rules over metric tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewflow.functions import levels
from reviewflow.functions.clock import clock_label, local_time

LEDGER_ROWS = 20


def heartbeat(metrics: DataFrame, now: Column | None = None, time: str = "timestamp") -> DataFrame:
    """Seconds since the last event and whether that is too long."""
    moment = F.current_timestamp().cast("timestamp_ntz") if now is None else now
    last = metrics.agg(F.max(time).alias("last_seen"))
    silent = F.timestamp_diff("SECOND", F.col("last_seen"), moment)
    return last.where("last_seen is not null").select(
        "last_seen", silent.alias("silent_seconds"), levels.heartbeat_level(silent).alias("level"))


def error_level(bronze_metrics: DataFrame) -> DataFrame:
    return bronze_metrics.select(
        "timestamp", "error_rate_percent", levels.error_level(F.col("error_rate_percent")).alias("level"))


def latency_level(silver_metrics: DataFrame) -> DataFrame:
    ms = F.col("addBatch_ms")
    return silver_metrics.select(
        "timestamp", ms, levels.latency_level(ms).alias("level"),
        levels.gauge_band(ms).alias("band"), levels.over_gauge_mark(ms).alias("over_mark"))


def backpressure(silver_metrics: DataFrame) -> DataFrame:
    rate_in, rate_out = F.col("input_rows_per_second"), F.col("processed_rows_per_second")
    return silver_metrics.select(
        "timestamp", rate_in, rate_out, levels.backpressure(rate_in, rate_out).alias("is_congested"))


def freshness(silver_metrics: DataFrame, reconciled: DataFrame) -> DataFrame:
    """Write time of the latest batch with its band, and whether the books balance."""
    # Both inputs are single rows; they meet in one aggregate.
    latest = silver_metrics.agg(F.max_by("addBatch_ms", "timestamp").alias("ms"))
    rows = latest.select("ms", F.lit(None).cast("double").alias("discrepancy")).unionAll(
        reconciled.select(F.lit(None).cast("double"), "discrepancy"))
    seconds = F.col("ms") / 1000
    return rows.agg(F.max("ms").alias("ms"), F.max("discrepancy").alias("discrepancy")).select(
        seconds.alias("latency_seconds"), levels.freshness_band(seconds).alias("band"),
        "discrepancy", (F.col("discrepancy") == 0).alias("is_balanced"))


def ledger(silver_metrics: DataFrame, n: int = LEDGER_ROWS) -> DataFrame:
    """Latest batches with rows in and out; rates stand in for missing counts."""
    names = silver_metrics.columns
    rows_in = F.col("input_rows" if "input_rows" in names else "input_rows_per_second")
    rows_out = F.col("processed_rows" if "processed_rows" in names else "processed_rows_per_second")
    latest = silver_metrics.orderBy(F.desc("timestamp")).limit(n)
    return latest.select(
        clock_label(local_time("timestamp")).alias("time_label"),
        rows_in.alias("input"), rows_out.alias("processed"),
        levels.ledger_state(rows_in, rows_out).alias("state"))
