"""Stream logs -> minute metrics, on batch or streaming input."""

from __future__ import annotations

from pyspark.sql import DataFrame, GroupedData
from pyspark.sql import functions as F

from reviewflow.functions.clock import log_second
from reviewflow.functions.quality import error_percent

MINUTE = "1 minute"


def flatten_bronze_log(log: DataFrame, *more: str) -> DataFrame:
    counts = ["total_received", "valid_records", "invalid_records"]
    return log.select(
        log_second("timestamp").alias("timestamp"), "batch_id", *more,
        *[F.col(f"metrics.{name}").cast("double").alias(name) for name in counts])


def flatten_silver_log(log: DataFrame) -> DataFrame:
    """Rates and durations; a duration that was not reported counts as 0."""
    add_batch = F.coalesce(
        F.col("processing_time.addBatch"),
        F.element_at("performance.duration_ms", F.lit("addBatch")), F.lit(0))
    return log.select(
        log_second("timestamp").alias("timestamp"), "batch_id",
        F.col("performance.input_rows_per_second").cast("double").alias("input_rows_per_second"),
        F.col("performance.processed_rows_per_second").cast("double").alias("processed_rows_per_second"),
        F.col("performance.total_input_rows").alias("total_input_rows"),
        add_batch.cast("double").alias("addBatch_ms"))


def _by_window(flat: DataFrame, every: str, lateness: str | None) -> GroupedData:
    if lateness:
        # Watermarks need an instant; the result goes back to wall time.
        flat = flat.withColumn("timestamp", F.col("timestamp").cast("timestamp")).withWatermark("timestamp", lateness)
    return flat.where("timestamp is not null").groupBy(F.window("timestamp", every).alias("w"))


def rollup_bronze(log: DataFrame, every: str = MINUTE, lateness: str | None = None) -> DataFrame:
    """Sums and reject share per tumbling window; empty windows do not appear."""
    sums = _by_window(flatten_bronze_log(log), every, lateness).agg(
        F.sum("total_received").alias("total_received"),
        F.sum("valid_records").alias("valid_records"),
        F.sum("invalid_records").alias("invalid_records"))
    return sums.select(
        F.col("w.start").cast("timestamp_ntz").alias("timestamp"), "total_received", "valid_records", "invalid_records",
        error_percent(F.col("invalid_records"), F.col("total_received")).alias("error_rate_percent"))


def rollup_silver(log: DataFrame, every: str = MINUTE, lateness: str | None = None) -> DataFrame:
    """Mean rates and write time per tumbling window, plus the rows processed."""
    means = _by_window(flatten_silver_log(log), every, lateness).agg(
        F.avg("input_rows_per_second").alias("input_rows_per_second"),
        F.avg("processed_rows_per_second").alias("processed_rows_per_second"),
        F.avg("addBatch_ms").alias("addBatch_ms"),
        F.sum("total_input_rows").alias("total_input_rows"))
    return means.select(
        F.col("w.start").cast("timestamp_ntz").alias("timestamp"), "input_rows_per_second", "processed_rows_per_second",
        "addBatch_ms", "total_input_rows")


def total_received(bronze_metrics: DataFrame) -> DataFrame:
    return bronze_metrics.agg(F.coalesce(F.sum("total_received"), F.lit(0.0)).alias("total_received"))
