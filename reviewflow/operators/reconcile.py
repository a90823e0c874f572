"""Do the rows that went in equal the rows that came out?"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def reconcile(bronze_metrics: DataFrame, silver_metrics: DataFrame) -> DataFrame:
    """One row: rows in, rejected, expected, processed, and what is missing."""
    nothing = F.lit(0.0)
    flows = bronze_metrics.select(
        F.col("total_received").alias("rows_in"), F.col("invalid_records").alias("rows_rejected"),
        nothing.alias("rows_processed")
    ).unionAll(silver_metrics.select(nothing, nothing, F.col("total_input_rows").cast("double")))
    sums = flows.agg(*[
        F.coalesce(F.sum(name), nothing).alias(name) for name in ("rows_in", "rows_rejected", "rows_processed")])
    expected = F.col("rows_in") - F.col("rows_rejected")
    return sums.select(
        "rows_in", "rows_rejected", expected.alias("rows_expected"), "rows_processed",
        (expected - F.col("rows_processed")).alias("discrepancy"))


def funnel(reconciled: DataFrame) -> DataFrame:
    """Four stages with value and percent of the first."""
    stages = F.array(*[
        F.struct(F.lit(step).alias("step"), F.lit(name).alias("stage"), F.col(column).alias("value"))
        for step, (name, column) in enumerate([
            ("bronze_in", "rows_in"), ("dlq", "rows_rejected"),
            ("expected_silver", "rows_expected"), ("silver_out", "rows_processed")], start=1)])
    share = F.try_divide(F.col("s.value"), F.col("rows_in")) * 100.0
    return reconciled.select("rows_in", F.explode(stages).alias("s")).select(
        "s.step", "s.stage", "s.value", share.alias("percent_of_first"))
