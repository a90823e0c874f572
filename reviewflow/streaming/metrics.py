"""Windowed metrics as a stream, kept as a table keyed by window."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from reviewflow.streaming.progress import DroppedRows


def start_metric_upserts(metrics: DataFrame, path: str, checkpoint: str,
                         trigger: dict | None = None) -> StreamingQuery:
    """Write the windows each micro-batch changed into that batch's folder."""

    def put(batch: DataFrame, epoch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={epoch_id}")

    dropped = DroppedRows()
    metrics.sparkSession.streams.addListener(dropped)
    query = (
        metrics.writeStream.outputMode("update").foreachBatch(put)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "3 seconds"}))
        .start()
    )
    query.dropped_rows, query.manager = dropped, metrics.sparkSession.streams
    return query


def finish(query: StreamingQuery) -> None:
    """Wait for a stream of ``start_metric_upserts`` to end and fail if its watermark dropped rows in any batch.

    Dropped rows mean that the allowed lateness is shorter than the disorder
    of the input, so windows are missing from the table.
    """
    try:
        query.awaitTermination()
        dropped = query.dropped_rows.of(query)
    finally:
        query.manager.removeListener(query.dropped_rows)
    if dropped:
        raise RuntimeError(f"{dropped} rows came later than the lateness allows")


def read_latest(spark: SparkSession, path: str, key: str = "timestamp") -> DataFrame:
    """One row per key: the one the latest batch wrote."""
    rows = spark.read.parquet(path)
    values = [name for name in rows.columns if name != "batch_id"]
    newest = rows.groupBy(key).agg(F.max_by(F.struct(*values), "batch_id").alias("row"))
    return newest.select("row.*")
