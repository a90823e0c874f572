"""Writers."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


# Rows of a compressed text file: it is read by one task, so this bounds the task (some 450 MB of messages).
ROWS_PER_FILE = 500_000
# Partition folders that a task writes at a time; it sorts the rows of further ones.
OPEN_FILES = 4


def text_options(compression: str | None) -> dict:
    """Writer options of line files; a compressed file cannot be split, so it ends after a number of rows."""
    return {"compression": compression, "maxRecordsPerFile": ROWS_PER_FILE} if compression else {}


@contextmanager
def setting(spark: SparkSession, name: str, value: int):
    """A setting of the session for the jobs inside."""
    before = spark.conf.get(name)
    spark.conf.set(name, str(value))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def unsorted_writes(spark: SparkSession):
    """Tasks that write a few partition folders keep one file open for each instead of sorting all their rows first."""
    return setting(spark, "spark.sql.maxConcurrentOutputFileWriters", OPEN_FILES)


def write_json(df: DataFrame, path: str, batch_id: int | None = None, compression: str | None = None) -> None:
    """JSON lines; NULL fields are left out.

    With ``batch_id`` the rows go to their own sub-folder, which a retry
    replaces, so a batch never lands twice. ``compression`` is for example
    ``gzip``, about a tenth of the bytes for messages.
    """
    writer = df.write.options(**text_options(compression))
    if batch_id is None:
        writer.mode("append").json(path)
    else:
        writer.mode("overwrite").json(f"{path}/batch_id={batch_id}")


def write_lines(lines: DataFrame, path: str, mode: str = "errorifexists", compression: str | None = None) -> None:
    """Text lines of one column, compressed like ``write_json``."""
    lines.write.options(**text_options(compression)).mode(mode).text(path)


def gather(df: DataFrame, by: str, tasks: int, shards: int) -> DataFrame:
    """Bring the rows of one value of ``by`` into at most ``shards`` tasks.

    The shard follows the input task, so even a value (or one repeated row)
    that fills most of the input is cut into equal parts.
    """
    shard = F.pmod(F.spark_partition_id(), F.lit(shards))
    return df.withColumn("_shard", shard).repartition(tasks, by, "_shard").drop("_shard")


def write_partitioned_stream(df: DataFrame, path: str, checkpoint: str, by: str = "review_date",
                             fmt: str = "parquet", trigger: dict | None = None,
                             shards: int | None = None) -> StreamingQuery:
    """Checkpointed append of a stream, one folder per value of ``by``.

    Without ``shards`` nothing is shuffled and every task writes its own file
    per value; with it a micro-batch leaves at most ``shards`` files per value.
    ``trigger`` goes to ``DataStreamWriter.trigger``; the default is the
    one-minute cadence. ``fmt="delta"`` needs the Delta jar.
    """
    if shards:
        df = gather(df, by, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), shards)
    return (
        df.writeStream.format(fmt)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .option("mergeSchema", True)
        .partitionBy(by)
        .trigger(**(trigger or {"processingTime": "1 minute"}))
        .start(path)
    )


def export_sample(df: DataFrame, path: str, rows: int = 5) -> DataFrame:
    """Write a few rows as one CSV with header and return them."""
    sample = df.limit(rows).select(
        [df[name].cast("string") if "array" in kind or "struct" in kind or "map" in kind else df[name]
         for name, kind in df.dtypes])
    sample.coalesce(1).write.mode("overwrite").option("encoding", "UTF-8").csv(path, header=True)
    return sample
