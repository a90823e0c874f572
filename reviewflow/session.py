"""Session settings and the shared folder used for intermediate tables."""

from __future__ import annotations

import gc
import math
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from reviewflow.sources.folders import delete

# One shuffle partition should hold about this much before it spills.
SHUFFLE_PARTITION_BYTES = 256 * 1024 * 1024


def session_settings(cores: int, shuffled_bytes: int = 0) -> dict[str, str]:
    """Settings sized from the cluster and the largest expected shuffle.

    AQE merges small partitions and splits skewed ones at run time, so the
    initial count only has to be high enough: it never goes below two waves.
    """
    partitions = max(cores * 2, math.ceil(shuffled_bytes / SHUFFLE_PARTITION_BYTES), 8)
    return {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
        "spark.sql.files.maxPartitionBytes": str(SHUFFLE_PARTITION_BYTES),
        # Small inputs are still cut into a piece for each core.
        "spark.sql.files.minPartitionNum": str(cores * 2),
        "spark.sql.parquet.filterPushdown": "true",
        "spark.sql.sources.parallelPartitionDiscovery.parallelism": str(cores * 4),
    }


def build_session(app: str, master: str | None = None, cores: int = 8, shuffled_bytes: int = 0,
                  **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in {**session_settings(cores, shuffled_bytes), **extra}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    A temporary folder stands in only when the setting is absent and driver
    and executors are the same local process.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    folder = tempfile.mkdtemp(prefix="reviewflow-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def new_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared folder; callers own what they write there."""
    app = spark.sparkContext.applicationId
    return f"{shared_folder(spark)}/reviewflow/{app}/{label}-{uuid.uuid4().hex[:12]}"


def let_go(spark: SparkSession) -> None:
    """Give up what nothing refers to any more: Spark deletes the files of a shuffle when the driver's garbage collectors find that."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def release(spark: SparkSession) -> None:
    """Delete what this application wrote to the shared folder."""
    delete(spark, f"{shared_folder(spark)}/reviewflow/{spark.sparkContext.applicationId}")


def materialize(df: DataFrame, label: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    The files outlive any executor, so later stages never recompute ``df``.
    """
    spark = df.sparkSession
    path = new_path(spark, label)
    # Such tables are read once or twice; the codec halves what hashes and texts take.
    writer = df.write.option("compression", "zstd")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
