"""Folder operations through the file system Spark itself uses."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Folder name Spark gives to rows whose partition value is NULL.
NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"


def _locate(spark: SparkSession, path: str):
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, folder = _locate(spark, path)
    return fs.exists(folder)


def delete(spark: SparkSession, path: str) -> bool:
    fs, folder = _locate(spark, path)
    return fs.delete(folder, True)


def publish(spark: SparkSession, staged: str, final: str) -> bool:
    """Give a complete folder its final name by one rename, unless that name is taken.

    Readers see all of the folder or nothing, and what is published keeps its
    file names for ever. Returns whether it was published now.
    """
    fs, source = _locate(spark, staged)
    _, target = _locate(spark, final)
    if fs.exists(target):
        return False
    fs.mkdirs(target.getParent())
    if not fs.rename(source, target):
        raise OSError(f"cannot rename {staged} to {final}")
    return True


def subfolders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly under ``path``, sorted."""
    fs, folder = _locate(spark, path)
    if not fs.exists(folder):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(folder) if status.isDirectory())


def versions(spark: SparkSession, root: str) -> list[int]:
    """Completely written versions under ``root``, oldest first."""
    return sorted(
        int(name.removeprefix("v="))
        for name in subfolders(spark, root)
        if name.startswith("v=") and exists(spark, f"{root}/{name}/_SUCCESS")
    )


def write_version(df: DataFrame, root: str, partition_by: list[str] | None = None, keep: int | None = None) -> str:
    """Write ``df`` as the next version of a table and return its folder.

    The version being read is never touched, and readers pick up the new one
    only when its success marker exists, so a failed job changes nothing.
    ``keep`` is the number of newest versions that stay, at least two, so that
    a reader of the one before can finish.
    """
    spark = df.sparkSession
    done = versions(spark, root)
    path = f"{root}/v={(done[-1] if done else 0) + 1}"
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    if keep is not None:
        for version in done[:max(len(done) + 1 - max(keep, 2), 0)]:
            delete(spark, f"{root}/v={version}")
    return path


def current_version(spark: SparkSession, root: str) -> str | None:
    done = versions(spark, root)
    return f"{root}/v={done[-1]}" if done else None


def read_current(spark: SparkSession, root: str) -> DataFrame | None:
    path = current_version(spark, root)
    return spark.read.parquet(path) if path else None
