"""File and table readers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from reviewflow.operators.shape import union_by_name
from reviewflow.schema import DLQ_SCHEMA

# Fixed value: files one micro-batch may take.
MAX_FILES_PER_TRIGGER = 100


def read_json_stream(spark: SparkSession, path: str, schema: StructType,
                     max_files: int | None = MAX_FILES_PER_TRIGGER, max_bytes: str | None = None) -> DataFrame:
    """Stream of JSON files under ``path`` (globs allowed) with a fixed schema.

    A micro-batch takes at most ``max_files`` files, or with ``max_bytes``
    (for example ``8g``) files of about that size, whatever their number.
    """
    reader = spark.readStream.schema(schema)
    if max_bytes is not None:
        return reader.option("maxBytesPerTrigger", max_bytes).json(path)
    return (reader.option("maxFilesPerTrigger", max_files) if max_files is not None else reader).json(path)


def read_table(spark: SparkSession, path: str, fmt: str = "parquet", merge_schema: bool = False) -> DataFrame:
    """Batch read of a table folder; ``fmt="delta"`` needs the Delta jar."""
    reader = spark.read.format(fmt)
    if merge_schema:
        reader = reader.option("mergeSchema", True)
    return reader.load(path)


def list_files(spark: SparkSession, path: str | list[str], pattern: str | None = None) -> DataFrame:
    """One row per file: path, bytes, modified. File contents are not read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.load(path).select(
        "path", F.col("length").alias("bytes"), F.col("modificationTime").alias("modified"))


def read_ndjson_union(spark: SparkSession, paths: list[str], schema: StructType | None = None,
                      newest_files: int | None = None) -> DataFrame:
    """JSON lines of several files or folders, united by column name.

    Unreadable lines are skipped. With ``schema=None`` each path is read with
    its own inferred columns and missing ones become NULL. ``newest_files``
    keeps only that many files per folder, the latest modified first.
    """
    frames = []
    for path in paths:
        chosen: str | list[str] = path
        if newest_files is not None:
            newest = list_files(spark, path).orderBy(F.desc("modified"), F.desc("path"))
            chosen = [row.path for row in newest.select("path").limit(newest_files).collect()]
            if not chosen:
                continue
        reader = spark.read.option("mode", "DROPMALFORMED")
        frames.append((reader.schema(schema) if schema else reader).json(chosen))
    if not frames:
        if schema is None:
            raise FileNotFoundError(f"no JSON file under {paths}")
        return spark.createDataFrame([], schema)
    return union_by_name(*frames)


def read_dlq(spark: SparkSession, *paths: str) -> DataFrame:
    """All rejected rows under the given folders, small files and compacted ones alike."""
    return spark.read.schema(DLQ_SCHEMA).option("recursiveFileLookup", True).json(list(paths))


def first_non_empty(*frames: DataFrame) -> DataFrame:
    """The first frame that has a row, else the last one."""
    for frame in frames[:-1]:
        if not frame.isEmpty():
            return frame
    return frames[-1]


# The four demonstration products (id, name, category, price).
DEMO_PRODUCTS = [
    (1, "Laptop Dell XPS 15", "Electronics", 1500),
    (2, "Chuột Logitech G502", "Accessories", 50),
    (3, "Bàn phím cơ Keychron K8", "Accessories", 100),
    (4, "Màn hình LG UltraGear", "Electronics", 350),
]


def demo_products(spark: SparkSession) -> DataFrame:
    """Constant product rows stamped with the load time."""
    rows = spark.createDataFrame(
        DEMO_PRODUCTS, "product_id int, product_name string, category string, price int")
    return rows.withColumn("created_at", F.current_timestamp())
