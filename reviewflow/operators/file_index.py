"""Which files of a large folder may hold an id?

For each file the index has a blocked Bloom filter of the ids in it, a row for
each word that has bits. Looking up a few ids reads the index, then only the
files that may hold one of them. New files are added without reading old ones.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewflow.functions.bloom import bits_of, block_of
from reviewflow.operators.trace import TRACE_KEYS
from reviewflow.sources.files import list_files
from reviewflow.sources.folders import exists

# Words of a file's filter: 32 KB, one id in some hundreds let through by mistake at 16,000 ids a file.
BLOCKS = 4096
INDEX_SCHEMA = "path string, block int, word long"


def own_path() -> Column:
    """The file a row is read from, written as in a listing: characters as they are, no empty host."""
    plain = F.url_decode(F.replace(F.input_file_name(), F.lit("+"), F.lit("%2B")))
    return F.replace(plain, F.lit(":///"), F.lit(":/"))


def file_filters(rows: DataFrame, keys: list[str] | None = None, blocks: int = BLOCKS) -> DataFrame:
    """(path, block, word) of the files that ``rows`` are read from; a file without ids has one empty word."""
    # The path first: beside the explode it would be made for each id.
    ids = rows.select(own_path().alias("path"), F.array(*(keys or TRACE_KEYS)).alias("ids"))
    return filters_of(ids.select("path", F.explode("ids").alias("id")), blocks)


def filters_of(ids: DataFrame, blocks: int = BLOCKS) -> DataFrame:
    """(path, block, word) of rows of path and id."""
    known = F.col("id").isNotNull()
    return ids.select(
        "path", F.when(known, block_of(F.col("id"), blocks)).otherwise(0).alias("block"),
        F.when(known, bits_of(F.col("id"))).otherwise(F.lit(0).cast("long")).alias("word")).groupBy("path", "block").agg(
        F.bit_or("word").alias("word"))


def read_index(spark: SparkSession, index: str) -> DataFrame:
    if not exists(spark, index):
        return spark.createDataFrame([], INDEX_SCHEMA)
    return spark.read.schema(INDEX_SCHEMA).option("recursiveFileLookup", True).parquet(index)


def update_index(spark: SparkSession, index: str, folder: str, read: Callable[[list[str]], DataFrame],
                 keys: list[str] | None = None, pattern: str | None = None, blocks: int = BLOCKS,
                 make: Callable[[DataFrame], DataFrame] | None = None) -> list[str]:
    """Index the files of ``folder`` that are not in ``index`` yet, and return them.

    ``read`` makes rows with the ``keys`` of a list of files; ``make`` turns
    them into filters, by default ``file_filters``. Files must not change once
    written. A file that was indexed twice, by jobs side by side, does no harm.
    """
    fresh = new_files(spark, index, folder, pattern)
    if fresh:
        filters = make(read(fresh)) if make else file_filters(read(fresh), keys, blocks)
        filters.write.mode("append").parquet(index)
    return fresh


def new_files(spark: SparkSession, index: str, folder: str, pattern: str | None = None) -> list[str]:
    """Files of ``folder`` that are not in ``index``: names that the reader needs on the driver as any list of inputs."""
    listed = list_files(spark, folder, pattern).select("path").where("path NOT RLIKE '/[_.][^/]*$'")
    known = read_index(spark, index).select(F.col("path")).distinct()
    return [row.path for row in listed.join(known, "path", "left_anti").orderBy("path").collect()]


def candidate_files(ids: DataFrame, index: DataFrame, blocks: int = BLOCKS) -> list[str]:
    """The files that may hold one of the ids (first column of ``ids``); meant for a few ids."""
    wanted = ids.select(F.col(ids.columns[0]).alias("id")).where("id IS NOT NULL").distinct().select(
        block_of(F.col("id"), blocks).alias("block"), bits_of(F.col("id")).alias("bits"))
    hits = index.join(wanted, "block").where(F.col("word").bitwiseAND(F.col("bits")) == F.col("bits"))
    return [row.path for row in hits.select("path").distinct().orderBy("path").collect()]
