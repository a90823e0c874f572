"""Top-k, latest rows, feeds. Every cut has an explicit order."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewflow.functions.clock import clock_label, local_time
from reviewflow.functions.reviews import NEGATIVE_TO, POSITIVE_FROM
from reviewflow.functions.search import search_rows
from reviewflow.operators.shape import select_existing

# Columns of the customer-voice feed and its length.
FEED_COLUMNS = ["asin", "overall", "reviewerName", "summary", "reviewText"]
FEED_ROWS = 30


# monotonically_increasing_id: task number above bit 33, row in the task below it.
_PLACE = (1 << 33) - 1


def _first_of_each_task(df: DataFrame, n: int, order: list[Column | str]) -> DataFrame:
    """The first ``n`` rows of every task, without a shuffle and for any ``n``."""
    sorted_rows = df.sortWithinPartitions(*order).withColumn("_place", F.monotonically_increasing_id().bitwiseAND(F.lit(_PLACE)))
    return sorted_rows.where(F.col("_place") < n).drop("_place")


def top_rows(df: DataFrame, n: int, order: list[Column | str]) -> DataFrame:
    """The first ``n`` rows by ``order``, rows equal in it by a hash of the whole row.

    Every task keeps its own n rows; about as many tasks as the square root of
    the shuffle partitions merge those, and one task the rest. So the last task
    reads few times n rows on a cluster of any size.
    """
    shards = max(math.isqrt(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))), 1)
    total = [*order, F.xxhash64(*[F.col(f"`{name}`") for name, kind in df.dtypes if "map<" not in kind and kind != "variant"])]
    heads = _first_of_each_task(df, n, total).repartition(shards, F.spark_partition_id())
    return _first_of_each_task(heads, n, total).orderBy(*total).limit(n)


def latest_rows(df: DataFrame, n: int, order: list[str]) -> DataFrame:
    """The last ``n`` rows by ``order``, latest first."""
    return top_rows(df, n, [F.desc(name) for name in order])


def latest_row(df: DataFrame, *order: str) -> DataFrame:
    """The single latest row, found by aggregation instead of a sort."""
    newest = F.max_by(F.struct("*"), F.struct(*order))
    return df.agg(newest.alias("row")).where("row is not null").select("row.*")


def latest_metrics(df: DataFrame, n: int = 30, keyword: str = "", time: str = "timestamp",
                   ascending: bool = True) -> DataFrame:
    """Latest ``n`` metric rows that match ``keyword``, with local time and label."""
    local = local_time(time)
    shown = df.withColumns({"timestamp_tz": local, "time_label": clock_label(local)})
    newest = search_rows(shown, keyword).orderBy(F.desc(time)).limit(n)
    return newest.orderBy(F.asc(time) if ascending else F.desc(time))


def top_products(df: DataFrame, n: int = 10) -> DataFrame:
    """Most mentioned products; equal counts go by id."""
    counted = df.groupBy("asin").agg(F.count("*").alias("mentions"))
    return counted.orderBy(F.desc("mentions"), F.asc("asin")).limit(n)


def feed(df: DataFrame, kind: str, order: list[str | Column], n: int = FEED_ROWS) -> DataFrame:
    """Customer feed: ``negative`` is complete, ``positive`` and ``all`` show ``n`` rows."""
    rating = F.col("overall")
    rows = {
        "all": df,
        "negative": df.where(rating <= NEGATIVE_TO),
        "positive": df.where(rating >= POSITIVE_FROM),
    }[kind]
    if kind != "negative":
        rows = top_rows(rows, n, order)
    return select_existing(rows, FEED_COLUMNS)
