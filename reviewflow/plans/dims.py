"""Dimensions from staging rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewflow.operators.history import dim_from_history

# Key and compared attributes of the two historised dimensions.
PRODUCT_KEY = "product_id"
PRODUCT_CHECK = ["product_name", "category", "sub_category", "brand", "unit_price"]
STORE_KEY = "store_id"
STORE_CHECK = ["store_name", "city", "region", "store_type"]


def _largest_per_key(staged: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """The largest of text makes Spark sort its input, so repeated rows are dropped by hash first."""
    return (
        staged.where(F.col(key).isNotNull()).select(key, *columns).distinct().groupBy(key)
        .agg(*[F.max(name).alias(name) for name in columns])
    )


def current_products(staged: DataFrame) -> DataFrame:
    """One row per product with the lexically largest value of each attribute."""
    return _largest_per_key(staged, PRODUCT_KEY, PRODUCT_CHECK)


def current_stores(staged: DataFrame) -> DataFrame:
    return _largest_per_key(staged, STORE_KEY, STORE_CHECK)


def dim_products(history: DataFrame) -> DataFrame:
    return dim_from_history(history, PRODUCT_KEY, PRODUCT_CHECK, "product_sk", "original_product_id")


def dim_stores(history: DataFrame) -> DataFrame:
    return dim_from_history(history, STORE_KEY, STORE_CHECK, "store_sk", "original_store_id")


def dim_users(staged: DataFrame) -> DataFrame:
    """Counted by user and name first, without a sort, then by user."""
    named = staged.where(F.col("user_id").isNotNull()).groupBy("user_id", "user_name").agg(
        F.count("review_id").alias("total_reviews_written"),
        F.min("date_id").alias("first_review_date"),
        F.max("date_id").alias("last_review_date"))
    return merge_users(named)


def merge_users(rows: DataFrame) -> DataFrame:
    """One row per user of several."""
    return rows.groupBy("user_id").agg(
        F.max("user_name").alias("user_name"), F.sum("total_reviews_written").alias("total_reviews_written"),
        F.min("first_review_date").alias("first_review_date"), F.max("last_review_date").alias("last_review_date"))


def dim_payments(staged: DataFrame) -> DataFrame:
    return _largest_per_key(staged, "payment_id", ["payment_method", "payment_status"])


def dim_date(staged: DataFrame) -> DataFrame:
    """Calendar rows for every date that occurs; the weekday is padded to 9."""
    day = F.col("date_id")
    return staged.select(day).where(day.isNotNull()).distinct().select(
        day,
        F.year(day).alias("review_year"),
        F.month(day).alias("review_month"),
        F.dayofmonth(day).alias("review_day"),
        F.rpad(F.date_format(day, "EEEE"), 9, " ").alias("day_of_week"))
