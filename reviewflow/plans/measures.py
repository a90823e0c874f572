"""Business measures over reviews and facts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewflow.functions.reviews import (
    RATING_BENCHMARK, count_negative, count_positive, sentiment,
)
from reviewflow.schema import REVIEW_SCHEMA


def batch_kpis(valid: DataFrame) -> DataFrame:
    """Count, mean rating (two decimals), positive and negative counts; 0 if empty."""
    rating = F.col("overall")
    return valid.agg(
        F.count("*").alias("total_reviews"),
        F.round(F.coalesce(F.avg(rating), F.lit(0.0)), 2).alias("avg_rating"),
        count_positive(rating).alias("positive_count"),
        count_negative(rating).alias("negative_count"))


def business_kpis(rated: DataFrame) -> DataFrame:
    rating = F.col("overall")
    sums = rated.agg(
        F.count("*").alias("total_reviews"), F.avg(rating).alias("avg_rating"),
        count_positive(rating).alias("positive_count"), count_negative(rating).alias("negative_count"))
    share = F.coalesce(F.try_divide("positive_count", "total_reviews") * 100.0, F.lit(0.0))
    return sums.select(
        "total_reviews", "avg_rating", share.alias("positive_percent"), "negative_count",
        (F.col("avg_rating") - RATING_BENCHMARK).alias("delta_to_benchmark"))


def with_sentiment(rated: DataFrame) -> DataFrame:
    return rated.withColumn("sentiment", sentiment("overall"))


def sentiment_share(rated: DataFrame) -> DataFrame:
    return rated.groupBy(sentiment("overall").alias("sentiment")).agg(F.count("*").alias("reviews"))


def executive_kpis(fact: DataFrame) -> DataFrame:
    """Revenue, order rows and mean rating of the fact table."""
    return fact.agg(
        F.sum("total_amount").alias("total_revenue"),
        F.count("*").alias("total_orders"),
        F.avg(F.col("rating_score").cast("double")).alias("avg_rating"))


def revenue_by_store(fact: DataFrame) -> DataFrame:
    revenue = fact.groupBy("original_store_id").agg(F.sum("total_amount").alias("revenue"))
    return revenue.orderBy(F.desc("revenue"))


def rating_distribution(fact: DataFrame) -> DataFrame:
    rounded = F.round("rating_score", 0).cast("int")
    return fact.groupBy(rounded.alias("rounded_rating")).agg(F.count("*").alias("reviews"))


def ingest_stats(messages: DataFrame, text: str, *by: str) -> DataFrame:
    """Message count and byte sizes, per source."""
    size = F.octet_length(text)
    return messages.groupBy(*by).agg(
        F.count("*").alias("messages"),
        F.sum(size).alias("total_bytes"),
        F.avg(size).alias("avg_bytes"),
        F.max(size).cast("bigint").alias("max_bytes"))


def ingest_log(messages: DataFrame, text: str, source: str = "raw_data_ingestion") -> DataFrame:
    """Log envelope per message, around its parsed content."""
    return messages.select(
        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp"),
        F.struct(
            F.lit(source).alias("source"), F.lit("ingested").alias("status"),
            F.lit(None).cast("double").alias("process_time_ms"),
            F.octet_length(text).cast("bigint").alias("size_bytes")).alias("metadata"),
        F.from_json(text, REVIEW_SCHEMA).alias("data_content"))
