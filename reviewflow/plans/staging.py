"""Silver rows -> typed staging rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewflow.functions.reviews import review_id, utc_date

# Staging name, source field and, where typed, the target type.
STAGED_FIELDS = [
    ("order_id", "orderID", None),
    ("product_name", "productName", None),
    ("category", "category", None),
    ("sub_category", "sub_category", None),
    ("brand", "brand", None),
    ("unit_price", "unitPrice", "decimal(10,2)"),
    ("quantity", "quantity", "int"),
    ("total_amount", "totalAmount", "decimal(12,2)"),
    ("store_id", "storeID", None),
    ("store_name", "storeName", None),
    ("city", "city", None),
    ("region", "region", None),
    ("store_type", "storeType", None),
    ("payment_id", "paymentID", None),
    ("payment_method", "paymentMethod", None),
    ("payment_status", "paymentStatus", None),
    ("shipping_id", "shippingID", None),
    ("shipping_method", "shippingMethod", None),
    ("carrier_name", "carrierName", None),
    ("shipping_status", "shippingStatus", None),
    ("user_id", "reviewerID", None),
    ("user_name", "reviewerName", None),
    ("product_id", "asin", None),
    ("rating_score", "overall", "decimal(3,1)"),
    ("review_text", "reviewText", None),
]


def with_review_date(df: DataFrame) -> DataFrame:
    """Add the UTC day of the review, the partition column of silver."""
    return df.withColumn("review_date", utc_date("unixReviewTime"))


def stage_reviews(silver: DataFrame) -> DataFrame:
    """Rename, cast, and add the review id and the date.

    One projection, so the scan below reads only what the caller uses of it.
    On the silver table the date is its partition column, and a filter on
    ``date_id`` skips whole folders.
    """
    fields = [
        (F.col(source) if kind is None else F.col(source).cast(kind)).alias(name)
        for name, source, kind in STAGED_FIELDS if source in silver.columns]
    derived = []
    if "review_date" in silver.columns:
        derived.append(F.col("review_date").alias("date_id"))
    elif "unixReviewTime" in silver.columns:
        derived.append(utc_date("unixReviewTime").alias("date_id"))
    if {"unixReviewTime", "reviewerID", "asin"} <= set(silver.columns):
        derived.append(review_id().alias("review_id"))
    return silver.select(*fields, *derived)
