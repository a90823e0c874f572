"""Schemas at the edges of the flow."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType, BooleanType, DoubleType, IntegerType, LongType, MapType, StringType, StructField, StructType,
)


def _nullable(**fields) -> StructType:
    return StructType([StructField(name, kind, True) for name, kind in fields.items()])


_TEXT, _REAL, _INT, _LONG = StringType(), DoubleType(), IntegerType(), LongType()

# Field names and types of one review/order message.
_REVIEW = _nullable(
    reviewerID=_TEXT, asin=_TEXT, reviewerName=_TEXT, helpful=ArrayType(_LONG), reviewText=_TEXT,
    overall=_REAL, summary=_TEXT, unixReviewTime=_LONG, reviewTime=_TEXT, day_diff=_INT,
    helpful_yes=_INT, total_vote=_INT,
)
_PRODUCT = _nullable(
    productName=_TEXT, category=_TEXT, sub_category=_TEXT, brand=_TEXT, unitPrice=_REAL,
    orderID=_TEXT, quantity=_INT, totalAmount=_REAL,
)
_STORE = _nullable(storeID=_TEXT, storeName=_TEXT, city=_TEXT, region=_TEXT, storeType=_TEXT)
_PAYMENT = _nullable(paymentID=_TEXT, paymentMethod=_TEXT, paymentStatus=_TEXT)
_SHIPPING = _nullable(shippingID=_TEXT, shippingMethod=_TEXT, carrierName=_TEXT, shippingStatus=_TEXT)

REVIEW_SCHEMA = StructType(
    [field for group in (_REVIEW, _PRODUCT, _STORE, _PAYMENT, _SHIPPING) for field in group]
)

# A rejected message keeps its original text next to whatever could be parsed.
DLQ_SCHEMA = StructType([*REVIEW_SCHEMA, StructField("raw_json", StringType(), True)])

# Nested layout of the two stream logs and of the ingest log.
BRONZE_LOG_SCHEMA = StructType([
    StructField("timestamp", StringType()),
    StructField("batch_id", LongType()),
    StructField("metrics", _nullable(
        total_received=_LONG, valid_records=_LONG, invalid_records=_LONG,
        error_rate_percent=_REAL, processing_time_ms=_REAL)),
    StructField("data_quality", _nullable(is_acceptable=BooleanType(), sample_error_data=ArrayType(_TEXT))),
])

SILVER_LOG_SCHEMA = StructType([
    StructField("timestamp", StringType()),
    StructField("batch_id", LongType()),
    StructField("performance", _nullable(
        input_rows_per_second=_REAL, processed_rows_per_second=_REAL, total_input_rows=_LONG,
        duration_ms=MapType(_TEXT, _LONG))),
    StructField("processing_time", _nullable(
        addBatch=_LONG, getBatch=_LONG, queryPlanning=_LONG, triggerExecution=_LONG)),
])

RAW_LOG_SCHEMA = StructType([
    StructField("timestamp", StringType()),
    StructField("metadata", _nullable(source=_TEXT, status=_TEXT, process_time_ms=_REAL, size_bytes=_LONG)),
    StructField("data_content", REVIEW_SCHEMA),
])
