"""Parse raw messages and split them into valid and rejected rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from reviewflow.functions.quality import error_percent, is_acceptable, is_invalid
from reviewflow.schema import REVIEW_SCHEMA

BRONZE, DLQ = "bronze", "dlq"


def parse_reviews(df: DataFrame, value: str = "value", fields: list[str] | None = None,
                  keep: tuple[str | Column, ...] = ()) -> DataFrame:
    """Message bytes or text -> the typed review fields plus ``raw_json``.

    Text that is no JSON gives a row of NULL fields. ``fields`` parses only
    those; ``keep`` are columns to pass on beside them. The struct is unpacked by a generator: filters and projections
    above see plain columns, so no message is parsed once per use of a field.
    """
    schema = REVIEW_SCHEMA if fields is None else StructType([REVIEW_SCHEMA[name] for name in fields])
    raw = df.select(F.col(value).cast("string").alias("raw_json"), *keep)
    parsed = raw.select("*", F.inline(F.array(F.from_json("raw_json", schema))))
    return parsed.select(*schema.fieldNames(), *raw.columns)


def mark_route(parsed: DataFrame) -> DataFrame:
    """Add ``route``; only rejected rows keep their raw text."""
    marked = parsed.withColumn("route", F.when(is_invalid(), DLQ).otherwise(BRONZE))
    return marked.withColumn("raw_json", F.when(F.col("route") == DLQ, F.col("raw_json")))


def route(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid rows without raw text, rejected rows with it)."""
    return parsed.where(~is_invalid()).drop("raw_json"), parsed.where(is_invalid())


def batch_counts() -> list:
    """Aggregates over routed rows that describe one batch."""
    return [
        F.count("*").alias("total_received"),
        F.count_if(F.col("route") == BRONZE).alias("valid_records"),
        F.count_if(F.col("route") == DLQ).alias("invalid_records"),
    ]


def batch_quality(routed: DataFrame, *by: str) -> DataFrame:
    """Totals, reject share and verdict, per group or for the whole batch."""
    counted = routed.groupBy(*by).agg(*batch_counts())
    invalid, total = F.col("invalid_records"), F.col("total_received")
    return counted.withColumns({
        "error_rate_percent": error_percent(invalid, total),
        "is_acceptable": is_acceptable(invalid, total),
    })


def reject_samples(rejected: DataFrame, rows: int = 5) -> DataFrame:
    """A few raw texts to show next to the batch verdict."""
    return rejected.select("raw_json").limit(rows)
