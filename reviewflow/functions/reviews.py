"""Expressions over review fields."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SECONDS_PER_DAY = 86_400

# Lowest positive rating, the neutral one, highest negative one,
# and the benchmark the mean rating is compared with.
POSITIVE_FROM, NEUTRAL, NEGATIVE_TO = 4, 3, 2
RATING_BENCHMARK = 3.5


def utc_date(epoch_seconds: str | Column) -> Column:
    """Calendar day of an epoch second in UTC, whatever the session zone."""
    seconds = F.col(epoch_seconds) if isinstance(epoch_seconds, str) else epoch_seconds
    return F.date_from_unix_date(F.floor(seconds / SECONDS_PER_DAY).cast("int"))


def review_id() -> Column:
    """md5 over user, product and time; NULL when the time is NULL."""
    return F.md5(F.concat(
        F.coalesce("reviewerID", F.lit("")),
        F.coalesce("asin", F.lit("")),
        F.col("unixReviewTime").cast("string"),
    ))


def safe_rating(name: str) -> Column:
    """Rating as double; text that is no number becomes NULL."""
    return F.col(name).try_cast("double")


def sentiment(rating: str | Column) -> Column:
    value = F.col(rating) if isinstance(rating, str) else rating
    return (
        F.when(value >= POSITIVE_FROM, "positive")
        .when(value == NEUTRAL, "neutral")
        .otherwise("negative")
    )


def count_positive(rating: Column) -> Column:
    return F.count_if(rating >= POSITIVE_FROM)


def count_negative(rating: Column) -> Column:
    return F.count_if(rating <= NEGATIVE_TO)
