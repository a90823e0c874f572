"""Row validity and batch-quality expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted rating range, the placeholder written for a missing
# id, and the share of rejects from which a batch is no longer acceptable.
MIN_RATING, MAX_RATING = 1, 5
MISSING_ID = "None"
MAX_REJECT_SHARE = 0.2


def _bad_id(name: str) -> Column:
    # NULL folds into '' so the result is never NULL.
    return F.coalesce(F.col(name), F.lit("")).isin("", MISSING_ID)


def is_invalid() -> Column:
    """True for rows that belong in the dead-letter table; never NULL."""
    rating = F.col("overall")
    in_range = F.coalesce(rating.between(MIN_RATING, MAX_RATING), F.lit(False))
    return _bad_id("reviewerID") | _bad_id("asin") | ~in_range


def required_fields_present() -> Column:
    """Minimal rule: both ids and the rating are not null."""
    return F.col("reviewerID").isNotNull() & F.col("asin").isNotNull() & F.col("overall").isNotNull()


def error_percent(invalid: Column, total: Column) -> Column:
    """Share of rejects in percent, two decimals, 0 for an empty batch."""
    return F.round(F.coalesce(F.try_divide(invalid, total) * 100.0, F.lit(0.0)), 2)


def is_acceptable(invalid: Column, total: Column) -> Column:
    return F.coalesce(F.try_divide(invalid, total) < MAX_REJECT_SHARE, F.lit(True))
