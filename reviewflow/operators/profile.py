"""Null profile and root causes of rejected rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: fields checked as root cause.
CAUSE_FIELDS = ["reviewerID", "asin", "overall"]


def null_profile(df: DataFrame) -> DataFrame:
    """(column_name, null_count) of every column that has NULLs, in one pass."""
    counts = df.agg(*[F.count_if(F.col(f"`{name}`").isNull()).alias(name) for name in df.columns])
    return (
        counts.unpivot([], [f"`{name}`" for name in df.columns], "column_name", "null_count")
        .where(F.col("null_count") > 0)
    )


def dlq_root_cause(df: DataFrame) -> DataFrame:
    """Rejected rows in total and per missing field; absent fields are skipped."""
    return df.agg(
        F.count("*").alias("total_rejected"),
        *[F.count_if(F.col(name).isNull()).alias(f"missing_{name}")
          for name in CAUSE_FIELDS if name in df.columns])


def dlq_alert(df: DataFrame, recipients: str) -> DataFrame:
    """One alert row for ``recipients`` when anything was rejected, else none."""
    causes = dlq_root_cause(df)
    fields = [name.removeprefix("missing_") for name in causes.columns if name.startswith("missing_")]
    text = F.concat_ws("; ", *[
        F.concat(F.lit(f"{name}: "), F.col(f"missing_{name}").cast("string")) for name in fields])
    return causes.where(F.col("total_rejected") > 0).withColumns({
        "causes": text, "recipients": F.lit(recipients)})
