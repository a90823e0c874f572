"""Column selection, union and first rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewflow.functions.reviews import safe_rating


def select_existing(df: DataFrame, wanted: list[str], rename: dict[str, str] | None = None,
                    drop: list[str] | None = None) -> DataFrame:
    """The ``wanted`` columns that ``df`` has, in that order, then renamed."""
    kept = [name for name in wanted if name in df.columns and name not in (drop or [])]
    return df.select(kept).withColumnsRenamed({k: v for k, v in (rename or {}).items() if k in kept})


def union_by_name(*frames: DataFrame) -> DataFrame:
    """All rows of all frames; columns a frame lacks are NULL."""
    return reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), frames)


def check_columns(df: DataFrame, required: list[str]) -> tuple[list[str], list[str], DataFrame | None]:
    """Missing columns, present columns, and a 3-row peek if any is missing."""
    missing = [name for name in required if name not in df.columns]
    return missing, df.columns, df.limit(3) if missing else None


def safe_rating_rows(df: DataFrame, column: str = "overall") -> DataFrame:
    """Rating cast to double, rows without a usable rating dropped."""
    return df.withColumn(column, safe_rating(column)).where(F.col(column).isNotNull())


def table_audit(df: DataFrame) -> DataFrame:
    """One row: row count, column count and the schema as DDL text."""
    ddl = ", ".join(f"{name} {kind}" for name, kind in df.dtypes)
    return df.agg(F.count("*").alias("row_count")).select(
        "row_count", F.lit(len(df.columns)).alias("column_count"), F.lit(ddl).alias("schema_ddl"))
