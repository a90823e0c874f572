"""Query registry."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def comparable(df: DataFrame) -> DataFrame:
    """Types that both engines hand over alike: dates and timestamps as text,
    decimals as double."""
    columns = []
    for name, kind in df.dtypes:
        column = F.col(f"`{name}`")
        if kind in ("date", "timestamp", "timestamp_ntz"):
            column = column.cast("string")
        elif kind.startswith("decimal"):
            column = column.cast("double")
        columns.append(column.alias(name))
    return df.select(columns)


def query(name: str, sql: str | None = None):
    """Register a query and, if there is one, its SQL counterpart."""

    def register(build: Callable[[SparkSession, str], DataFrame]):
        @wraps(build)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return comparable(build(spark, sf_dir))

        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register
