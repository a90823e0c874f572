"""Warehouse tables over JDBC."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Rows per insert batch and parallel connections.
BATCH_ROWS = 10_000
CONNECTIONS = 4


def query_options(url: str, sql: str, **credentials: str) -> dict[str, str]:
    """Options that make the database run ``sql`` and return its result."""
    return {"url": url, "dbtable": f"({sql}) t", **credentials}


def write_options(url: str, table: str, batch_rows: int = BATCH_ROWS, connections: int = CONNECTIONS,
                  **credentials: str) -> dict[str, str]:
    return {
        "url": url, "dbtable": table, "batchsize": str(batch_rows),
        "numPartitions": str(connections), **credentials,
    }


def max_query(table: str, column: str) -> str:
    """Largest loaded value; the quoted name keeps its letter case."""
    return f'SELECT MAX("{column}") AS max_loaded FROM {table}'


def read_jdbc_query(spark: SparkSession, url: str, sql: str, **credentials: str) -> DataFrame:
    return spark.read.format("jdbc").options(**query_options(url, sql, **credentials)).load()


def write_jdbc(df: DataFrame, url: str, table: str, **options) -> None:
    """Append through at most ``connections`` parallel connections."""
    df.write.format("jdbc").options(**write_options(url, table, **options)).mode("append").save()


def loaded_maximum(spark: SparkSession, url: str, table: str, column: str, **credentials: str):
    """Largest ``column`` in the target, 0 when the table is empty or absent.

    Only "no such table" counts as absent; every other failure is raised.
    """
    try:
        row = read_jdbc_query(spark, url, max_query(table, column), **credentials).first()
    except Exception as error:
        if not _is_missing_table(error):
            raise
        return 0
    return row.max_loaded if row.max_loaded is not None else 0


# SQLSTATE codes with which databases report an unknown table.
MISSING_TABLE_STATES = ("42P01", "42S02", "42X05", "42Y07")


def _is_missing_table(error: Exception) -> bool:
    cause = getattr(error, "java_exception", None) or getattr(error, "_origin", None)
    while cause is not None:
        state = getattr(cause, "getSQLState", None)
        try:
            if state is not None and state() in MISSING_TABLE_STATES:
                return True
        except Exception:
            pass  # the JVM class has no SQL state
        cause = cause.getCause()
    return any(code in str(error) for code in MISSING_TABLE_STATES)
