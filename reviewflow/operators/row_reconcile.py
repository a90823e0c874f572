"""Which rows differ between two tables that should hold the same ones?

Each table is summed up by day and hash bucket in fingerprints that do not
depend on the order of the rows: their number, the sum and the exclusive or of
their 64-bit hashes. Fingerprints of parts add up to those of the whole, so
they are kept with the loads and only new loads are read again. Row data is
read of differing cells alone, and of files of their days alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 256
# So many differing days become a filter that prunes partitions; beyond that nearly all files are read anyway.
PRUNED_DAYS = 1000


def row_hash(columns: list[str], seed: int = 0) -> Column:
    """64-bit hash of a row; a null is unlike any value and shows in its place."""
    parts: list[Column] = [F.lit(seed)]
    for name in columns:
        parts += [F.col(name), F.col(name).isNull()]
    return F.xxhash64(*parts)


def fingerprints(rows: DataFrame, columns: list[str], day: str, buckets: int = BUCKETS) -> DataFrame:
    """(day, bucket, n, total, mixed) of the multiset of rows; two rows are equal if all ``columns`` and the day are."""
    hashed = rows.select(F.col(day).alias("day"), row_hash(columns).alias("_hash"), _bucket(columns, buckets).alias("bucket"))
    return hashed.groupBy("day", "bucket").agg(
        F.count("*").alias("n"), F.sum(F.col("_hash").cast("decimal(20,0)")).cast("decimal(38,0)").alias("total"), F.bit_xor("_hash").alias("mixed"))


def _bucket(columns: list[str], buckets: int) -> Column:
    return F.pmod(row_hash(columns, 1), F.lit(buckets)).cast("int")


def merge_fingerprints(*parts: DataFrame) -> DataFrame:
    """The fingerprints of all rows together, from those of parts of them."""
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    return rows.groupBy("day", "bucket").agg(
        F.sum("n").alias("n"), F.sum("total").cast("decimal(38,0)").alias("total"), F.bit_xor("mixed").alias("mixed"))


def differing_cells(left: DataFrame, right: DataFrame) -> DataFrame:
    """(day, bucket, n_left, n_right) of the cells whose fingerprints differ; a null day is a day of its own."""
    one, two = left.alias("l"), right.alias("r")
    both = one.join(two, F.col("l.day").eqNullSafe(F.col("r.day")) & (F.col("l.bucket") == F.col("r.bucket")), "full")
    same = (F.col("l.n") == F.col("r.n")) & (F.col("l.total") == F.col("r.total")) & (F.col("l.mixed") == F.col("r.mixed"))
    return both.where(~F.coalesce(same, F.lit(False))).select(
        F.coalesce("l.day", "r.day").alias("day"), F.coalesce("l.bucket", "r.bucket").alias("bucket"),
        F.coalesce("l.n", F.lit(0)).alias("n_left"), F.coalesce("r.n", F.lit(0)).alias("n_right"))


def rows_of_cells(rows: DataFrame, cells: DataFrame, columns: list[str], day: str, buckets: int = BUCKETS) -> DataFrame:
    """The rows in the given cells. Few differing days prune the files of a table partitioned by ``day``."""
    # At most as many values as there are days, and no more than the bound are fetched.
    days = [row.day for row in cells.select("day").distinct().limit(PRUNED_DAYS + 1).collect()]
    if len(days) <= PRUNED_DAYS:
        known = F.col(day).isin([value for value in days if value is not None])
        rows = rows.where(known | F.col(day).isNull() if None in days else known)
    cell = cells.select(F.col("day").alias("_cell_day"), F.col("bucket").alias("_cell_bucket"))
    matches = F.col(day).eqNullSafe(F.col("_cell_day")) & (_bucket(columns, buckets) == F.col("_cell_bucket"))
    return rows.join(cell, matches, "left_semi")


def differing_rows(left: DataFrame, right: DataFrame, cells: DataFrame, columns: list[str], day: str, buckets: int = BUCKETS) -> DataFrame:
    """The rows that one table has more often than the other, with how often each has them: n_left, n_right."""
    counted = [rows_of_cells(rows, cells, columns, day, buckets).select(
        *columns, day, F.lit(mine).alias("_left"), F.lit(1 - mine).alias("_right")) for rows, mine in ((left, 1), (right, 0))]
    return counted[0].unionByName(counted[1]).groupBy(*columns, day).agg(
        F.sum("_left").alias("n_left"), F.sum("_right").alias("n_right")).where("n_left <> n_right")


def reconcile_rows(left: DataFrame, right: DataFrame, columns: list[str], day: str, buckets: int = BUCKETS) -> DataFrame:
    """``differing_rows`` of two whole tables: two scans of their hashes, then the rows of differing cells.

    Rows are compared by ``columns`` and ``day``, which both tables have with
    like types (no maps); repeated rows count each time and nulls equal nulls.
    Tables with the same rows, or none, give no rows. Cells that differ could
    only go unseen if number, sum and exclusive or of 64-bit hashes all agreed.
    """
    cells = differing_cells(fingerprints(left, columns, day, buckets), fingerprints(right, columns, day, buckets))
    return differing_rows(left, right, cells, columns, day, buckets)
