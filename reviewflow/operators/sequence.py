"""Row numbers and rolling means over a global order, without a one-task window."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reviewflow.session import materialize

# monotonically_increasing_id: partition number above bit 33, row below it.
_SLOT_BITS = 33

CHUNK_ROWS = 200_000


def with_sequence(df: DataFrame, order: list[str], name: str = "seq") -> DataFrame:
    """Number all rows from 1 by ``order``.

    A range-partitioned sort is written once; each row remembers its place in
    its partition, and the only global step adds up one count per partition.
    Rows equal in ``order`` go by a hash of the whole row and then by where
    they were read, so a frequent order key is spread over many partitions.
    """
    whole = F.xxhash64(*[F.col(f"`{name}`") for name, kind in df.dtypes if "map<" not in kind])
    ranged = df.withColumns({"_whole": whole, "_read": F.monotonically_increasing_id()}).orderBy(*order, "_whole", "_read")
    placed = materialize(
        ranged.drop("_whole", "_read").withColumn("_slot", F.monotonically_increasing_id()), "sequence")
    part = F.shiftright("_slot", _SLOT_BITS)
    place = F.col("_slot").bitwiseAND((1 << _SLOT_BITS) - 1)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        placed.groupBy(part.alias("_part")).agg(F.count("*").alias("_rows"))
        .select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    )
    # One row per sort partition: its size is bounded by the partition count.
    numbered = placed.withColumn("_part", part).join(F.broadcast(starts), "_part")
    return numbered.select(*df.columns, (F.col("_before") + place + 1).alias(name))


def rolling_mean(df: DataFrame, column: str, order: list[str], n: int = 20, by: list[str] | None = None,
                 name: str = "rolling_avg", chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Mean over the last ``n`` rows (fewer at the start), optionally per key.

    Rows are cut into equal chunks of the sequence; the last n-1 rows of a
    chunk also visit the next one, so every window is complete inside its
    chunk and no key, however frequent, makes a chunk larger.
    """
    if chunk_rows < n:
        raise ValueError("a chunk must hold at least one window")
    by = by or []
    position = F.col("seq") - 1
    home = F.floor(position / chunk_rows)
    visits = F.when(position % chunk_rows >= chunk_rows - (n - 1), F.array(home, home + 1)).otherwise(F.array(home))
    spread = (
        with_sequence(df, [*by, *order])
        .withColumn("_home", home)
        .withColumn("_chunk", F.explode(visits))
    )
    window = Window.partitionBy("_chunk", *by).orderBy("seq").rowsBetween(-(n - 1), Window.currentRow)
    rolled = spread.withColumn(name, F.avg(column).over(window))
    return rolled.where(F.col("_chunk") == F.col("_home")).drop("_chunk", "_home")
