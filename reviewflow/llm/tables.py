"""Reading and keeping tables, shared by the operators of this package."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from reviewflow.session import let_go, materialize

# Stands in for a null id where ids are compared or joined; sorts before all others.
NO_ID = -(1 << 63)
# Files whose names are broadcast to number rows, some MB at most, and bits for the rows of one.
MOST_FILES = 20_000
ROWS_BITS = 40


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def saved(df: DataFrame, label: str) -> DataFrame:
    """Write once to the shared folder and read back: later stages never recompute it, and no lost executor holds it.

    What it was made of is let go: shuffles on disk, and plans and their texts, which else fill the driver's heap.
    """
    kept = materialize(df, f"llm-{label}")
    let_go(df.sparkSession)
    return kept


def new_names(df: DataFrame, *names: str) -> list[str]:
    """The names, with underscores in front until no column of ``df`` has them."""
    taken = {column.lower() for column in df.columns}
    depth = 1
    while any("_" * depth + name in taken for name in names):
        depth += 1
    return ["_" * depth + name for name in names]


def _place_in_files(docs: DataFrame, name: str) -> DataFrame | None:
    """``docs`` with a number made of each row's file and place in it, where it is Parquet files as they are; else None."""
    if not re.fullmatch(r"Relation \[.*\] parquet", docs._jdf.queryExecution().analyzed().toString().strip(), re.S):
        return None
    if len(docs.inputFiles()) > MOST_FILES:
        return None
    metadata = docs.metadataColumn("_metadata")
    file, place, number = new_names(docs, f"{name}_file", f"{name}_place", f"{name}_number")
    paths = sorted(row[0] for row in docs.select(metadata.getField("file_path")).distinct().collect())
    files = docs.sparkSession.createDataFrame(list(zip(paths, range(len(paths)))), f"`{file}` string, `{number}` long")
    placed = docs.select("*", metadata.getField("file_path").alias(file), metadata.getField("row_index").alias(place))
    row = F.shiftleft(F.col(number), ROWS_BITS).bitwiseOR(F.col(place))
    return placed.join(F.broadcast(files), file).select(*[docs[f"`{column}`"] for column in docs.columns], row.alias(name))


def numbered(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with a unique number of each row, which it keeps, and that column's name.

    Rows of a Parquet table are numbered by their file and place in it. Any
    other frame is written once.

    This is where a stage over a whole table starts, so what earlier stages
    shuffled and nothing refers to any more is let go.
    """
    let_go(docs.sparkSession)
    name, = new_names(docs, "row")
    placed = _place_in_files(docs, name)
    if placed is None:
        placed = saved(docs.withColumn(name, F.monotonically_increasing_id()), "numbered")
    return placed, name


def repeat_rows(docs: DataFrame, name: str, rows: DataFrame, copies: str) -> DataFrame:
    """The rows of ``docs``, numbered by its column ``name``, whose number is in ``rows.row``; without that column.

    Each row comes as often as ``copies``, a column of ``rows``, says. Ids play
    no part, so rows that share one (or have none) count each for itself.
    """
    times, copy = new_names(docs, "times", "copy")
    wanted = rows.select(F.col("row").alias(name), F.col(copies).cast("int").alias(times))
    kept = docs.join(wanted, name).withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(times))))
    return kept.select(*[F.col(f"`{column}`") for column in docs.columns if column != name])


def running_total(df: DataFrame, order: list[str], value: str, by: str | None = None, label: str = "running") -> DataFrame:
    """Add ``total``: the sum of ``value`` over the rows up to this one by ``order``, inside ``by`` if given.

    ``by`` must lead the order. A range sort with sampled splitters deals out
    the rows, so a frequent ``by`` is split over many tasks; each task adds up
    its own rows, and what came before it is one row for each task (and value
    of ``by`` in it).
    """
    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        last, carried = None, 0
        for batch in batches:
            frame = batch.to_pandas()
            if not len(frame):
                continue
            keys = frame[by] if by else frame[value] * 0
            sums = frame[value].groupby(keys, sort=False).cumsum()
            sums = sums.where(keys != last, sums + carried)
            last, carried = keys.iloc[-1], sums.iloc[-1]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(sums.to_numpy(), pa.int64()), pa.array([part] * len(frame), pa.int32())],
                [*batch.schema.names, "_within", "_part"])

    schema = ", ".join(f"`{n}` {t}" for n, t in df.dtypes) + ", _within long, _part int"
    placed = saved(df.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(add_up, schema), label)
    keys = ["_part", by] if by else ["_part"]
    window = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    if by:
        window = Window.partitionBy(by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = placed.groupBy(*keys).agg(F.sum(value).alias("_sum")).select(
        *keys, F.coalesce(F.sum("_sum").over(window), F.lit(0)).alias("_before"))
    # Without ``by`` there is one row for each task of the sort, so it fits anywhere.
    before = before if by else F.broadcast(before)
    return placed.join(before, keys).select(*df.columns, (F.col("_before") + F.col("_within")).alias("total"))


def ascii_lower(column: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(column, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
