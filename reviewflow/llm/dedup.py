"""Exact deduplication by sorting content."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewflow.llm.rows import drop_rows
from reviewflow.llm.tables import NO_ID, numbered, saved
from reviewflow.llm.text import WHITE_SPACE, text_column

# Splitters see this many leading bytes of a text (and a digest of all of it),
# so what sampling brings to the driver does not grow with the texts.
SPLITTER_BYTES = 48

_SORT = ["head", "digest", "norm", "shortness", "id", "row"]
_RUNS = "row long, doc_id long, text_sha256 string, keep_id long, points long, run_size long, part int, run long, lead boolean, edge boolean"
_RUN_SCHEMA = pa.schema([
    ("row", pa.int64()), ("doc_id", pa.int64()), ("text_sha256", pa.string()), ("keep_id", pa.int64()), ("points", pa.int64()),
    ("run_size", pa.int64()), ("part", pa.int32()), ("run", pa.int64()), ("lead", pa.bool_()), ("edge", pa.bool_())])


def _normalise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        column = text_column(batch)
        norms = [text.translate(None, WHITE_SPACE) for text in column.cast(pa.large_binary()).to_pylist()]
        ids = batch.column("doc_id")
        yield pa.RecordBatch.from_arrays([
            batch.column("row"),
            ids,
            pc.fill_null(ids, NO_ID),
            pa.array((norm[:SPLITTER_BYTES] for norm in norms), pa.binary()),
            pa.array(np.fromiter((xxhash.xxh3_64_intdigest(n) for n in norms), np.uint64, len(norms)).view(np.int64)),
            pa.array(norms, pa.binary()),
            pc.negate(pc.utf8_length(column).cast(pa.int64())),
        ], ["row", "doc_id", "id", "head", "digest", "norm", "shortness"])


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of equal neighbours in one sorted partition.

    Only the row numbers and ids of the run being read are held; a hot text is spread over
    many partitions, so these are bounded by a partition's share.
    """
    part, run = TaskContext.get().partitionId(), 0
    norm: bytes | None = None
    points, ids = 0, []
    rows: list[tuple] = []

    def close(last: bool) -> None:
        same = (hashlib.sha256(norm).hexdigest(), ids[0][1], points, len(ids), part, run)
        edge = last or run == 0
        rows.extend((*row_and_id, *same, place == 0, edge) for place, row_and_id in enumerate(ids))

    def flush() -> pa.RecordBatch:
        columns = [pa.array(values, field.type) for values, field in zip(zip(*rows), _RUN_SCHEMA)]
        rows.clear()
        return pa.RecordBatch.from_arrays(columns, schema=_RUN_SCHEMA)

    for batch in batches:
        if not batch.num_rows:
            continue
        column = batch.column("norm")
        equal = np.zeros(batch.num_rows, bool)
        equal[0] = norm is not None and column[0].as_py() == norm
        equal[1:] = pc.equal(column.slice(1), column.slice(0, batch.num_rows - 1)).to_numpy(zero_copy_only=False)
        doc_ids = list(zip(batch.column("row").to_pylist(), batch.column("doc_id").to_pylist()))
        lengths = batch.column("shortness").to_pylist()
        heads = np.flatnonzero(~equal).tolist()
        ids.extend(doc_ids[:heads[0] if heads else len(doc_ids)])
        for head, end in zip(heads, [*heads[1:], len(doc_ids)]):
            if norm is not None:
                close(False)
                run += 1
                if len(rows) >= 10_000:
                    yield flush()
            norm, ids, points = column[head].as_py(), doc_ids[head:end], -lengths[head]
    if norm is not None:
        close(True)
        yield flush()


def exact_groups(docs: DataFrame, row: str | None = None) -> DataFrame:
    """Groups of documents whose texts are identical but for white space.

    Takes doc_id and text, other columns are not looked at. The normalised
    bytes are dealt out by range with sampled splitters, sorted externally, and
    each text is compared in full with its neighbour. Splitters also hold
    length, id and row number, so a text that a third of all rows share is spread over
    many tasks; only the first and last run of a task can go on elsewhere, and
    those (two rows for each task) are put together by their SHA-256.

    Returns one row per row: doc_id, keep_id, group_size, kept, text_sha256.
    The row with the most code points stays, then the smallest id (a null id is
    the smallest); of repeated rows one. Null and white-space-only texts equal
    the empty text. No rows give no rows. ``row`` names a column of unique row
    numbers, which decides between rows with one id and is passed on as ``row``.
    """
    number = F.col(row) if row else F.lit(0).cast("long")
    norms = docs.select("doc_id", F.col("text"), number.alias("row")).mapInArrow(
        _normalise, "row long, doc_id long, id long, head binary, digest long, norm binary, shortness long")
    ranged = norms.repartitionByRange("head", "digest", "shortness", "id", "row").sortWithinPartitions(*_SORT)
    runs = saved(ranged.mapInArrow(_neighbours, _RUNS), "runs")
    best = F.struct((-F.col("points")).alias("shortness"), F.coalesce("keep_id", F.lit(NO_ID)).alias("id"), "row", "part")
    across = runs.where("edge AND lead").groupBy(F.col("text_sha256").alias("edge_sha256")).agg(
        F.min(best).alias("best"), F.min_by("keep_id", best).alias("first_id"), F.sum("run_size").alias("size"))
    rows = runs.join(F.broadcast(across), F.col("edge") & (F.col("text_sha256") == F.col("edge_sha256")), "left")
    stays = F.when(F.col("edge"), F.col("best.part") == F.col("part")).otherwise(True)
    return rows.select(
        "doc_id",
        F.when(F.col("edge"), F.col("first_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.when(F.col("edge"), F.col("size")).otherwise(F.col("run_size")).alias("group_size"),
        (F.col("lead") & stays).alias("kept"),
        "text_sha256", *(["row"] if row else []))


def drop_exact_copies(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each group of equal texts, all its columns; see ``exact_groups`` for which, and for odd rows."""
    docs, row = numbered(docs)
    return drop_rows(docs, row, exact_groups(docs, row).where("NOT kept").select("row"))
