"""Exact search for the largest inner products, by norm-bucketed retrieval.

Vectors are sorted by length and packed into buckets of vectors of like
length; queries are packed into blocks by the length a partner needs to reach
their threshold, the score of their k-th best vector so far. A first threshold
comes from a bounded sample. Then blocks meet buckets in cells of bounded
bytes; a cell is left out when its longest vector cannot reach any threshold
of the block.

In a cell, a query and a bucket give a local threshold: the cosine that the
bucket's longest vector would need. Over 1, the bucket is pruned. Otherwise
the query takes the cheaper of two prunings in this bucket: the vectors long
enough (length), or those whose focus coordinates lie in the ranges that the
local cosine allows (coordinate). What is left is verified by whole products,
pair by pair or, where much is left, as one matrix product. The thresholds
rise from bucket to bucket.

Bounds are rounded outwards, products are exact, so the result is exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewflow.llm.tables import NO_ID, numbered, saved

BUCKET = 1024
BLOCK = 128
# Bytes of the vectors and of the queries of a cell.
VECTOR_BYTES = 8 << 20
QUERY_BYTES = 2 << 20
# Vectors of the sample behind the first thresholds, broadcast: about so many, and no more than these bytes.
SAMPLE = 4096
SAMPLE_BYTES = 16 << 20
# Coordinates of a query that coordinate pruning looks at.
FOCUS = 4
# Pairs are verified by one matrix product when more than one in so many is left.
DENSE = 24
# Components beyond this are not searched: their products pass 64 bits.
LARGEST = (1 << 31) - 1
SLACK = 1e-9

_PACK = "pack long, part long, bound double, ids binary, rows binary, scores binary, data binary, n int"
_FOUND = "query_row long, query_id long, row long, id long, score long"


def quantized(embeddings: DataFrame, vector: str = "embedding", factor: int = 256) -> DataFrame:
    """``vector`` with each component x as floor(factor * x); null where the vector or a component is null or not finite."""
    x = F.col(vector)
    good = x.isNotNull() & F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < float("inf")))
    scaled = F.transform(x, lambda c: F.floor(F.greatest(F.least(factor * c.cast("double"), F.lit(2.0 ** 40)), F.lit(-2.0 ** 40))))
    return embeddings.withColumn(vector, F.when(good, scaled))


def _matrix(column: pa.Array) -> np.ndarray:
    """Rows of a list column as a matrix, short ones filled up with zeros."""
    lists = column.cast(pa.large_list(pa.int64()))
    places = lists.offsets.to_numpy()
    widths = np.diff(places)
    values = lists.values.to_numpy(zero_copy_only=False)
    matrix = np.zeros((len(lists), int(widths.max(initial=0))), np.int32)
    matrix[np.arange(matrix.shape[1]) < widths[:, None]] = values[places[0]:places[-1]]
    return matrix


def _wider(matrix: np.ndarray, width: int) -> np.ndarray:
    return np.pad(matrix, ((0, 0), (0, width - matrix.shape[1]))) if matrix.shape[1] < width else matrix


def _products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """All inner products, exact: in floating point while every sum stays below 2**53."""
    width = max(left.shape[1], right.shape[1], 1)
    left, right = _wider(left, width), _wider(right, width)
    largest = float(np.abs(left.astype(np.int64)).max(initial=0)) * float(np.abs(right.astype(np.int64)).max(initial=0)) * width
    if largest < 2.0 ** 53:
        return np.rint(left.astype(np.float64) @ right.T.astype(np.float64)).astype(np.int64)
    return left.astype(np.int64) @ right.T.astype(np.int64)


def _pairs(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Inner products row by row."""
    return np.einsum("ij,ij->i", left.astype(np.int64), right.astype(np.int64))


def _lengths(matrix: np.ndarray) -> np.ndarray:
    return np.sqrt(np.square(matrix.astype(np.float64)).sum(1))


class _Best:
    """The k best vectors of each query so far."""

    def __init__(self, k: int, thresholds: np.ndarray) -> None:
        self.k, self.thresholds = k, thresholds.copy()
        self.query = np.zeros(0, np.int64)
        self.found = np.zeros((3, 0), np.int64)

    def add(self, query: np.ndarray, scores: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> None:
        query = np.concatenate([self.query, query])
        found = np.concatenate([self.found, np.stack([scores, ids, rows])], axis=1)
        order = np.lexsort((found[2], found[1], -found[0], query))
        query, found = query[order], found[:, order]
        opening = np.concatenate([[True], query[1:] != query[:-1]]) if len(query) else np.zeros(0, bool)
        heads = np.flatnonzero(opening)
        place = np.arange(len(query)) - heads[np.cumsum(opening) - 1] if len(query) else np.zeros(0, np.int64)
        last = place == self.k - 1
        self.thresholds[query[last]] = np.maximum(self.thresholds[query[last]], found[0][last])
        self.query, self.found = query[place < self.k], found[:, place < self.k]


def _pack(size: int, limit: int, bound: str):
    """Rows in order, as packs of ``size`` vectors; packs of ``limit`` bytes share a part."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, number, written, part = TaskContext.get().partitionId() << 32, 0, 0, 0
        held: list[pa.RecordBatch] = []

        def emit(rows: pa.Table) -> pa.RecordBatch:
            nonlocal number, written, part
            data = _matrix(rows.column("vector").combine_chunks())
            bounds = rows.column(bound).to_numpy()
            limit_of = bounds.max() if bound == "norm" else bounds.min()
            if written and written + data.nbytes > limit:
                part, written = part + 1, 0
            written += data.nbytes
            number += 1
            scores = rows.column("threshold").to_numpy() if "threshold" in rows.column_names else bounds
            columns = [rows.column(name).fill_null(NO_ID).to_numpy() for name in ("id", "row")]
            return pa.RecordBatch.from_arrays(
                [pa.array([first + number]), pa.array([first + part]), pa.array([float(limit_of)]),
                 *(pa.array([np.ascontiguousarray(values).tobytes()], pa.binary()) for values in (*columns, scores, data)),
                 pa.array([len(data)], pa.int32())], ["pack", "part", "bound", "ids", "rows", "scores", "data", "n"])

        count = 0
        for batch in batches:
            held.append(batch)
            count += len(batch)
            while count >= size:
                rows = pa.Table.from_batches(held)
                yield emit(rows.slice(0, size))
                held, count = rows.slice(size).to_batches(), count - size
        if count:
            yield emit(pa.Table.from_batches(held))
    return pack


def _first_thresholds(k: int, sample):
    """The score of the k-th best vector of the sample, and the length that reaches it."""
    def thresholds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, data = sample.value
        for batch in batches:
            if not len(batch):
                continue
            vectors = _matrix(batch.column("vector"))
            scores = _products(vectors, data).astype(np.float64)
            scores[batch.column("row").to_numpy()[:, None] == rows] = -np.inf
            best = np.partition(scores, -k, axis=1)[:, -k] if len(rows) >= k else np.full(len(vectors), -np.inf)
            yield pa.RecordBatch.from_arrays([
                *batch.columns, pa.array(best), pa.array(_needed_length(best, _lengths(vectors)))],
                [*batch.schema.names, "threshold", "need"])
    return thresholds


def _needed_length(thresholds: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Shorter vectors cannot reach the threshold; 0 where any can."""
    bounded = (thresholds > 0) & (lengths > 0)
    return np.where(bounded, thresholds / np.where(bounded, lengths, 1), 0.0) * (1 - SLACK)


class _Bucket:
    """Vectors of like length, longest first, with their directions sorted along each coordinate."""

    def __init__(self, row: dict, width: int) -> None:
        self.ids, self.rows = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["rows"], np.int64)
        self.data = _wider(np.frombuffer(row["data"], np.int32).reshape(row["n"], -1), width)
        self.lengths, self.longest = _lengths(self.data), row["bound"]
        self._sorted: tuple[np.ndarray, ...] | None = None

    @property
    def sorted(self) -> tuple[np.ndarray, ...]:
        if self._sorted is None:
            directions = self.data / np.maximum(self.lengths, 1e-300)[:, None]
            order = np.argsort(directions, axis=0, kind="stable")
            values = np.take_along_axis(directions, order, 0)
            # One sorted list: coordinate f lies between 4 f - 1 and 4 f + 1.
            self._sorted = directions, (values + 4.0 * np.arange(values.shape[1])).T.ravel(), order.T.ravel()
        return self._sorted


def _coordinate_ranges(queries: np.ndarray, lengths: np.ndarray, cosine: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Focus coordinates of each query, and the values there that vectors with this cosine or more can have."""
    directions = queries / lengths[:, None]
    focus = np.argsort(-np.abs(directions), axis=1, kind="stable")[:, :FOCUS]
    angle = np.arccos(np.clip(np.take_along_axis(directions, focus, 1), -1, 1))
    reach = np.arccos(np.clip(cosine, -1, 1))[:, None]
    low, high = np.cos(np.minimum(angle + reach, np.pi)), np.cos(np.maximum(angle - reach, 0))
    return focus, low - 1e-6, high + 1e-6


def _search_bucket(bucket: _Bucket, queries: np.ndarray, lengths: np.ndarray, rows: np.ndarray, best: _Best) -> None:
    need = _needed_length(best.thresholds, lengths)
    alive = np.flatnonzero(need <= bucket.longest)
    if not len(alive):
        return
    # Length pruning: the vectors long enough, which come first.
    by_length = len(bucket.lengths) - np.searchsorted(bucket.lengths[::-1], need[alive], "left")
    # Coordinate pruning where the local cosine threshold says anything.
    bounded = (need[alive] > 0) & (bucket.longest > 0)
    taken, begin = by_length.copy(), np.full(len(alive), -1)
    chosen = alive[bounded]
    if len(chosen) and queries.shape[1]:
        directions, values, order = bucket.sorted
        focus, low, high = _coordinate_ranges(queries[chosen], lengths[chosen], need[chosen] / bucket.longest)
        left = np.searchsorted(values, 4.0 * focus + np.maximum(low, -1.5), "left")
        right = np.searchsorted(values, 4.0 * focus + np.minimum(high, 1.5), "right")
        nearest = np.argmin(right - left, axis=1)
        at = np.arange(len(chosen))
        left, right = left[at, nearest], right[at, nearest]
        place = np.flatnonzero(bounded)
        cheaper = right - left < by_length[place]
        begin[place[cheaper]] = left[cheaper]
        taken[place[cheaper]] = (right - left)[cheaper]
    if taken.sum() * DENSE > len(alive) * len(bucket.rows):
        scores = _products(queries[alive], bucket.data)
        who, which = np.nonzero(scores >= best.thresholds[alive][:, None])
        who, scores = alive[who], scores[who, which]
    else:
        who = np.repeat(np.arange(len(alive)), taken)
        which = np.arange(len(who)) - np.repeat(np.cumsum(taken) - taken, taken)
        by_coordinate = begin[who] >= 0
        if by_coordinate.any():
            which[by_coordinate] = order[(begin[who] + which)[by_coordinate]]
            # The other focus coordinates must fit too.
            number = np.full(len(alive), -1)
            number[place] = np.arange(len(place))
            fits = np.ones(len(who), bool)
            for k in range(focus.shape[1]):
                mine = number[who[by_coordinate]]
                value = directions[which[by_coordinate], focus[mine, k]]
                fits[by_coordinate] &= (value >= low[mine, k]) & (value <= high[mine, k])
            who, which = who[fits], which[fits]
        who = alive[who]
        scores = _pairs(queries[who], bucket.data[which])
        good = scores >= best.thresholds[who]
        who, which, scores = who[good], which[good], scores[good]
    other = bucket.rows[which] != rows[who]
    best.add(who[other], scores[other], bucket.ids[which[other]], bucket.rows[which[other]])


def _search_cell(k: int):
    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        found = [np.zeros((5, 0), np.int64)]
        buckets, blocks = left.sort_by("pack").to_pylist(), right.sort_by("pack").to_pylist()
        width = max((len(row["data"]) // (4 * row["n"]) for row in buckets + blocks), default=0)
        buckets = [_Bucket(row, width) for row in buckets]
        for block in blocks:
            ids, rows = np.frombuffer(block["ids"], np.int64), np.frombuffer(block["rows"], np.int64)
            queries = _wider(np.frombuffer(block["data"], np.int32).reshape(block["n"], -1), width)
            best, lengths = _Best(k, np.frombuffer(block["scores"], np.float64)), _lengths(queries)
            for bucket in buckets:
                _search_bucket(bucket, queries, lengths, rows, best)
            score, vec, row = best.found
            found.append(np.stack([rows[best.query], ids[best.query], row, vec, score]))
        return pa.table(list(np.concatenate(found, axis=1)), names=["query_row", "query_id", "row", "id", "score"])
    return search


def top_products(vectors: DataFrame, is_query: Column, k: int, id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """The ``k`` largest inner products of each query with all other rows.

    Takes a number ``id`` and integer vectors (array) in ``vector``; the rows
    where ``is_query`` holds are the queries. Other columns play no part. Null
    vectors, those with a null component and those with one beyond 2**31 - 1
    take no part; where lengths differ, missing components count as 0. A
    query's own row is no candidate; other rows with its id are. Scores are
    64-bit integers.

    Returns query_id, rank (from 1), id (as ``vec_id``), score for each query
    row: highest score first, ties to the smaller id, then the earlier row; all
    other rows if there are fewer than ``k``. A null id counts as the smallest
    and comes back null. No queries or no vectors give no rows.
    """
    spark = vectors.sparkSession
    good = F.forall(F.col("vector"), lambda c: c.isNotNull() & (F.abs(c) <= LARGEST))
    length = "sqrt(aggregate(vector, 0D, (total, c) -> total + cast(c AS double) * cast(c AS double)))"
    rows, row = numbered(vectors.select(
        F.col(id).cast("long").alias("id"), F.col(vector).alias("vector"), F.coalesce(is_query, F.lit(False)).alias("asks")))
    rows = saved(rows.withColumnRenamed(row, "row").where(F.col("vector").isNotNull()).where(good).withColumn("norm", F.expr(length)), "vectors")

    total, widest = rows.agg(F.count("*"), F.max(F.size("vector"))).first()
    wanted = min(SAMPLE, SAMPLE_BYTES // (4 * max(widest or 1, 1)))
    one_in = max(-(-total // max(wanted, 1)), 1)
    sampled = rows.where(F.pmod(F.xxhash64("row"), F.lit(one_in)) == 0).select("row", "vector").toArrow().combine_chunks()
    sample = spark.sparkContext.broadcast((
        sampled.column("row").to_numpy(), _matrix(sampled.column("vector").combine_chunks()) if len(sampled) else np.zeros((0, 0), np.int32)))
    asked = rows.where("asks").select("id", "row", "vector").mapInArrow(
        _first_thresholds(k, sample), "id long, row long, vector array<bigint>, threshold double, need double")

    buckets = saved(
        rows.select("id", "row", "vector", "norm").repartitionByRange(F.desc("norm"), "row").sortWithinPartitions(F.desc("norm"), "row")
        .mapInArrow(_pack(BUCKET, VECTOR_BYTES, "norm"), _PACK), "buckets")
    blocks = saved(
        asked.repartitionByRange("need", "row").sortWithinPartitions("need", "row")
        .mapInArrow(_pack(BLOCK, QUERY_BYTES, "need"), _PACK), "blocks")

    # Which parts of the queries meet which parts of the vectors: one row for some megabytes on either side.
    longest = buckets.groupBy("part").agg(F.max("bound").alias("longest"))
    needed = blocks.groupBy(F.col("part").alias("asking")).agg(F.min("bound").alias("needed"))
    cells = saved(needed.join(longest, F.col("needed") <= F.col("longest")).select("asking", "part"), "cells")
    left = buckets.join(cells, "part")
    right = blocks.withColumnRenamed("part", "asking").join(cells, "asking")
    found = left.groupBy("asking", "part").cogroup(right.groupBy("asking", "part")).applyInArrow(_search_cell(k), _FOUND)

    place = Window.partitionBy("query_row").orderBy(F.desc("score"), "id", "row")
    known = [F.when(F.col(name) != NO_ID, F.col(name)) for name in ("query_id", "id")]
    return found.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= k).select(
        known[0].alias("query_id"), "rank", known[1].alias("vec_id"), "score")
