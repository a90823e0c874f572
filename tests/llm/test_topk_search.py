"""Largest inner products against all products in Python integers."""

import random
from math import floor, inf, isfinite, nan
from struct import pack, unpack

import numpy as np
import pytest
from pyspark.sql import functions as F

from reviewflow.llm import topk_search

SCHEMA = "vec_id long, embedding array<float>"


def brute(rows, k):
    """(query, rank, vec, score); rows are (id, vector) with place as tie breaker."""
    good = [(n, i, [floor(256 * x) for x in v]) for n, (i, v) in enumerate(rows)
            if v is not None and all(x is not None and isfinite(x) for x in v)]
    found = []
    for n, i, q in good:
        if i is None or i % 50:
            continue
        scored = sorted((-sum(a * b for a, b in zip(q, v)), i2 is not None, i2 or 0, n2) for n2, i2, v in good if n2 != n)
        found += [(i, rank, i2 if known else None, -s) for rank, (s, known, i2, _) in enumerate(scored[:k], 1)]
    return sorted(found, key=repr)


def search(spark, rows, k=5, parts=4):
    frame = spark.createDataFrame([(n, *row) for n, row in enumerate(rows)], "n long, " + SCHEMA)
    frame = frame.repartitionByRange(parts, "n").sortWithinPartitions("n").drop("n").withColumns(
        {name: F.lit(1) for name in ("id", "row", "norm", "asks", "vector", "part", "score", "rank")})
    found = topk_search.top_products(topk_search.quantized(frame), F.col("vec_id") % 50 == 0, k)
    assert found.columns == ["query_id", "rank", "vec_id", "score"]
    return sorted((tuple(row) for row in found.collect()), key=repr)


def vector(rng, width, length=1.0):
    raw = [rng.gauss(0, 1) for _ in range(width)]
    size = sum(x * x for x in raw) ** 0.5
    return [single(length * x / size) for x in raw]


def single(x):
    return unpack("f", pack("f", x))[0]


def test_unit_vectors_and_clusters(spark):
    rng = random.Random(1)
    centres = [vector(rng, 16) for _ in range(20)]
    rows = [(k, [single(c + rng.gauss(0, 0.1)) for c in rng.choice(centres)]) for k in range(1_500)]
    assert search(spark, rows) == brute(rows, 5)


def test_lengths_differ_widely(spark, monkeypatch):
    """Several buckets and cells, length and coordinate pruning at work."""
    for name, value in (("BUCKET", 64), ("BLOCK", 4), ("VECTOR_BYTES", 8_000), ("QUERY_BYTES", 300), ("SAMPLE", 100), ("DENSE", 1)):
        monkeypatch.setattr(topk_search, name, value)
    rng = random.Random(2)
    rows = [(k, vector(rng, 8, rng.expovariate(1) ** 3)) for k in range(2_000)]
    assert search(spark, rows, k=3) == brute(rows, 3)


def test_pruning_leaves_little(spark):
    """In a bucket of vectors of like length the prunings leave far fewer pairs than there are."""
    rng = np.random.default_rng(4)
    data = rng.normal(size=(1024, 8))
    data = (data / np.linalg.norm(data, axis=1)[:, None] * rng.uniform(900, 1000, 1024)[:, None]).astype(np.int32)
    data = data[np.argsort(-topk_search._lengths(data))]
    row = {"ids": np.arange(1024).tobytes(), "rows": np.arange(1024).tobytes(), "data": data.tobytes(), "n": 1024,
           "bound": float(topk_search._lengths(data).max())}
    queries = data[::64].copy()
    exact = queries.astype(np.int64) @ data.T.astype(np.int64)
    best = topk_search._Best(5, np.sort(exact, axis=1)[:, -6].astype(np.float64))
    tested = []
    pairs = topk_search._pairs
    topk_search._pairs = lambda left, right: tested.append(len(left)) or pairs(left, right)
    dense, topk_search.DENSE = topk_search.DENSE, 1
    try:
        topk_search._search_bucket(topk_search._Bucket(row, 8), queries, topk_search._lengths(queries), np.arange(0, 1024, 64), best)
    finally:
        topk_search._pairs, topk_search.DENSE = pairs, dense
    assert 0 < sum(tested) < 0.2 * exact.size


def test_awkward_rows(spark):
    rng = random.Random(3)
    rows = [(0, [1.0, 0.5]), (50, None), (100, [None, 1.0]), (150, [nan, 1.0]), (200, [inf, 0.0]), (250, []), (300, [0.0, 0.0]),
            (None, [0.25, 0.25]), (None, None), (7, [-0.001, 0.001]), (0, [1.0, 0.5]), (0, [1.0, 0.5]), (-50, [2.0]), (8, [1.0, 0.5, 3.0]),
            (350, [30_000.0, -30_000.0]), (9, [30_000.0, 1.0])]
    rows += [(400 + k, [0.5, 0.5]) for k in range(60)] + [(500 + k, [rng.choice([-1.0, 0.0, 1.0]) for _ in range(2)]) for k in range(60)]
    assert search(spark, rows) == brute(rows, 5)


def test_components_too_large_take_no_part(spark):
    found = search(spark, [(0, [1.0]), (1, [1e30]), (2, [-1.0])])
    assert found == [(0, 1, 2, -65536)]


@pytest.mark.parametrize("rows", [[], [(1, [1.0])], [(0, [1.0])], [(0, None)], [(50, [1.0]), (1, [2.0])]])
def test_few_rows(spark, rows):
    assert search(spark, rows, parts=1) == brute(rows, 5)


def test_one_vector_on_most_rows(spark):
    rows = [(k, [0.5, -0.25, 0.125] if k % 3 else [0.1 * (k % 7), 0.3, -0.2]) for k in range(3_000)]
    rows = [(i, [single(x) for x in v]) for i, v in rows]
    assert search(spark, rows) == brute(rows, 5)
