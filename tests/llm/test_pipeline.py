"""The pipeline against plain Python, from the documents to the token digests."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
import public_tokenizers
from reviewflow.llm import bpe, mixing
from tests.llm import brute


@pytest.fixture(scope="module")
def made(spark):
    """Result of each stage over the smallest table."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").cache()
    results = [docs]
    for _, stage in corpus_pipeline.STAGES:
        results.append(stage(spark, results[-1], "/root/testdata/sf0.001").cache())
    return results


def rows(frame):
    return [row.asDict() for row in frame.collect()]


def test_every_stage_but_the_last_keeps_the_columns(made):
    for frame in made[1:-1]:
        assert frame.columns == made[0].columns and frame.dtypes == made[0].dtypes


def test_quality(made):
    kept = {row["doc_id"] for row in rows(made[0]) if brute.quality(row["text"])["base_failed"] is False}
    assert {row["doc_id"] for row in rows(made[1])} <= kept
    # No line of the small table is common enough to be removed.
    assert {row["doc_id"] for row in rows(made[1])} == kept


def test_exact(made):
    docs = {row["doc_id"]: row["text"] for row in rows(made[1])}
    assert {row["doc_id"] for row in rows(made[2])} == set(brute.exact(docs).values())


def test_near(made):
    docs = {row["doc_id"]: row["text"] for row in rows(made[2])}
    assert {row["doc_id"] for row in rows(made[3])} == set(brute.components(docs).values())


def test_mixture(made):
    before, after = rows(made[3]), rows(made[4])
    size = {row["doc_id"]: len(brute.words(row["text"])) for row in before}
    times = Counter(row["doc_id"] for row in after)
    assert max(times.values()) <= mixing.MAX_REPEATS and set(times) <= set(size)
    by_source = defaultdict(int)
    for row in before:
        by_source[row["source"]] += size[row["doc_id"]]
    targets = brute.targets(by_source)
    taken = defaultdict(int)
    for row in after:
        taken[row["source"]] += size[row["doc_id"]]
    assert sum(taken.values()) <= sum(targets.values()) + 1e-6
    largest = max(size.values())
    for source, target in targets.items():
        assert abs(taken[source] - target) <= 2 * largest


def test_tokens(made):
    path = public_tokenizers.path(corpus_pipeline.VOCABULARY)
    encoding = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.load_ranks(path), special_tokens={})
    want = []
    for row in rows(made[4]):
        ids = encoding.encode_ordinary(row["text"])
        want.append((row["doc_id"], len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                     hashlib.sha256(row["text"].encode()).hexdigest()))
    got = [(r["doc_id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in rows(made[5])]
    assert sorted(got) == sorted(want)


def test_run_gives_what_the_stages_give(spark, made):
    got = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    order = [F.col(name) for name in got.columns]
    assert got.orderBy(*order).collect() == made[5].orderBy(*order).collect()
