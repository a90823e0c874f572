"""Runs against plain Python: all stretches and periods tried."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from reviewflow.llm import periodic
from reviewflow.llm.queries import periodic_digests
from tests.llm.brute import words


def runs_of(found, min_length, exponent):
    """(start, length, period) of all runs: for each period all maximal stretches, shorter periods first."""
    n, seen, runs = len(found), set(), []
    for q in range(1, n // exponent + 1):
        k = 0
        while k + q < n:
            if found[k] != found[k + q]:
                k += 1
                continue
            start = k
            while k + q < n and found[k] == found[k + q]:
                k += 1
            length = k + q - start
            if length >= max(min_length, exponent * q) and (start, length) not in seen:
                seen.add((start, length))
                runs.append((start, length, q))
    return sorted(runs, key=lambda r: (r[0], r[2]))


def planted(doc_id, text):
    found = words(text)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    n, g = len(found), h // 10
    if h % 10 or not n:
        return found
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else found[a + (i - a) % p] for i, w in enumerate(found)]


def digests(doc_id, text, change=planted):
    found = change(doc_id, text)
    runs = runs_of(found, 6, 4)
    gone = {k for s, n, q in runs for k in range(s + q, s + n)}
    best = None
    for run in runs:
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    sha = lambda text: hashlib.sha256(text.encode()).hexdigest()
    return (doc_id, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
            sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(" ".join(w for k, w in enumerate(found) if k not in gone)))


@pytest.mark.parametrize("letters, exponent, min_length", [(1, 4, 6), (2, 2, 2), (2, 4, 6), (3, 3, 1), (4, 2, 5)])
def test_small_alphabets(letters, exponent, min_length):
    rng = random.Random(letters * 10 + exponent)
    texts = [[rng.randrange(letters) for _ in range(rng.randint(0, 60))] for _ in range(300)]
    for _ in range(60):
        text = []
        while len(text) < 50:
            piece = [rng.randrange(letters) for _ in range(rng.randint(1, 6))]
            text += piece * rng.randint(1, 7) + piece[:rng.randint(0, len(piece))]
        texts.append(text)
    bounds = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    found = periodic.find_periods(np.array([c for t in texts for c in t], np.int64), bounds, min_length, exponent)
    want = [(row, *run) for row, text in enumerate(texts) for run in runs_of(text, min_length, exponent)]
    assert [tuple(run) for run in found.tolist()] == want


def awkward():
    rng = random.Random(3)
    vocabulary = ["a", "b", "c", "é", "日本", "x" * 50]
    rows = [(None, "a " * 9), (0, None), (1, ""), (2, " \t\n "), (3, "one"), (4, "a " * 6), (5, "a " * 5), (6, "a b " * 4 + "a"),
            (7, "a b\n" * 3), (8, "aa\x1cbb\x00 " * 12), (9, " ".join(str(k % 701) for k in range(9_000)))]
    rows += [(k, " ".join(rng.choice(vocabulary[:rng.randint(1, 6)]) for _ in range(rng.randint(1, 120)))) for k in range(10, 150)]
    rows += [(k, " ".join(str(rng.randrange(400)) for _ in range(rng.randint(1, 300)))) for k in range(150, 250)]
    return rows + rows[:20] + [rows[30]] * 5


def test_query_columns(spark):
    frame = spark.createDataFrame(awkward(), "doc_id long, text string").repartition(4).withColumns(
        {name: F.lit(1) for name in ("runs", "collapsed", "n_words", "start", "w", "word", "i")})
    found = [tuple(row) for row in periodic_digests(frame).select(
        "doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256").collect()]
    want = [digests(*row) for row in awkward()]
    assert sorted(found, key=repr) == sorted(want, key=repr)
    assert sum(row[1] > 0 for row in want) > 40


def test_operator_keeps_spans_and_texts(spark):
    rows = [(1, "start go go go go go go  end"), (2, "a b a b a b a b a c c c c c c"), (3, None)]
    found = {row["doc_id"]: row for row in periodic.find_runs(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found[1]["collapsed"] == "start go end" and [tuple(r) for r in found[1]["runs"]] == [(1, 6, 1)]
    assert found[2]["collapsed"] == "a b c" and [tuple(r) for r in found[2]["runs"]] == [(0, 9, 2), (9, 6, 1)]
    assert found[3]["collapsed"] == "" and found[3]["runs"] == [] and found[3]["n_words"] == 0


def test_one_word_many_times(spark):
    """A long text of one word has many tandems at its end, all of one run."""
    rows = [(1, "go " * 60_000), (2, "x " + "a b c " * 30_000)]
    found = {row["doc_id"]: row["runs"] for row in periodic.find_runs(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [tuple(r) for r in found[1]] == [(0, 60_000, 1)] and [tuple(r) for r in found[2]] == [(1, 90_000, 3)]


def test_empty_table(spark):
    assert periodic_digests(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    with pytest.raises(ValueError):
        periodic.find_runs(spark.createDataFrame([], "doc_id long, text string"), exponent=1)
