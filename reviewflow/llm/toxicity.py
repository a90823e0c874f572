"""Toxicity: a linear classifier on character n-grams scaled by naive Bayes log-count ratios.

A text is looked at in overlapping windows, and its worst window decides, so a
few words in a long text count as much as in a short one. The classifier is
fitted on a bounded sample of the labelled training texts: the log-count ratios
by counting in Spark, the weights in numpy on one window of each text, the
window that scores highest under the ratios, then, in a second round, under the
weights fitted so far.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewflow.llm.lm import in_fold
from reviewflow.llm.tables import saved
from reviewflow.llm.text import chunks, layout, row_numbers, text_column

# Lengths of the n-grams, in UTF-8 bytes of the text in lower case, hashed to 2 ** BITS features.
LENGTHS = (3, 4, 5)
BITS = 18
WINDOW = 128
# Texts with an n-gram, below which it has no weight.
LEAST_TEXTS = 5
# The classifier is fitted on about this many labelled texts, chosen by a hash of the id.
SAMPLE_TEXTS = 20_000
ROUNDS = 2
EPOCHS = 8
RATE = 0.3
PENALTY = 1e-3
SEED = 11
FOLDS, HELD_OUT = 5, 0
CHUNK = 1 << 20


def grams(data: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Feature of the n-gram of each length that starts at each byte, -1 where the row ends before."""
    size = len(data)
    found = np.full((len(LENGTHS), size), -1, np.int32)
    room = np.repeat(places[1:], np.diff(places)) - np.arange(size)
    hashed = np.zeros(size, np.uint64)
    for k in range(max(LENGTHS)):
        if size <= k:
            break
        hashed = hashed[:size - k] * np.uint64(0x9E3779B97F4A7C15) + (data[k:].astype(np.uint64) + np.uint64(1))
        hashed ^= hashed >> np.uint64(29)
        if k + 1 in LENGTHS:
            feature = ((hashed * np.uint64(0xC4CEB9FE1A85EC53) + np.uint64(k)) >> np.uint64(64 - BITS)).astype(np.int32)
            found[LENGTHS.index(k + 1), :size - k] = np.where(room[:size - k] > k, feature, -1)
    return found


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    for batch in batches:
        column = pc.utf8_lower(text_column(batch))
        for start, end in chunks(column, CHUNK):
            yield (batch.slice(start, end - start), *layout(column.slice(start, end - start)))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts with each feature, by label, added up inside the task."""
    totals = np.zeros((2, 1 << BITS), np.int64)
    for part, data, places in _texts(batches):
        found, labels = grams(data, places), part.column("toxic").to_pylist()
        for start, end, label in zip(places[:-1].tolist(), places[1:].tolist(), labels):
            features = np.unique(found[:, start:end])
            totals[label, features[features >= 0]] += 1
    used = np.flatnonzero(totals.any(0))
    yield pa.RecordBatch.from_arrays(
        [pa.array(used.astype(np.int32)), pa.array(totals[0, used]), pa.array(totals[1, used])], ["feature", "clean", "toxic"])


def windows(places: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of the windows, which overlap by half, and the first window of each row; a row has one at least."""
    step = WINDOW // 2
    lengths = np.diff(places)
    counts = np.maximum(-(-(lengths - step) // step), 1)
    first = np.concatenate([[0], np.cumsum(counts)])
    rows = row_numbers(first)
    starts = places[rows] + (np.arange(first[-1]) - first[rows]) * step
    return starts, np.minimum(starts + WINDOW, places[rows + 1]), first[:-1]


def worst_windows(found: np.ndarray, places: np.ndarray, weights: np.ndarray) -> Iterator[np.ndarray]:
    """Of each row, the distinct features of the window with the highest sum of weights."""
    weights = np.append(weights, 0)
    value = weights[found].sum(0)
    upto = np.concatenate([[0.0], np.cumsum(value)])
    starts, ends, first = windows(places)
    score = upto[ends] - upto[starts]
    bounds = np.append(first, len(starts))
    for row in range(len(places) - 1):
        best = bounds[row] + int(score[bounds[row]:bounds[row + 1]].argmax())
        features = np.unique(found[:, starts[best]:ends[best]])
        yield features[features >= 0]


def _pick(weights: np.ndarray):
    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, places in _texts(batches):
            picked = list(worst_windows(grams(data, places), places, weights))
            bounds = np.concatenate([[0], np.cumsum([len(p) for p in picked])]).astype(np.int32)
            features = pa.ListArray.from_arrays(pa.array(bounds), pa.array(np.concatenate(picked).astype(np.int32)))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("toxic"), features], ["doc_id", "toxic", "features"])
    return pick


def fit(features: list[np.ndarray], labels: np.ndarray, ratios: np.ndarray) -> tuple[np.ndarray, float]:
    """Logistic regression with Adagrad; a feature's value is its ratio. Returns weight times ratio, and the bias."""
    random = np.random.default_rng(SEED)
    weights, squares = np.zeros(len(ratios)), np.full(len(ratios), 1e-2)
    bias, bias_square = 0.0, 1e-2
    order = np.arange(len(labels))
    for _ in range(EPOCHS):
        random.shuffle(order)
        for start in range(0, len(order), 32):
            picked = order[start:start + 32]
            flat = np.concatenate([features[k] for k in picked])
            rows = np.repeat(np.arange(len(picked)), [len(features[k]) for k in picked])
            guess = np.bincount(rows, weights[flat] * ratios[flat], len(picked)) + bias
            error = (1 / (1 + np.exp(-np.clip(guess, -30, 30))) - labels[picked]) / len(picked)
            used, where = np.unique(flat, return_inverse=True)
            step = np.bincount(where, error[rows] * ratios[flat], len(used)) + PENALTY * weights[used]
            squares[used] += step * step
            weights[used] -= RATE * step / np.sqrt(squares[used])
            bias_square += error.sum() ** 2
            bias -= RATE * error.sum() / np.sqrt(bias_square)
    return weights * ratios, float(bias)


def sample_labels(labels: DataFrame, texts: int = SAMPLE_TEXTS) -> DataFrame:
    """About ``texts`` of the labels (doc_id, toxic), or all if there are no more."""
    million = 1_000_000
    share = min(million, million * texts // max(labels.count(), 1))
    return labels.where(F.pmod(F.xxhash64(F.lit(SEED), "doc_id"), F.lit(million)) < share)


def train(examples: DataFrame) -> tuple[np.ndarray, float]:
    """Weights of all features and the bias, from rows (doc_id, text, toxic 0 or 1); zeros if a label is missing."""
    clean, toxic = examples.agg(F.count_if(F.col("toxic") == 0), F.count_if(F.col("toxic") == 1)).first()
    if not clean or not toxic:
        return np.zeros(1 << BITS), 0.0
    counts = examples.mapInArrow(_count, "feature int, clean long, toxic long").groupBy("feature").agg(
        F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")).toArrow()
    in_clean, in_toxic = np.zeros(1 << BITS), np.zeros(1 << BITS)
    place = counts.column("feature").to_numpy()
    in_clean[place], in_toxic[place] = counts.column("clean").to_numpy(), counts.column("toxic").to_numpy()
    ratios = np.log((in_toxic + 1) / (toxic + 2)) - np.log((in_clean + 1) / (clean + 2))
    ratios[in_clean + in_toxic < LEAST_TEXTS] = 0
    weights, bias = ratios, 0.0
    for _ in range(ROUNDS):
        # At most a window's features for each text of the bounded sample.
        picked = examples.mapInArrow(_pick(weights.astype(np.float32)), "doc_id long, toxic int, features array<int>").toArrow()
        order = np.argsort(picked.column("doc_id").to_numpy(zero_copy_only=False), kind="stable")
        labels = picked.column("toxic").to_numpy()[order]
        if labels.min(initial=1) == labels.max(initial=0):
            break
        features = picked.column("features").combine_chunks()
        flat, bounds = features.values.to_numpy(), features.offsets.to_numpy()
        weights, bias = fit([flat[bounds[k]:bounds[k + 1]] for k in order.tolist()], labels, ratios)
    return weights, bias


def _score(weights: np.ndarray, bias: float):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, places in _texts(batches):
            sums = np.array([weights[features].sum(dtype=np.float64) for features in worst_windows(grams(data, places), places, weights)])
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("held_out"), pa.array(1 / (1 + np.exp(-np.clip(sums + bias, -500, 500))))],
                ["doc_id", "held_out", "score"])
    return score


def score_toxicity(docs: DataFrame, labels: DataFrame, folds: int = FOLDS, held_out: int = HELD_OUT) -> DataFrame:
    """Toxicity of each text, learnt from the labels outside the held-out fold.

    Takes doc_id and text of ``docs``, doc_id and toxic (0 or 1) of ``labels``;
    only the text enters a score. Returns one row per row: doc_id, held_out,
    score (0 to 1), predicted (1 from a score of 0.5). A null text is empty and
    scored by the bias; labels that are null, have no document or a null id are
    not learnt from; of repeated labels the largest counts. Without labels of
    both kinds every score is 0.5. A null id is not held out.
    """
    docs = docs.select("doc_id", "text")
    known = labels.where("toxic IN (0, 1) AND doc_id IS NOT NULL").where(~in_fold(F.col("doc_id"), folds, held_out))
    known = known.groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    # The sample's labels are bounded by its size, 16 bytes each, so no text is shuffled to meet its label.
    examples = saved(docs.join(F.broadcast(sample_labels(known)), "doc_id"), "labelled")
    weights, bias = train(examples)
    scored = docs.withColumn("held_out", in_fold(F.col("doc_id"), folds, held_out)).mapInArrow(
        _score(weights.astype(np.float32), bias), "doc_id long, held_out boolean, score double")
    return scored.withColumn("predicted", F.when(F.col("score") >= 0.5, 1).otherwise(0))
