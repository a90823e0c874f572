"""Log-bilinear language model, trained in numpy with noise-contrastive estimation.

The model predicts the next token among the most frequent words, the end of a
text, and one class for all other words; inside that class words follow their
smoothed counts. The vector of the next token is a linear function of the two
tokens before it. Each task trains on its own texts from the same start, with
its own noise samples; the mean of their parameters, weighted by tokens, starts
the next round. Every training text is seen in one of the rounds.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewflow.llm.tables import saved
from reviewflow.llm.text import chunks, split_words, text_column, word_codes, word_hashes

# Words with an output vector of their own.
MODEL_WORDS = 1022
DIMENSIONS = 16
ROUNDS = 2
NOISE = 25
MINIBATCH = 2048
RATE = 0.1
SEED = 7
# Counts of this many words are sent to every task (4 MB); those of the others are joined.
SENT_WORDS = 1 << 18
# Distinct words a task holds before it passes their counts on.
HELD_WORDS = 400_000
# One of FOLDS parts of the texts is held out.
FOLDS, HELD_OUT = 7, 2

END, OTHER = 0, 1


def in_fold(column: Column, folds: int, fold: int) -> Column:
    """Whether crc32 of the id as text falls into this fold; a null id does not."""
    return F.coalesce(F.crc32(column.cast("string").cast("binary")) % folds == fold, F.lit(False))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word key, count) of the training texts, added up inside the task as far as it holds."""
    keys, counts, held = [], [], 0

    def added() -> tuple[np.ndarray, np.ndarray]:
        distinct, where = np.unique(np.concatenate(keys), return_inverse=True)
        return distinct, np.bincount(where, np.concatenate(counts)).astype(np.int64)

    for batch in batches:
        texts = text_column(batch).filter(pa.compute.invert(batch.column("held_out")))
        for start, end in chunks(texts):
            codes, distinct = word_codes(split_words(texts.slice(start, end - start), lower=True)[0])
            keys.append(word_hashes(distinct))
            counts.append(np.bincount(codes, minlength=len(distinct)))
            held += len(distinct)
            if held > 2 * HELD_WORDS:
                merged = added()
                keys, counts, held = [merged[0]], [merged[1]], len(merged[0])
                if held > HELD_WORDS:
                    yield pa.RecordBatch.from_arrays([pa.array(merged[0].view(np.int64)), pa.array(merged[1])], ["key", "n"])
                    keys, counts, held = [], [], 0
    if held:
        merged = added()
        yield pa.RecordBatch.from_arrays([pa.array(merged[0].view(np.int64)), pa.array(merged[1])], ["key", "n"])


class Vocabulary:
    """Counts of the most frequent words and their place in the model."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray, texts: int, tokens: int, distinct: int) -> None:
        order = np.argsort(keys)
        self.keys, self.counts = keys[order], counts[order]
        place = np.empty(len(keys), np.int64)
        place[order] = np.arange(len(keys))
        self.codes = np.full(len(keys), OTHER, np.int64)
        modelled = place[:MODEL_WORDS]
        self.codes[modelled] = np.arange(len(modelled)) + 2
        self.size = len(modelled) + 2
        self.texts, self.tokens, self.distinct = texts, tokens, distinct
        self.base_total = tokens + distinct + 1
        self.other_tokens = tokens - texts - int(counts[:MODEL_WORDS].sum())
        self.other_total = self.other_tokens + max(distinct - (texts > 0) - len(modelled), 0) + 1
        shares = np.ones(self.size)
        shares[END] += texts
        shares[OTHER] += self.other_tokens
        shares[2:] += counts[:MODEL_WORDS]
        self.shares = shares / shares.sum()

    def look_up(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Code and count of each word; the count is -1 where it was not sent."""
        if not len(self.keys):
            return np.full(len(keys), OTHER, np.int64), np.full(len(keys), -1, np.int64)
        place = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        hit = self.keys[place] == keys
        return np.where(hit, self.codes[place], OTHER), np.where(hit, self.counts[place], -1)


def start_model(vocabulary: Vocabulary) -> list[np.ndarray]:
    """Input vectors, output vectors, biases, and a matrix for each of the two places of the context."""
    random = np.random.default_rng(SEED)
    size = vocabulary.size
    return [
        random.normal(0, 0.1, (size, DIMENSIONS)), random.normal(0, 0.1, (size, DIMENSIONS)), np.log(vocabulary.shares),
        np.eye(DIMENSIONS), 0.5 * np.eye(DIMENSIONS)]


def flat(model: list[np.ndarray]) -> np.ndarray:
    return np.concatenate([part.ravel() for part in model])


def unflat(values: np.ndarray, size: int) -> list[np.ndarray]:
    shapes = [(size, DIMENSIONS), (size, DIMENSIONS), (size,), (DIMENSIONS, DIMENSIONS), (DIMENSIONS, DIMENSIONS)]
    parts = np.split(values, np.cumsum([int(np.prod(shape)) for shape in shapes])[:-1])
    return [part.reshape(shape) for part, shape in zip(parts, shapes)]


def sequences(texts: pa.Array, vocabulary: Vocabulary) -> tuple[np.ndarray, ...]:
    """Tokens of all rows, each row closed by END: code, both codes before, and the words they come from."""
    words, bounds = split_words(texts, lower=True)
    codes, distinct = word_codes(words)
    keys = word_hashes(distinct)
    model_codes, counts = vocabulary.look_up(keys)
    rows = len(texts)
    starts = bounds[:-1] + np.arange(rows)
    token = np.full(len(codes) + rows, END, np.int64)
    inside = np.ones(len(token), bool)
    inside[bounds[1:] + np.arange(rows)] = False
    if len(codes):
        token[inside] = model_codes[codes]
    before = np.concatenate([[END], token[:-1]])
    second = np.concatenate([[END], before[:-1]])
    second[starts] = END
    return token, before, second, starts, codes, bounds, keys, counts


def train_steps(model: list[np.ndarray], squares: list[np.ndarray], tokens: tuple[np.ndarray, ...], shares: np.ndarray,
                random: np.random.Generator) -> None:
    """Adagrad steps over the tokens in random order; the noise words of a step serve all its tokens."""
    token, before, second = tokens
    order = random.permutation(len(token))
    log_noise = np.log(NOISE * shares)
    reach = np.cumsum(shares)
    places = np.arange(DIMENSIONS)
    size = len(shares)

    def scatter(rows: np.ndarray, values: np.ndarray) -> np.ndarray:
        where = (rows[:, None] * DIMENSIONS + places).ravel()
        return np.bincount(where, values.ravel(), size * DIMENSIONS).reshape(size, DIMENSIONS)

    for start in range(0, len(order), MINIBATCH):
        picked = order[start:start + MINIBATCH]
        inputs, outputs, bias, first, other = model
        target, near, far = token[picked], before[picked], second[picked]
        noise = np.minimum(np.searchsorted(reach, random.random(NOISE)), size - 1)
        near_vectors, far_vectors = inputs[near], inputs[far]
        guess = near_vectors @ first + far_vectors @ other
        wanted = outputs[target]
        score = (guess * wanted).sum(1) + bias[target] - log_noise[target]
        noise_score = guess @ outputs[noise].T + bias[noise] - log_noise[noise]
        pull = 1 / (1 + np.exp(np.clip(score, -30, 30)))
        push = -1 / (1 + np.exp(-np.clip(noise_score, -30, 30)))
        guess_step = pull[:, None] * wanted + push @ outputs[noise]
        output_step = scatter(target, pull[:, None] * guess)
        np.add.at(output_step, noise, push.T @ guess)
        bias_step = np.bincount(target, pull, size) + np.bincount(noise, push.sum(0), size)
        input_step = scatter(near, guess_step @ first.T) + scatter(far, guess_step @ other.T)
        steps = [input_step, output_step, bias_step, near_vectors.T @ guess_step, far_vectors.T @ guess_step]
        for part, square, step in zip(model, squares, steps):
            step /= len(picked)
            square += step * step
            part += RATE * step / np.sqrt(square + 1e-8)


def _train(vocabulary: Vocabulary, values: np.ndarray):
    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        random = np.random.default_rng(SEED + TaskContext.get().partitionId())
        model = [part.copy() for part in unflat(values, vocabulary.size)]
        # Steps start small: a task with few texts stays near the common start.
        squares = [np.full_like(part, 1e-3) for part in model]
        weight = 0
        for batch in batches:
            texts = text_column(batch)
            for start, end in chunks(texts):
                token, before, second = sequences(texts.slice(start, end - start), vocabulary)[:3]
                train_steps(model, squares, (token, before, second), vocabulary.shares, random)
                weight += len(token)
        if weight:
            result = flat(model)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(len(result), dtype=np.int32)), pa.array(result * weight), pa.array(np.full(len(result), weight, np.int64))],
                ["place", "weighted", "weight"])
    return train


def log_probabilities(model: list[np.ndarray], token: np.ndarray, before: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Normalised log10 probability of each token; the sum over all outputs is made once for each distinct context."""
    inputs, outputs, bias, first, other = [part.astype(np.float32) for part in model]
    size = len(bias)
    context = before * size + second
    present = np.zeros(size * size, bool)
    present[context] = True
    distinct = np.flatnonzero(present)
    number = np.empty(size * size, np.int32)
    number[distinct] = np.arange(len(distinct))
    context = number[context]
    by_near, by_far = inputs @ first, inputs @ other
    guess = by_near[distinct // size] + by_far[distinct % size]
    total = np.empty(len(distinct), np.float32)
    for start in range(0, len(distinct), 4096):
        scores = guess[start:start + 4096] @ outputs.T + bias
        top = scores.max(1, keepdims=True)
        scores -= top
        np.exp(scores, out=scores)
        total[start:start + 4096] = np.log(scores.sum(1)) + top[:, 0]
    result = np.empty(len(token))
    for start in range(0, len(token), 1 << 17):
        part = slice(start, start + (1 << 17))
        result[part] = np.einsum("ij,ij->i", guess[context[part]], outputs[token[part]]) + bias[token[part]] - total[context[part]]
    return result / np.log(10)


def _score(vocabulary: Vocabulary, values: np.ndarray):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = unflat(values, vocabulary.size)
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            texts = text_column(batch)
            for start, end in chunks(texts):
                part, n = batch.slice(start, end - start), end - start
                token, before, second, starts, codes, bounds, keys, counts = sequences(texts.slice(start, n), vocabulary)
                model_sum = np.add.reduceat(log_probabilities(model, token, before, second), starts)
                rows = np.repeat(np.arange(n), np.diff(bounds))
                sent = counts >= 0
                logs = np.where(sent, np.log10(counts + 1.0, where=sent, out=np.zeros(len(counts))), 0.0)
                others = np.where(vocabulary.look_up(keys)[0] == OTHER, logs, 0.0)
                known = sent[codes] if len(codes) else np.zeros(0, bool)
                is_other = token == OTHER
                # Words whose count was not sent, as (key, times) of each row.
                at = np.flatnonzero(~known)
                pairs, times = np.unique((rows[at].astype(np.int64) << 32) | codes[at], return_counts=True)
                list_bounds = np.searchsorted(pairs >> 32, np.arange(n + 1)).astype(np.int32)
                rest = pa.ListArray.from_arrays(pa.array(list_bounds), pa.StructArray.from_arrays(
                    [pa.array(keys.view(np.int64)[pairs & 0xFFFFFFFF] if len(pairs) else np.zeros(0, np.int64)),
                     pa.array(times.astype(np.int64))], ["key", "times"]))
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.arange(row, row + n)), part.column("doc_id"), part.column("held_out"),
                    pa.array(np.diff(bounds) + 1), pa.array(np.bincount(rows, known, n).astype(np.int64)),
                    pa.array(np.bincount(rows, logs[codes] if len(codes) else None, n).astype(float)),
                    pa.array(np.bincount(rows, others[codes] if len(codes) else None, n).astype(float)),
                    pa.array(np.add.reduceat(is_other.astype(np.int64), starts)), pa.array(model_sum), rest],
                    ["row", "doc_id", "held_out", "n_tokens", "sent_known", "sent_logs", "other_logs", "n_other", "model_sum", "rest"])
                row += n
    return score


_SCORED = ("row long, doc_id long, held_out boolean, n_tokens long, sent_known long, sent_logs double, other_logs double, "
           "n_other long, model_sum double, rest array<struct<key:long,times:long>>")


def score_texts(docs: DataFrame, folds: int = FOLDS, held_out: int = HELD_OUT, rounds: int = ROUNDS) -> DataFrame:
    """log10 probability of each text under a count model and under the log-bilinear one.

    Takes doc_id and text; learns from the texts outside the held-out fold.
    Tokens are the words (A-Z in lower case) and one end. Returns one row per
    row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score (counts
    with one added), score. A null or empty text is its end only; a null id is
    not held out. Without training texts all counts are 0 and no token is known.
    """
    docs = docs.select("doc_id", "text", in_fold(F.col("doc_id"), folds, held_out).alias("held_out"))
    counts = saved(docs.select("text", "held_out").mapInArrow(_count, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")), "counts")
    texts = docs.where("NOT held_out").count()
    distinct, words = counts.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    top = counts.orderBy(F.desc("n"), "key").limit(SENT_WORDS).toArrow()
    vocabulary = Vocabulary(
        top.column("key").to_numpy().view(np.uint64), top.column("n").to_numpy(), texts, words + texts, distinct + (texts > 0))

    values = flat(start_model(vocabulary))
    for number in range(rounds):
        share = docs.where("NOT held_out").where(F.pmod(F.xxhash64(F.lit(SEED), "doc_id"), F.lit(rounds)) == number)
        trained = share.select("text").mapInArrow(_train(vocabulary, values), "place int, weighted double, weight long")
        # Bounded by the model: one value for each of its parameters.
        mean = trained.groupBy("place").agg((F.sum("weighted") / F.sum("weight")).alias("value")).orderBy("place").toArrow()
        if mean.num_rows:
            values = mean.column("value").to_numpy().copy()

    scored = saved(docs.mapInArrow(_score(vocabulary, values), _SCORED), "scored")
    rest = scored.select("row", F.explode("rest").alias("at")).select("row", "at.*").join(counts, "key").groupBy("row").agg(
        F.sum("times").alias("rest_known"), F.sum(F.col("times") * F.log10(F.col("n") + 1)).alias("rest_logs"))
    rest_known, rest_logs = F.coalesce("rest_known", F.lit(0)), F.coalesce("rest_logs", F.lit(0.0))
    end_log, base_log, other_log = (float(np.log10(v)) for v in (texts + 1, vocabulary.base_total, vocabulary.other_total))
    return scored.join(rest, "row", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("sent_known") + rest_known + (1 if texts else 0)).alias("n_known"),
        F.lit(vocabulary.tokens).cast("long").alias("train_tokens"),
        (F.col("sent_logs") + rest_logs + end_log - F.col("n_tokens") * base_log).alias("base_score"),
        (F.col("model_sum") + F.col("other_logs") + rest_logs - F.col("n_other") * other_log).alias("score"))
