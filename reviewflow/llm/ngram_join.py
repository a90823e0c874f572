"""Jaccard join of documents on word n-grams, with token-combination prefixes.

Tokens are the distinct n-word shingles of a document, as 64-bit hashes. All
documents order them alike, rare ones first. A pair with the wanted similarity
differs in few tokens, so it suffices to index a prefix of each document:

* tokens of the first class (rare and middling ones) are indexed singly;
* very frequent tokens are dealt into groups, and inside a group each
  combination of two is indexed. The prefix is extended until losing every
  token in which a partner may differ still leaves some keys, and a few more
  the longer the document.

Documents that share as many keys as similar ones must are candidates, so one
common line or passage does not make them. They are verified on the whole token
sets, first each document of a key against one of the key, the hub, then, after the
links found have been joined to components, those that are in different ones.
So a group of n near copies costs about n checks, and no link that could join
two components is left out.

In a key of few components all of them meet. In a crowded key, as a text with
many edits in its copies makes, they would be far too many: there each document
a is taken as its difference A from the hub, the tokens that one of both lacks.
Two documents differ as their differences do, so similar ones that are not both
similar to the hub share most of A and B, and must share one of the rarest
tokens of them. Edits made apart from each other hardly share any. Those of the
hub itself are in all differences, so the hub is the document nearest to what
most have in common, and tokens of many differences come last.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reviewflow.llm.graph import components
from reviewflow.llm.rows import drop_rows
from reviewflow.llm.tables import NO_ID, numbered, saved
from reviewflow.llm.text import chunks, mix, split_words, text_column, word_codes, word_hashes
from reviewflow.llm.urls import bloom_filter, bloom_passes

NGRAM = 5
PERCENT = 80
# Token frequencies are counted in one of this many documents; they only set
# the order of the tokens, never what is found.
SAMPLE_ONE_IN = 16
FREQUENT_IN_SAMPLE = 3
COMBINED_IN_SAMPLE = 160
# Frequencies are kept for so many tokens at most, 4 MB: this is broadcast.
FREQUENT_TOKENS = 1 << 18
# Prefixes are extended so that similar documents share a key more for each so many tokens of the smaller.
TOKENS_PER_KEY = 20
# Buckets of the bitmaps that sieve candidates before whole sets are compared.
BITMAP = 1024
# Keys with more components than this are joined by differences from their hub; the others by all pairs.
CROWD = 64
# What most documents of a crowd have in common is told from so many of them.
MIDDLE_SAMPLE = 64
# Parts in which the documents of a crowd meet the tokens of one.
PARTS = 16
# Documents seen in a task, so that copies give their keys once.
SEEN = 1 << 18

_STEP = np.uint64(0x9E3779B97F4A7C15)


def shingles(column: pa.Array, n: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each row; rows of 1 to n - 1 words have one, of all words."""
    words, bounds = split_words(column, lower=True)
    codes, distinct = word_codes(words)
    hashes = word_hashes(distinct)[codes] if len(codes) else np.zeros(0, np.uint64)
    width = len(hashes) - n + 1
    rolled = hashes[:max(width, 0)].copy()
    for k in range(1, n):
        rolled = mix(rolled * _STEP + hashes[k:k + len(rolled)])
    for start, end in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        if end - start >= n:
            yield np.unique(rolled[start:end - n + 1])
        elif end > start:
            whole = hashes[start:start + 1]
            for place in range(start + 1, end):
                whole = mix(whole * _STEP + hashes[place:place + 1])
            yield mix(whole + np.uint64(end - start))
        else:
            yield np.zeros(0, np.uint64)


def _node(tokens: np.ndarray) -> tuple[int, int]:
    """Key of a token set, and a second one that shows when two sets share a key."""
    digest = xxhash.xxh3_128_intdigest(tokens.tobytes())
    return (digest & (1 << 63) - 1), (digest >> 64) - (1 << 63)


def _rows(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[tuple[pa.Array, int, np.ndarray]]:
    for batch in batches:
        column = text_column(batch)
        ids = batch.column("id")
        for start, end in chunks(column):
            for place, tokens in enumerate(shingles(column.slice(start, end - start), n), start):
                yield ids, place, tokens


def _lists(values: list[np.ndarray]) -> pa.Array:
    bounds = np.concatenate([[0], np.cumsum([len(v) for v in values])]).astype(np.int32)
    flat = np.concatenate(values) if values else np.zeros(0, np.uint64)
    return pa.ListArray.from_arrays(pa.array(bounds), pa.array(flat.view(np.int64)))


def _measure(n: int):
    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        none = np.zeros(0, np.uint64)
        for batch in batches:
            nodes, checks, sizes, samples = [], [], [], []
            for _, _, tokens in _rows(iter([batch]), n):
                node, check = _node(tokens)
                sampled = node % SAMPLE_ONE_IN == 0 and node not in seen
                if sampled:
                    seen = seen if len(seen) < SEEN else set()
                    seen.add(node)
                nodes.append(node)
                checks.append(check)
                sizes.append(len(tokens))
                samples.append(tokens if sampled else none)
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("doc_id"), batch.column("id"), pa.array(sizes, pa.int64()), pa.array(nodes, pa.int64()),
                 pa.array(checks, pa.int64()), _lists(samples)],
                ["row", "doc_id", "id", "n_shingles", "node", "second", "sample"])
    return measure


def _groups(size: int) -> list[int]:
    """Into how many groups frequent tokens are dealt: by the size of the document and of its larger partners."""
    def groups(value: int) -> int:
        band, least = 0, 64
        while value >= least:
            band, least = band + 1, least * 4
        return 1 if not band else 2 * 4 ** band
    return sorted({groups(size), groups(size * 100 // PERCENT)})


def _rate(part: np.ndarray, frequent: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """How often tokens were seen in the sample, 0 if not frequent; ``frequent`` is sorted."""
    if not len(frequent):
        return np.zeros(len(part), np.int64)
    place = np.minimum(np.searchsorted(frequent, part), len(frequent) - 1)
    return np.where(frequent[place] == part, counts[place], 0)


def prefix_keys(tokens: np.ndarray, frequent: np.ndarray, counts: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """The index keys of one document; ``frequent`` is sorted."""
    size = len(tokens)
    need = size - (percent * size + 99) // 100 + 1 + size // TOKENS_PER_KEY

    first = tokens[:need + need // 2 + 8]
    rare = first[_rate(first, frequent, counts) == 0]
    if len(rare) >= need:
        return rare[:need]
    count = _rate(tokens, frequent, counts)
    order = np.argsort(count, kind="stable")
    ordered, count = tokens[order], count[order]
    single = int(np.searchsorted(count, COMBINED_IN_SAMPLE))
    if single >= need:
        return ordered[:need]
    keys, combined = [ordered[:single]], ordered[single:]
    for groups in _groups(size):
        group = (mix(combined) % np.uint64(groups)).astype(np.int64)
        _, head = np.unique(group, return_index=True)
        gain = np.ones(len(combined), np.int64)
        gain[head] = 0
        used = min(int(np.searchsorted(np.cumsum(gain), need - single)) + 1, len(combined))
        salt = mix(np.array([groups], np.uint64))
        for number in np.unique(group[:used]):
            members = combined[:used][group[:used] == number]
            left, right = np.triu_indices(len(members), 1)
            keys.append(mix(members[left] * _STEP + members[right]) ^ salt)
    return np.concatenate(keys)


def _index(n: int, percent: int, frequent: np.ndarray, counts: np.ndarray):
    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        keys, nodes, sizes, held = [], [], [], 0

        def flush() -> pa.RecordBatch:
            lengths = [len(k) for k in keys]
            batch = pa.RecordBatch.from_arrays([
                pa.array(np.concatenate(keys).view(np.int64)), pa.array(np.repeat(np.array(nodes, np.int64), lengths)),
                pa.array(np.repeat(np.array(sizes, np.int32), lengths))], ["key", "node", "size"])
            for held_list in (keys, nodes, sizes):
                held_list.clear()
            return batch

        for _, _, tokens in _rows(batches, n):
            if not len(tokens):
                continue
            node = _node(tokens)[0]
            if node in seen:
                continue
            seen = seen if len(seen) < SEEN else set()
            seen.add(node)
            found = prefix_keys(tokens, frequent, counts, percent)
            if not len(found):
                continue
            keys.append(found)
            nodes.append(node)
            sizes.append(len(tokens))
            held += len(found)
            if held >= 200_000:
                yield flush()
                held = 0
        if keys:
            yield flush()
    return index


def _token_sets(n: int):
    def token_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            found = {node: tokens for _, _, tokens in _rows(iter([batch]), n) if (node := _node(tokens)[0]) not in seen}
            seen = (seen if len(seen) < SEEN else set()) | found.keys()
            yield pa.RecordBatch.from_arrays([
                pa.array(found.keys(), pa.int64()), pa.array([tokens.tobytes() for tokens in found.values()], pa.binary()),
                pa.array([_bitmap(tokens) for tokens in found.values()], pa.binary()),
                pa.array([len(tokens) for tokens in found.values()], pa.int32())], ["node", "tokens", "bits", "size"])
    return token_sets


def _bitmap(tokens: np.ndarray) -> bytes:
    """Which buckets have a token."""
    used = np.zeros(BITMAP, bool)
    used[(mix(tokens) % np.uint64(BITMAP)).astype(np.int64)] = True
    return np.packbits(used).tobytes()


_ONES = np.array([bin(value).count("1") for value in range(256)], np.uint8)


def _sieve(percent: int):
    """Drop pairs that cannot be similar: a bucket that only one side uses holds a token the other lacks."""
    def sieve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            left, right = (np.frombuffer(b"".join(batch.column(name).to_pylist()), np.uint8).reshape(batch.num_rows, -1)
                           for name in ("left_bits", "right_bits"))
            sizes = [batch.column(name).to_numpy().astype(np.int64) for name in ("left_size", "right_size")]
            lacking = [_ONES[mine & ~other].sum(1, dtype=np.int64) for mine, other in ((left, right), (right, left))]
            common = np.minimum(sizes[0] - lacking[0], sizes[1] - lacking[1])
            good = 100 * common >= percent * (sizes[0] + sizes[1] - common)
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(good))
    return sieve


def _verify(percent: int):
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = np.zeros(batch.num_rows, bool)
            for place, (left, right) in enumerate(zip(batch.column("left_tokens").to_pylist(), batch.column("right_tokens").to_pylist())):
                left, right = np.frombuffer(left, np.uint64), np.frombuffer(right, np.uint64)
                common = len(np.intersect1d(left, right, assume_unique=True))
                good[place] = 100 * common >= percent * (len(left) + len(right) - common)
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(good))
    return verify


def _most_apart(size, percent: int):
    """In how many tokens a similar partner of any size can differ."""
    return (size + size * 100 // percent) * (100 - percent) // (100 + percent)


def _apart(batch: pa.RecordBatch) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Hub, size, sorted tokens that either a document or its hub lacks, and the hub's, of each row."""
    for hub, size, mine, other in zip(*(batch.column(name).to_pylist() for name in ("hub", "size", "tokens", "hub_tokens"))):
        mine, other = np.frombuffer(mine, np.uint64), np.frombuffer(other, np.uint64)
        yield hub, size, np.setxor1d(mine, other, assume_unique=True), other


def _in_crowd(hub: int, tokens: np.ndarray) -> np.ndarray:
    """Keys of tokens among the differences from one hub."""
    return mix(tokens * _STEP + np.uint64(hub))


def _differences(percent: int, frequent: np.ndarray, counts: np.ndarray):
    """The first tokens of those that either a document or its hub lacks, a row for each.

    All documents of a hub order them alike: those of the fewest differences
    come first, of them those that the hub lacks.
    """
    def differences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tokens, widths = [np.zeros(0, np.uint64)], []
            for hub, size, apart, other in _apart(batch):
                order = np.lexsort((apart, np.isin(apart, other, assume_unique=True), _rate(_in_crowd(hub, apart), frequent, counts)))
                tokens.append(apart[order[:_most_apart(size, percent) + 1]])
                widths.append((len(apart), len(tokens[-1])))
            width, early = np.array(widths, np.int64).reshape(-1, 2).T
            which = np.repeat(np.arange(len(early)), early)
            place = np.arange(len(which)) - np.repeat(np.cumsum(early) - early, early)
            tokens = np.concatenate(tokens).view(np.int64)
            for at in range(0, len(tokens), 1 << 17):
                rows = which[at:at + (1 << 17)]
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(name).take(pa.array(rows)) for name in ("hub", "node", "component", "size")),
                     pa.array(width[rows]), pa.array(place[at:at + (1 << 17)]), pa.array(tokens[at:at + (1 << 17)])],
                    ["hub", "node", "component", "size", "width", "place", "token"])
    return differences


def _count_differences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys = [np.zeros(0, np.uint64), *(_in_crowd(hub, apart) for hub, _, apart, _ in _apart(batch))]
        key, n = np.unique(np.concatenate(keys), return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(n.astype(np.int64))], ["key", "n"])


def _widths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        width = [len(apart) for _, _, apart, _ in _apart(batch)]
        yield pa.RecordBatch.from_arrays([batch.column("hub"), batch.column("node"), pa.array(width, pa.int64())], ["hub", "node", "width"])


def _middle(sample: pa.Table) -> pa.Table:
    """The tokens that more than half of the documents have."""
    sets = [np.frombuffer(tokens, np.uint64) for tokens in sample.column("tokens").to_pylist()]
    token, n = np.unique(np.concatenate(sets), return_counts=True)
    return pa.table({"hub": sample.column("hub").slice(0, 1), "hub_tokens": pa.array([token[2 * n > len(sets)].tobytes()], pa.binary())})


def _one_of_each(sets: DataFrame) -> DataFrame:
    return sets.select("node", "tokens", "size").dropDuplicates(["node"])


def _beside(members: DataFrame, sets: DataFrame, hubs: DataFrame) -> DataFrame:
    """The members with their tokens and those of their hub, of ``hubs`` (hub, hub_tokens)."""
    part = F.pmod(F.xxhash64("node"), F.lit(PARTS)).cast("int").alias("part")
    parts = hubs.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))))
    return members.join(_one_of_each(sets), "node").select("*", part).join(parts, ["hub", "part"])


def _hub_tokens(sets: DataFrame, members: DataFrame) -> DataFrame:
    return _one_of_each(sets).select(F.col("node").alias("hub"), F.col("tokens").alias("hub_tokens")).join(
        members.select("hub").distinct(), "hub")


def centred(members: DataFrame, sets: DataFrame, label: str) -> DataFrame:
    """The ``members`` (hub, node, component) with the most central one of each crowd as its hub, which is left out.

    That is the one nearest to the tokens that most of a sample have. Crowds
    that get the same hub become one.
    """
    bucket = F.pmod(F.xxhash64("node"), F.lit(MIDDLE_SAMPLE)).alias("bucket")
    sample = members.groupBy("hub", bucket).agg(F.min("node").alias("node"))
    middle = sample.join(_one_of_each(sets), "node").select("hub", "tokens").groupBy("hub").applyInArrow(
        _middle, "hub long, hub_tokens binary")
    nearest = _beside(members, sets, middle).mapInArrow(_widths, "hub long, node long, width long").groupBy("hub").agg(
        F.min(F.struct("width", "node")).getField("node").alias("centre"))
    moved = members.join(nearest, "hub").select(F.col("centre").alias("hub"), "node", "component")
    return saved(moved.where("node <> hub").distinct(), f"{label}-centred")


def difference_counts(members: DataFrame, sets: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The tokens in most differences from a hub, as sorted keys, and in how many they are; only the most frequent."""
    counted = _beside(members, sets, _hub_tokens(sets, members)).mapInArrow(_count_differences, "key long, n long").groupBy(
        "key").agg(F.sum("n").alias("n")).where("n > 1").orderBy(F.desc("n"), "key").limit(FREQUENT_TOKENS).toArrow()
    keys = counted.column("key").to_numpy().view(np.uint64)
    order = np.argsort(keys)
    return keys[order], counted.column("n").to_numpy()[order]


def difference_pairs(members: DataFrame, sets: DataFrame, percent: int, label: str, frequent: np.ndarray, counts: np.ndarray) -> DataFrame:
    """Pairs (a, b) of different components, among the ``members`` (hub, node, component) of a hub, that may be similar.

    All similar pairs of which not both are similar to the hub are among them.
    |a ^ b| = |A ^ B| must be at most D, so A and B share (|A| + |B| - D) / 2
    tokens or more, and one of them is so early in both, in any common order.
    ``frequent`` and ``counts`` are of ``difference_counts``.
    """
    placed = saved(_beside(members, sets, _hub_tokens(sets, members)).select(
        "hub", "node", "component", "size", "tokens", "hub_tokens").mapInArrow(
        _differences(percent, frequent, counts), "hub long, node long, component long, size int, width long, place long, token long"), f"{label}-early")
    # The one with the smaller difference needs the shorter part.
    most = f"(size + size * 100 div {percent}) * (100 - {percent}) div (100 + {percent})"
    left = placed.where(f"2 * place <= {most}").selectExpr("hub", "token", "node AS a", "component AS a_component", "size AS a_size", "width AS a_width", "place AS a_place")
    right = placed.selectExpr("hub", "token", "node AS b", "component AS b_component", "size AS b_size", "width AS b_width", "place AS b_place")
    allowed = f"a_size + b_size - 2 * (({percent} * (a_size + b_size) + {99 + percent}) div {100 + percent})"
    shared = f"(a_width + b_width - ({allowed}) + 1) div 2"
    both = left.join(right, ["hub", "token"]).where("a_component <> b_component AND (a_width < b_width OR (a_width = b_width AND a < b))").where(
        f"a_place <= a_width - {shared} AND b_place <= b_width - {shared}")
    return both.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def verified(pairs: DataFrame, sets: DataFrame, percent: int, label: str) -> DataFrame:
    """The pairs (a, b) whose token sets are similar enough; bitmaps first, whole sets for what they let through."""
    left = sets.select(F.col("node").alias("a"), F.col("bits").alias("left_bits"), F.col("size").alias("left_size"))
    right = sets.select(F.col("node").alias("b"), F.col("bits").alias("right_bits"), F.col("size").alias("right_size"))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "left_bits", "right_bits", "left_size", "right_size")
    pairs = saved(both.mapInArrow(_sieve(percent), "a long, b long"), f"{label}-sieved")
    left = sets.select(F.col("node").alias("a"), F.col("tokens").alias("left_tokens"))
    right = sets.select(F.col("node").alias("b"), F.col("tokens").alias("right_tokens"))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "left_tokens", "right_tokens")
    return saved(both.mapInArrow(_verify(percent), "a long, b long"), label)


def _token_table(docs: DataFrame, nodes: DataFrame, classes: DataFrame, n: int, label: str) -> DataFrame:
    """Token sets of the given nodes, each from the row with the smallest id.

    A Bloom filter of fixed size picks the rows; a row it lets through by
    mistake is a set that no pair asks for. Repeated rows may give a set more
    than once, which repeats a pair's check but not its result.
    """
    wanted = classes.join(nodes, "node").select("row")
    rows = bloom_passes(docs, "row", bloom_filter(wanted, "row"))
    return saved(rows.mapInArrow(_token_sets(n), "node long, tokens binary, bits binary, size int"), label)


def similar_groups(docs: DataFrame, n: int = NGRAM, percent: int = PERCENT, row: str | None = None) -> DataFrame:
    """Components of documents linked by ``100 * |A & B| >= percent * |A | B|``.

    Takes doc_id and text. Words are cut at ASCII white space, A-Z in lower
    case. Returns one row per row: doc_id, n_shingles, component_id (the
    smallest doc_id that links lead to, itself included). Documents with the
    same set are linked; those without words (null texts too) are linked with
    nothing and keep their own id. A null id counts as the smallest. No rows
    give no rows. ``row`` names a column of unique row numbers, which is passed
    on as ``row``, with ``kept``: one row of each component, of those with its
    smallest id the first.
    """
    key_id = F.coalesce("doc_id", F.lit(NO_ID))
    docs = docs.select("doc_id", key_id.alias("id"), "text", (F.col(row) if row else key_id).alias("row"))
    sets = saved(docs.mapInArrow(
        _measure(n), "row long, doc_id long, id long, n_shingles long, node long, second long, sample array<long>"), "sets")
    classes = saved(
        sets.where("n_shingles > 0").groupBy("node").agg(
            F.min(F.struct("id", "row")).alias("first"), F.count("*").alias("copies"), F.min("second").alias("low"),
            F.max("second").alias("high")).select("node", "first.*", "copies", "low", "high"),
        "classes")
    if not classes.where("low <> high").isEmpty():
        raise RuntimeError("two token sets share a 63-bit key; use another n or hash")

    sampled = sets.where("size(sample) > 0").groupBy("node").agg(F.first("sample").alias("sample"))
    frequent = (
        sampled.select(F.explode("sample").alias("token")).groupBy("token").agg(F.count("*").alias("n"))
        .where(F.col("n") >= FREQUENT_IN_SAMPLE).orderBy(F.desc("n"), "token").limit(FREQUENT_TOKENS).toArrow())
    tokens = frequent.column("token").to_numpy().view(np.uint64)
    order = np.argsort(tokens)
    rates = tokens[order], frequent.column("n").to_numpy()[order]
    index = docs.mapInArrow(
        _index(n, percent, *rates), "key long, node long, size int")

    key = Window.partitionBy("key")
    met = saved(
        index.withColumn("low", F.min("node").over(key)).withColumn("high", F.max("node").over(key))
        .withColumn("rows", F.count("*").over(key)).where("low < high").drop("low", "high"), "met")
    # A document that shares fewer keys with all others than it must share with one is out.
    least_partner = F.ceil(F.first("size") * percent / 100)
    strong = met.groupBy("node").agg(
        F.countDistinct("key").alias("keys"), F.sum("rows").alias("degree"), (1 + F.floor(least_partner / TOKENS_PER_KEY)).alias("least"))
    live = saved(met.join(strong.where("keys >= least").select("node", "degree"), "node").select(
        "key", "node", "size", "degree").distinct(), "live")

    def candidates(rows: DataFrame, left: str, right: str) -> DataFrame:
        """Pairs (a, b) that share enough keys; rows are (a, b, key, sizes)."""
        fits = 100 * F.least(left, right) >= percent * F.greatest(left, right)
        least = 1 + F.floor(F.min(F.least(left, right)) / TOKENS_PER_KEY)
        return rows.where(fits).groupBy("a", "b").agg(F.count("*").alias("shared"), least.alias("least")).where(
            "shared >= least").select("a", "b")

    def check(pairs: DataFrame, label: str) -> DataFrame:
        nodes = pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node"))).distinct()
        return verified(pairs, _token_table(docs, nodes, classes, n, f"{label}-sets"), percent, f"{label}-links")

    def in_several(rows: DataFrame) -> DataFrame:
        """The rows whose key has documents of more than one component."""
        return rows.withColumn("low", F.min("component").over(key)).withColumn("high", F.max("component").over(key)).where(
            "low < high").drop("low", "high")

    # Rounds against one document of each key: first the one with the most company, which is near the middle of its
    # group, then one by chance. Pairs inside a component need no check.
    mixed, links, checked = live.withColumn("component", F.col("node")), None, None
    for label, rank in (("middle", F.col("degree")), ("chance", F.xxhash64("node"))):
        hubs = mixed.groupBy("key").agg(F.max(F.struct(rank.alias("rank"), "node", "size", "component")).alias("hub"))
        beside = mixed.join(hubs, "key").where("component <> hub.component").select(
            F.least("node", "hub.node").alias("a"), F.greatest("node", "hub.node").alias("b"), "key", "size", F.col("hub.size").alias("hub_size"))
        pairs = candidates(beside, "size", "hub_size")
        pairs = saved(pairs if checked is None else pairs.join(checked, ["a", "b"], "left_anti"), f"{label}-pairs")
        found = check(pairs, label)
        links, checked = (found, pairs) if links is None else (links.union(found), checked.union(pairs))
        named = components(links, label)
        placed = mixed.drop("component").join(named, "node", "left").withColumn("component", F.coalesce("component", "node"))
        mixed = saved(in_several(placed), f"{label}-mixed")

    # What is left of each key: all pairs of different components, in crowded keys by their differences from a hub.
    crowds = saved(mixed.groupBy("key").agg(
        F.countDistinct("component").alias("n"), F.max(F.struct("degree", "node")).getField("node").alias("hub")), "crowds")
    cool = mixed.join(crowds.where(F.col("n") <= CROWD).select("key"), "key")
    heads = cool.select("key", "component").distinct()
    meet = heads.withColumnRenamed("component", "left").join(heads.withColumnRenamed("component", "right"), "key").where("left < right")
    one = cool.select("key", F.col("component").alias("left"), F.col("node").alias("a"), F.col("size").alias("a_size"))
    two = cool.select("key", F.col("component").alias("right"), F.col("node").alias("b"), F.col("size").alias("b_size"))
    rest = meet.join(one, ["key", "left"]).join(two, ["key", "right"])
    rest = candidates(rest.select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "key", "a_size", "b_size"), "a_size", "b_size")
    members = saved(mixed.join(crowds.where(F.col("n") > CROWD).select("key", "hub"), "key").select(
        "hub", "node", "component").distinct(), "members")
    if not members.isEmpty():
        member_sets = _token_table(docs, members.select("node").distinct(), classes, n, "member-sets")
        members = centred(members, member_sets, "members")
        apart = difference_pairs(members, member_sets, percent, "members", *difference_counts(members, member_sets))
        beside = members.select(F.least("hub", "node").alias("a"), F.greatest("hub", "node").alias("b"))
        rest = rest.union(apart).union(beside).distinct()
    more = check(saved(rest.join(checked, ["a", "b"], "left_anti"), "rest-pairs"), "rest")

    final = components(links.union(more), "all")
    smallest = classes.join(final, "node").groupBy("component").agg(F.min(F.struct("id", "row")).alias("first"))
    linked = final.join(smallest, "component").select("node", F.col("first.id").alias("component_id"), F.col("first.row").alias("first_row"))
    copied = classes.where("copies > 1").join(linked, "node", "left_anti").select(
        "node", F.col("id").alias("component_id"), F.col("row").alias("first_row"))
    rows = sets.select("row", "doc_id", "id", "n_shingles", "node").join(linked.union(copied), "node", "left")
    component = F.when(F.col("n_shingles") > 0, F.coalesce("component_id", "id")).otherwise(F.col("id"))
    kept = (F.col("n_shingles") == 0) | (F.coalesce("first_row", "row") == F.col("row"))
    return rows.select(
        "doc_id", "n_shingles", F.when(component != NO_ID, component).alias("component_id"), *(["row", kept.alias("kept")] if row else []))


def keep_one_of_each(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with the document of the smallest id of each component, all columns; see ``similar_groups`` for odd rows."""
    docs, row = numbered(docs)
    return drop_rows(docs, row, saved(similar_groups(docs, row=row, **options).where("NOT kept").select("row"), "not-kept"))
