"""Every operator against plain Python on awkward rows, and on empty tables."""

import hashlib
import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
import public_tokenizers
from reviewflow.llm import bpe, dedup, lm, mixing, ngram_join, pages, pii, quality, toxicity, urls
from reviewflow.llm.rows import drop_rows
from reviewflow.llm.tables import NO_ID, numbered, running_total
from tests.llm import brute

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
# Columns that clash with names the operators use themselves.
CLASHING = ("id", "size", "row", "node", "key", "host", "norm", "_id", "_place", "_times", "component", "held_out", "total", "seq")


def awkward():
    """Rows with nulls everywhere, empty, blank and very long texts, ties, repeated rows, copies and near copies."""
    rng = random.Random(5)
    vocabulary = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 7))) for _ in range(300)]

    def text(n):
        return " ".join(rng.choice(vocabulary) for _ in range(n))

    long = text(40_000)
    near = [text(120) for _ in range(3)]
    rows = [(None, None, None, None, None), (1, None, "en", "a", None), (2, "", "en", None, 0), (3, " \t\n\x0b\x0c\r ", None, "b", 7),
            (4, "one two", "en", "a", 7), (5, "ONE  two", "en", "b", 8), (6, long, "en", "a", len(long)),
            (7, "x" * 30_000, "en", "ä", 30_000), (8, "mail a.b@c.de, 10.0.0.1 and +1 (555) 123-4567; 4111 1111 1111 1111", "en", "a", 1),
            (9, "it's we'll   12½ 日本語\n\n don't", "en", None, 1), (10, "\u0000 odd \x1c chars  ", "en", "a", 1)]
    for k in range(60):
        base = near[k % 3].split()
        for _ in range(k // 10):
            base[rng.randrange(len(base))] = rng.choice(vocabulary)
        rows.append((100 + k, " ".join(base), "en", "a" if k % 2 else "b", 1))
    rows += [(200 + k, text(rng.randint(1, 200)), "de", rng.choice(["a", "b", None, "c"]), 1) for k in range(60)]
    rows += [(300 + k, rows[20][1].replace(" ", "\n") if k % 2 else rows[20][1], "en", "a", 1) for k in range(10)]
    return rows + [rows[30], rows[30], rows[12]]


@pytest.fixture(scope="module")
def docs(spark):
    frame = spark.createDataFrame(awkward(), SCHEMA).repartition(5)
    return frame.withColumns({name: F.lit(7) for name in CLASHING}).cache()


@pytest.fixture(scope="module")
def plain():
    """Text of each id (null is NO_ID), and how often its row comes."""
    rows = awkward()
    return {NO_ID if r[0] is None else r[0]: r[1] for r in rows}, Counter(NO_ID if r[0] is None else r[0] for r in rows)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def by_id(frame):
    found = defaultdict(list)
    for row in frame.collect():
        found[NO_ID if row["doc_id"] is None else row["doc_id"]].append(row.asDict())
    return found


def same_rows(found, counts):
    assert {k: len(v) for k, v in found.items()} == dict(counts)


def test_exact_groups(docs, plain):
    texts, counts = plain
    found = by_id(dedup.exact_groups(docs))
    same_rows(found, counts)
    stays = brute.exact(texts)
    sizes = Counter()
    for doc_id, keep in stays.items():
        sizes[keep] += counts[doc_id]
    for doc_id, rows in found.items():
        norm = "".join(brute.words(texts[doc_id])).encode()
        for row in rows:
            assert (NO_ID if row["keep_id"] is None else row["keep_id"]) == stays[doc_id]
            assert row["group_size"] == sizes[stays[doc_id]]
            assert row["text_sha256"] == hashlib.sha256(norm).hexdigest()
        assert sum(row["kept"] for row in rows) == (stays[doc_id] == doc_id)


def test_exact_groups_over_many_partitions(spark):
    """A text that most rows share is spread over tasks and still one group."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = [(k, "the same  text" if k % 3 else f"text {k}") for k in range(3_000)]
        found = dedup.exact_groups(spark.createDataFrame(rows, "doc_id long, text string").repartition(7))
        big = found.where("group_size > 1")
        assert big.count() == 2_000 and big.select("keep_id", "group_size").distinct().collect() == [(1, 2_000)]
        assert found.where("kept").count() == 1_001
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_mix(docs, plain):
    texts, counts = plain
    rows = awkward()
    source = {NO_ID if r[0] is None else r[0]: r[3] for r in rows}
    sizes = defaultdict(int)
    for doc_id, text in texts.items():
        sizes[source[doc_id]] += counts[doc_id] * len(brute.words(text))
    targets = brute.targets(sizes)
    found = by_id(mixing.mix(docs))
    same_rows(found, counts)
    taken = defaultdict(int)
    for doc_id, entries in found.items():
        for row in entries:
            assert row["size"] == len(brute.words(texts[doc_id])) and row["source_size"] == sizes[source[doc_id]]
            assert math.isclose(row["target"], targets[source[doc_id]], abs_tol=1e-6)
            assert row["taken"] in (0, row["size"], 2 * row["size"])
            taken[source[doc_id]] += row["taken"]
    assert sum(taken.values()) <= sum(targets.values()) + 1e-6
    again = by_id(mixing.mix(docs))
    assert {k: sorted(r["taken"] for r in v) for k, v in again.items()} == {k: sorted(r["taken"] for r in v) for k, v in found.items()}


def test_mix_takes_near_the_targets(spark):
    rng = random.Random(1)
    rows = [(k, "w " * rng.randint(1, 30), "hot" if k % 3 == 0 else f"s{k % 7}") for k in range(6_000)]
    found = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(6))
    joined = found.join(spark.createDataFrame(rows, "doc_id long, t string, source string").drop("t"), "doc_id")
    for row in joined.groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target")).collect():
        assert abs(row["taken"] - row["target"]) <= 60


def test_targets_stop_at_the_cap(spark):
    sizes = {"a": 10, "b": 1_000, "c": 5, "d": 300, None: 40}
    frame = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    found = {r["source"]: r["target"] for r in mixing.share_targets(mixing.cycled_weights(frame)).collect()}
    assert found == pytest.approx(brute.targets(sizes))


def test_draw_repeats_documents(docs, plain):
    found = Counter(NO_ID if r["doc_id"] is None else r["doc_id"] for r in mixing.draw(docs).collect())
    assert mixing.draw(docs).columns == docs.columns
    assert max(found.values()) <= 2 and set(found) <= set(plain[0])


def test_running_total(spark):
    rows = [(k % 3, k, k * 7 % 11) for k in range(500)]
    frame = spark.createDataFrame(rows, "g int, k int, v long").repartition(4)
    found = {(r["g"], r["k"]): r["total"] for r in running_total(frame, ["g", "k"], "v", by="g").collect()}
    assert found == {(g, k): sum(v for h, j, v in rows if h == g and j <= k) for g, k, _ in rows}


def test_quality(docs, plain):
    texts, counts = plain
    found = by_id(quality.judge(docs))
    same_rows(found, counts)
    for doc_id, rows in found.items():
        want = brute.quality(texts[doc_id])
        for row in rows:
            assert {name: row[name] for name in want} == want
            assert row["kept"] == (not row["base_failed"])


def test_common_lines_are_removed_and_depleted_documents_rejected(spark):
    words = [f"w{k}" for k in range(400)]
    rows = []
    for k in range(120):
        own = " ".join(random.Random(k).sample(words, 80))
        rows.append((k, f"The SAME  line\n{own}", "h"))
    rows += [(1_000 + k, "the same line\n" * 20 + " ".join(random.Random(k).sample(words, 20)), "h") for k in range(60)]
    rows += [(2_000 + k, "copied line " + " ".join(words[:60]), "h") for k in range(120)]
    rows += [(3_000, "the same line\n" + " ".join(words[:60]), None)]
    found = {r["doc_id"]: r for r in quality.judge(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert all(found[k]["kept"] and found[k]["removed_words"] == 3 for k in range(120))
    assert all(not found[1_000 + k]["kept"] and found[1_000 + k]["removed_words"] == 60 for k in range(60))
    # Copies count as one document, so a group of copies does not remove its own lines.
    assert all(found[2_000 + k]["kept"] and found[2_000 + k]["removed_words"] == 0 for k in range(120))
    assert found[3_000]["removed_words"] == 0


def test_similar_groups(docs, plain):
    texts, counts = plain
    found = by_id(ngram_join.similar_groups(docs))
    same_rows(found, counts)
    want = brute.components(texts)
    for doc_id, rows in found.items():
        for row in rows:
            assert row["n_shingles"] == len(brute.shingles(texts[doc_id]))
            assert (NO_ID if row["component_id"] is None else row["component_id"]) == want[doc_id]


def test_similar_groups_with_frequent_tokens(spark, monkeypatch):
    """Low thresholds, so that prefixes hold combinations; chains of near copies and a passage that many share."""
    monkeypatch.setattr(ngram_join, "SAMPLE_ONE_IN", 1)
    monkeypatch.setattr(ngram_join, "FREQUENT_IN_SAMPLE", 2)
    monkeypatch.setattr(ngram_join, "COMBINED_IN_SAMPLE", 4)
    rng = random.Random(3)
    passage = " ".join(f"p{k}" for k in range(60))
    rows = []
    for k in range(60):
        rows.append((k, passage + " " + " ".join(f"q{rng.randrange(9_000)}" for _ in range(rng.choice([2, 6, 12, 40])))))
    for size in (30, 150, 700):
        base = [f"b{size}-{k}" for k in range(size)]
        for k in range(25):
            base[rng.randrange(size)] = f"e{rng.randrange(10_000)}"
            rows.append((size * 100 + k, " ".join(base)))
    found = ngram_join.similar_groups(spark.createDataFrame(rows, "doc_id long, text string").repartition(6))
    assert {r["doc_id"]: r["component_id"] for r in found.collect()} == brute.components(dict(rows))


def edited_copies(rng, copies, size, most, offset):
    """Copies of one text with up to ``most`` words changed, a few of them changed once more into near pairs."""
    base = [f"w{offset}-{k}" for k in range(size)]
    rows = []
    for k in range(copies):
        text = list(base)
        for place in rng.sample(range(size), most * k // copies):
            text[place] = f"e{rng.randrange(10**9)}"
        rows.append(text)
    for k in range(copies // 2, copies, 9):
        twin = list(rows[k])
        twin[rng.randrange(size)] = f"t{rng.randrange(10**9)}"
        rows.append(twin)
    return [(offset + k, " ".join(text)) for k, text in enumerate(rows)]


@pytest.mark.parametrize("crowd, sample", [(2, 1), (16, 1), (16, 16)])
def test_similar_groups_among_half_similar_texts(spark, monkeypatch, crowd, sample):
    """400 copies with growing edits: near pairs far from the hub are found, and few pairs are looked at."""
    monkeypatch.setattr(ngram_join, "CROWD", crowd)
    monkeypatch.setattr(ngram_join, "SAMPLE_ONE_IN", sample)
    rng = random.Random(crowd)
    rows = edited_copies(rng, 400, 120, 40, 0) + edited_copies(rng, 60, 300, 90, 10_000) + edited_copies(rng, 60, 14, 5, 20_000)
    looked_at = []
    verified = ngram_join.verified

    def counted(pairs, *rest):
        looked_at.append(pairs.count())
        return verified(pairs, *rest)

    monkeypatch.setattr(ngram_join, "verified", counted)
    found = ngram_join.similar_groups(spark.createDataFrame(rows, "doc_id long, text string").repartition(6))
    assert {r["doc_id"]: r["component_id"] for r in found.collect()} == brute.components(dict(rows))
    assert sum(looked_at) < 12 * len(rows)


def test_differences_keep_every_similar_pair(spark):
    """Similar sets that are not both similar to their hub stay candidates, whatever the hub."""
    rng = np.random.default_rng(7)
    rows, hub = [], np.sort(rng.choice(2**40, 90, replace=False).astype(np.uint64))
    for k in range(160):
        size = rng.integers(0, 60)
        mine = np.union1d(rng.choice(hub, len(hub) - size, replace=False), rng.choice(2**40, size, replace=False).astype(np.uint64))
        rows.append(mine)
        for _ in range(2):
            lost = rng.integers(0, 12)
            rows.append(np.union1d(rng.choice(mine, len(mine) - lost, replace=False), rng.choice(2**40, rng.integers(0, 12)).astype(np.uint64)))
    sets = spark.createDataFrame([(k, bytearray(t.tobytes()), len(t)) for k, t in enumerate([hub, *rows])], "node long, tokens binary, size int")
    members = spark.createDataFrame([(0, k + 1, k + 1) for k in range(len(rows))], "hub long, node long, component long")
    found = {tuple(row) for row in ngram_join.difference_pairs(members, sets, 80, "test", np.zeros(0, np.uint64), np.zeros(0, np.int64)).collect()}

    def similar(a, b):
        common = len(np.intersect1d(a, b))
        return 100 * common >= 80 * (len(a) + len(b) - common)

    want = {(a + 1, b + 1) for a in range(len(rows)) for b in range(a + 1, len(rows))
            if similar(rows[a], rows[b]) and not (similar(rows[a], hub) and similar(rows[b], hub))}
    assert len(want) > 100 and want <= found and len(found) < 4 * len(want) + 200


def test_crowd_beside_an_odd_hub_pairs_few(spark):
    """A hub with many edits of its own puts them into all differences; the most central document does not."""
    rng = np.random.default_rng(3)

    def edited(tokens, lost):
        return np.union1d(rng.choice(tokens, len(tokens) - lost, replace=False), rng.choice(2**40, lost, replace=False).astype(np.uint64))

    base = np.sort(rng.choice(2**40, 140, replace=False).astype(np.uint64))
    rows = [edited(base, 36), edited(base, 2), *(edited(base, rng.integers(17, 30)) for _ in range(200))]
    rows.append(edited(rows[50], 3))
    sets = spark.createDataFrame([(k, bytearray(t.tobytes()), len(t)) for k, t in enumerate(rows)], "node long, tokens binary, size int")
    members = spark.createDataFrame([(0, k, k) for k in range(len(rows))], "hub long, node long, component long")
    none = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    beside_odd = ngram_join.difference_pairs(members.where("node > 0"), sets, 80, "odd", *none).count()
    moved = ngram_join.centred(members, sets, "test")
    assert {(r.hub, r.node) for r in moved.collect()} == {(1, k) for k in range(len(rows)) if k != 1}
    found = {tuple(row) for row in ngram_join.difference_pairs(moved, sets, 80, "test", *ngram_join.difference_counts(moved, sets)).collect()}
    assert (50, len(rows) - 1) in found and len(found) < 20 and beside_odd > 100 * len(found)


@pytest.mark.parametrize("frequent_share", [0.0, 0.5, 1.0])
def test_prefixes_of_similar_sets_share_a_key(frequent_share):
    rng = np.random.default_rng(2)
    for size in list(range(2, 30)) + [70, 130, 300, 900]:
        for _ in range(5):
            left = np.unique(rng.integers(0, 2**63, size, dtype=np.uint64))
            lost = rng.integers(0, len(left) // 5 + 1)
            right = np.unique(np.concatenate([
                np.delete(left, rng.choice(len(left), lost, replace=False)),
                rng.integers(0, 2**63, rng.integers(0, len(left) // 5 + 1), dtype=np.uint64)]))
            common = len(np.intersect1d(left, right))
            if 100 * common < 80 * (len(left) + len(right) - common) or np.array_equal(left, right):
                continue
            every = np.union1d(left, right)
            frequent = np.sort(rng.choice(every, int(frequent_share * len(every)), replace=False))
            counts = rng.integers(3, 90, len(frequent))
            keys = [set(ngram_join.prefix_keys(side, frequent, counts).tolist()) for side in (left, right)]
            assert len(keys[0] & keys[1]) >= 1 + min(len(left), len(right)) // ngram_join.TOKENS_PER_KEY


def test_lm(docs, plain):
    texts, counts = plain
    found = by_id(lm.score_texts(docs))
    same_rows(found, counts)
    many = {(k, c): texts[k] for k in texts for c in range(counts[k])}
    tokens = {k: [w.translate(brute.LOWER) for w in brute.words(t)] + [None] for k, t in many.items()}
    held = {k: k != NO_ID and brute.held_out(k, 7, 2) for k in texts}
    count = Counter(t for (k, c), ts in tokens.items() if not held[k] for t in ts)
    total, distinct = sum(count.values()), len(count)
    for doc_id, rows in found.items():
        own = tokens[doc_id, 0]
        base = sum(math.log10((count[t] + 1) / (total + distinct + 1)) for t in own)
        for row in rows:
            assert (row["held_out"], row["n_tokens"], row["train_tokens"]) == (held[doc_id], len(own), total)
            assert row["n_known"] == sum(count[t] > 0 for t in own)
            assert row["base_score"] == pytest.approx(base, abs=1e-6) and row["score"] < 0


def test_lm_probabilities_are_normalised():
    vocabulary = lm.Vocabulary(np.arange(40, dtype=np.uint64), np.arange(40, 0, -1), 5, 900, 60)
    model = lm.start_model(vocabulary)
    every = np.arange(vocabulary.size)
    logs = lm.log_probabilities(model, every, np.full(vocabulary.size, 3), np.full(vocabulary.size, 0))
    assert (10 ** logs).sum() == pytest.approx(1, abs=1e-4)


def test_lm_learns_from_context(spark):
    """A deterministic sequence: the word before tells the next, which counts cannot know."""
    rows = [(k, " ".join(f"w{(k + j) % 20}" for j in range(200))) for k in range(400)]
    held = lm.score_texts(spark.createDataFrame(rows, "doc_id long, text string").repartition(2)).where("held_out")
    base, score = held.agg(F.sum("base_score"), F.sum("score")).first()
    assert score > 0.5 * base


def test_toxicity(docs, plain, spark):
    texts, counts = plain
    labels = spark.createDataFrame([(4, 1), (5, 0), (6, 0), (7, 1), (None, 1), (9_999, 1), (8, None)], "doc_id long, toxic int")
    found = by_id(toxicity.score_toxicity(docs, labels))
    same_rows(found, counts)
    for doc_id, rows in found.items():
        for row in rows:
            assert 0 <= row["score"] <= 1 and row["predicted"] == (row["score"] >= 0.5)
            assert row["held_out"] == (doc_id != NO_ID and brute.held_out(doc_id, 5, 0))


def test_toxicity_learns(spark):
    rng = random.Random(4)
    vocabulary = ["".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(200)]
    rows, labels = [], []
    for k in range(800):
        words = [rng.choice(vocabulary) for _ in range(rng.choice([20, 300]))]
        if k % 5 == 1:
            words[rng.randrange(len(words))] = rng.choice(["nastyword", "vileterm"])
        rows.append((k, " ".join(words)))
        labels.append((k, int(k % 5 == 1)))
    scored = toxicity.score_toxicity(
        spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int"))
    held = [(r["predicted"], int(r["doc_id"] % 5 == 1)) for r in scored.where("held_out").collect()]
    assert sum(p == t for p, t in held) >= 0.97 * len(held)


def test_pii(docs, plain):
    texts, counts = plain
    found = by_id(pii.find_pii(docs).withColumn("base", pii.span_text("base")).withColumn("spans", pii.span_text("spans")))
    same_rows(found, counts)
    for doc_id, rows in found.items():
        for row in rows:
            assert row["base"] == ",".join(brute.pii(texts[doc_id])) and set(row["base"].split(",")) <= set(row["spans"].split(","))


@pytest.mark.parametrize("text", [
    "a@b.c_x@d.e", "@@a@b.c", "x@y a@b.c.d@e.f", "a@-.-@b.c", "1.2.3.4.5.6.7.8", "256.1.1.1 001.02.3.255", "..1.2.3.4..", "1.2.3",
    "+1 2 3 4 5 6 7 8", "++12345678", "+1(23)45-67 89)", "4111111111111111 4111-1111-1111-1111 4111 1111 1111 11112", "0" * 5_000,
    "+" + "9" * 5_000, "1." * 3_000, "é" * 9 + "ü@x.de", "a" * 3_000 + "@" + "b" * 3_000, "a@b.c@d.e.f", "%+-@a.b+1 555 123 4567"])
def test_base_spans_are_those_of_the_patterns(text):
    names = [f"{pii.KINDS[kind]}:{start}:{end}" for kind, start, end in pii.base_spans(text)]
    assert names == brute.pii(text)


def test_contexts_discover_identifiers(spark):
    rng = random.Random(6)
    rows = []
    for k in range(40):
        rows.append((k, f"some text here call hotline: +1 (555) {rng.randint(100, 999)}-{rng.randint(1000, 9999)} today"))
        rows.append((500 + k, f"random {rng.randint(1, 10**6)} number and {rng.randint(1, 10**9)} more"))
    rows.append((900, "please call hotline: 555-867-5309 today"))
    rows.append((901, "please read 555-867-5309 slowly"))
    found = {r["doc_id"]: r["spans"] for r in pii.find_pii(spark.createDataFrame(rows, "doc_id long, text string")).select(
        "doc_id", pii.span_text("spans").alias("spans")).collect()}
    assert found[900] == "phone:21:33"
    assert all(found[500 + k] == "" for k in range(40))


def test_bpe(docs, plain):
    texts, counts = plain
    path = public_tokenizers.path(corpus_pipeline.VOCABULARY)
    encoding = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.load_ranks(path), special_tokens={})
    found = by_id(bpe.decode(bpe.encode(docs, str(path)), str(path)))
    same_rows(found, counts)
    for doc_id, rows in found.items():
        text = texts[doc_id] or ""
        for row in rows:
            assert np.frombuffer(bytes(row["ids"]), "<u4").tolist() == encoding.encode_ordinary(text)
            assert bytes(row["decoded"]) == text.encode() and row["n_tokens"] == len(row["ids"]) // 4


def test_folded_words_equal_merged_words(spark):
    path = public_tokenizers.path(corpus_pipeline.VOCABULARY)
    ranks = bpe.load_ranks(path)
    encoding = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    words = [" the", " international", "é", "日本", "x" * 40, " 12345", "\n\n", "…!?", " thehereinth"]
    frame = spark.createDataFrame([(w.encode(),) for w in words], "word binary")
    found = {bytes(r["word"]).decode(): r["ids"] for r in bpe.fold_words(frame, ranks).collect()}
    assert found == {w: encoding._encode_single_piece(w) for w in words}


def test_ranks_stay_out_of_plan_texts(spark):
    """The driver keeps the texts of plans, and one for each change of a running plan."""
    ranks = bpe.load_ranks(public_tokenizers.path(corpus_pipeline.VOCABULARY))
    folded = bpe.fold_words(spark.createDataFrame([(b" the",)], "word binary"), ranks)
    assert len(folded._jdf.queryExecution().toString()) < 1_000_000


def test_urls(spark):
    addresses = ["http://www.A.example.NET/en/x?q=1#f", "https://example.com/de/", "https://example.com/de", "ftp://b.org/fr/z", "nohost",
                 None, "", "://", "http://", "http://x.y//", "http://bad.com/page/?q", "http://m.bad.com/page?q#frag", "HTTP://É.net?x/en/",
                 "http://notexample.com/de/x", "http://bad.com/page?other"]
    pages_frame = spark.createDataFrame([(k, u) for k, u in enumerate(addresses)] + [(3, addresses[3])], "page_id long, url string")
    listed = spark.createDataFrame([("http://bad.com/page?q",), (None,), ("nohost",)], "url string").select(
        urls.canonical(F.col("url")).alias("canonical"))
    found = {r["page_id"]: r for r in urls.judge_pages(pages_frame.withColumn("block", F.lit(1)), listed).collect()}
    assert urls.judge_pages(pages_frame, listed).count() == len(addresses) + 1
    assert (found[0]["host"], found[0]["path"], found[0]["rule"], found[0]["verdict"]) == ("www.a.example.net", "/en/x", "example.net/en/", "allow")
    assert [found[k]["rule"] for k in (1, 2, 3, 4, 13)] == ["example.com/de/", None, "org/fr/", None, None]
    assert [found[k]["host"] for k in (4, 5, 6, 7, 8, 12)] == ["", "", "", "", "", "É.net"]
    assert [found[k]["verdict"] for k in (10, 11, 14, 12, 4)] == ["block", "block", "allow", "allow", "allow"]


def test_bloom_false_positives_are_removed(spark):
    pages_frame = spark.range(3_000).select(F.col("id").alias("page_id"), F.concat(F.lit("http://h.com/"), "id").alias("url"))
    listed = pages_frame.where("page_id % 10 = 0").select(urls.canonical(F.col("url")).alias("canonical"))
    # Eight blocks let nearly everything through.
    found = urls.judge_pages(pages_frame, listed, blocks=8)
    assert found.where("verdict = 'block'").count() == 300 and found.where("verdict = 'block' AND page_id % 10 <> 0").count() == 0


PAGE = """<!DOCTYPE html><html><head><title>T &amp; t</title><style>p{{}}</style><script>var t="</p><p>no</p>";</script></head>
<body class="page with-sidebar"><header><p>Site</p></header><nav><ul><li><a href="/a">Menu</a></ul></nav><div class="cookie-notice">Cookies</div>
<div class=content><h1>Head {k}</h1><p>First&nbsp;one &lt;b&gt; {k}<br>and   <b>bold</b>er<p>Second <!-- no --> {k}<p>Read our terms</div>
<aside>Side</aside><form><input value="x>y">Mail</form><div id="comments"><p>Nice!</p></div><div>Terms of use</div><footer>Foot {k}"""


def test_pages(spark):
    rows = [(k, f"http://h.com/{k}", PAGE.format(k=k)) for k in range(12)]
    rows += [(100, None, None), (101, "http://x.y", ""), (102, "x", "plain < text & more"), (103, "http://z", "<p>" * 3_000 + "deep"),
             (104, "http://z", "<div>" * 600 + "x" + "</div>" * 600), (105, "http://z", '<a href="' * 50), (106, "http://z", "<article><p>A</article><p>B")]
    rows.append(rows[0])
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("host", F.lit("x")).withColumn("text", F.lit(1))
    found = defaultdict(list)
    for row in pages.extract_articles(frame.repartition(3)).collect():
        found[row["page_id"]].append(row)
    assert len(found[0]) == 2 and sum(map(len, found.values())) == len(rows)
    for k in range(12):
        # "Terms of use" and "Read our terms" stay the same on all pages of the host.
        assert found[k][0]["text"] == f"Head {k}\nFirst one <b> {k} and bolder\nSecond {k}"
        assert found[k][0]["n_chars"] == len(found[k][0]["text"])
    assert [found[k][0]["text"] for k in (100, 101, 102, 103, 104, 106)] == ["", "", "plain < text & more", "deep", "x", "A"]


def test_tree_matching_is_the_best_one():
    one = pages.parse("<div><p>a</p><ul><li>x</li><li>y</li></ul><h3>b</h3></div>")
    two = pages.parse("<div><h2>t</h2><p>a</p><ul><li>x</li></ul><h3>b</h3><p>c</p></div>")
    known = {}
    pages.shape(one, known)
    pages.shape(two, known)
    pairs = [(a.text, b.text) for a, b in pages.align(one, two, {}) if a.tag == "#text"]
    assert sorted(pairs) == [("a", "a"), ("b", "b"), ("x", "x")]


def test_copies_of_a_page_keep_their_article(spark):
    html = "<body><nav>Menu</nav><article><h1>Same</h1><p>on every page</p></article></body>"
    frame = spark.createDataFrame([(k, "http://h.com/a", html) for k in range(30)], "page_id long, url string, html string")
    assert pages.extract_articles(frame).select("text").distinct().collect() == [("Same\non every page",)]


@pytest.mark.parametrize("source, want", [
    ('<p>Foo <span class="ad">Buy</span> bar</p>', "Foo bar"),
    ('<p>Foo <span hidden>a <span>b</span> c</span> <a href="/x">bar</a></p><p>Next', "Foo bar\nNext"),
    ('<div><p>Foo <span class="ad">Buy</p><p>bar</p></div>', "Foo\nbar"),
    ('<div>Foo <a class="advert" href="/x"><div>Buy<br><img src="y"></div> now</a> bar</div>', "Foo bar"),
    ('<ul><li>Foo <b class="share">Tweet<li>bar <i style="display:none">x', "Foo\nbar"),
    ('<p>See <svg viewBox="0"><path d="M0"/><text>x</text></svg> here, <button>Buy</button>now <svg/>too</p>', "See here, now too"),
    ('<article><p>First</p></article><p>between</p><article><p>Second, longer</p></article>', "First\nSecond, longer"),
])
def test_inline_elements_declared_no_article_are_cut_out(source, want):
    assert pages.main_text(source, None) == want


def test_wrapper_survives_pages_that_lack_it(spark):
    page = "<body><div><p>Head {k}</p><h4>Ask the desk</h4></div><h5>Printed in Bern</h5></body>"
    rows = [(k, "http://h.com/a", page.format(k=k)) for k in range(57)]
    rows += [(100, "http://h.com/a", None), (101, "http://h.com/a", ""), (102, "http://h.com/a", "<body><ul><li>odd</ul></body>")]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    for parts in (1, 7):
        found = {r["page_id"]: r["text"] for r in pages.extract_articles(frame.repartition(parts, F.col("page_id"))).collect()}
        assert found == {**{k: f"Head {k}" for k in range(57)}, 100: "", 101: "", 102: "odd"}


def test_template_counts_what_comes_late():
    """Constant on 92 of 100 pages, after eight with other texts and nodes; what is rare does not pile up."""
    sources = [f"<body><h5>other {k // 2}</h5><p>x</body>" for k in range(8)]
    sources += [f"<body><p>{k}</p><h5>same</h5><h{k % 6 + 1}>odd {k}</h{k % 6 + 1}></body>" for k in range(92)]
    merged = None
    for source in sources:
        template = pages._template(pages.parse(source))
        merged = template if merged is None else pages.merge_templates(merged, template)
    def texts(root):
        return [text for node in pages._nodes(root) for text in node.text]

    merged = pages._load(pages._dump(merged))
    assert len(texts(merged)) < 60
    assert pages._constants(merged, pages.CONSTANT_SHARE * len(sources))
    assert texts(merged) == [pages._hash("same")]


def test_constant_paragraph_after_bodies_of_any_length(spark):
    """All blocks have one shape, so only their texts tell the notice at the end from the article."""
    rows = [(k, "http://h.com/a", "<body>" + "".join(f"<p>Line {k} {i}</p>" for i in range(3 + k)) + "<p>Printed in Bern</p></body>")
            for k in range(20)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    for parts in (1, 5):
        found = {r["page_id"]: r["text"] for r in pages.extract_articles(frame.repartition(parts, F.col("page_id"))).collect()}
        assert found == {k: "\n".join(f"Line {k} {i}" for i in range(3 + k)) for k in range(20)}


def test_deep_and_wide_pages(spark):
    """Pages nested beyond any call stack, alike and not, and 20,000 siblings, among ordinary ones of their host."""
    page = "<body><div><p>Head {k}</p></div><h5>Printed in Bern</h5></body>"
    rows = [(k, "http://h.com/a", page.format(k=k)) for k in range(40)]
    rows += [(100, "http://h.com/a", "<div>" * 20_000 + "deep"), (101, "http://h.com/a", "<div>" * 19_000 + "<p>less</p>" + "</div>" * 19_000),
             (102, "http://h.com/a", "<body>" + "".join(f"<p>{i}" for i in range(20_000)) + "</body>"),
             (103, "http://h.com/a", "<div>" * 5_000 + "</section>" * 20_000 + "stray")]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = {r["page_id"]: r["text"] for r in pages.extract_articles(frame.repartition(3, F.col("page_id"))).collect()}
    assert found == {**{k: f"Head {k}" for k in range(40)}, 100: "deep", 101: "less", 102: "\n".join(map(str, range(20_000))), 103: "stray"}


def test_tree_matching_against_plain_recursion():
    rng = random.Random(3)

    def tree(depth):
        node = pages.Node(rng.choice("ab"))
        node.children = [tree(depth - 1) for _ in range(rng.randint(0, 3) if depth else 0)]
        return node

    def best(a, b):
        if a.tag != b.tag:
            return 0
        table = [[0] * (len(b.children) + 1) for _ in range(len(a.children) + 1)]
        for i, left in enumerate(a.children):
            for j, right in enumerate(b.children):
                table[i + 1][j + 1] = max(table[i][j] + best(left, right), table[i][j + 1], table[i + 1][j])
        return 1 + table[-1][-1]

    for _ in range(300):
        one, two, known = tree(3), tree(3), {}
        two.tag = one.tag
        pages.shape(one, known)
        pages.shape(two, known)
        assert pages._solve(pages._weight(one, two, {})) == best(one, two)


def test_tree_matching_of_long_lists_is_the_same():
    rng = random.Random(5)

    def siblings(n):
        nodes = [pages.Node(rng.choice("ab")) for _ in range(n)]
        for node in nodes:
            node.children = [pages.Node(rng.choice("cd")) for _ in range(rng.randint(0, 2))]
        return nodes

    for n, m in [(1, 1), (1, 30), (30, 1), (17, 40), (40, 17), (60, 60)] * 3:
        left, right, known = siblings(n), siblings(m), {}
        for node in (*left, *right):
            pages.shape(node, known)
        assert pages._solve(pages._dynamic_in_blocks(left, right, {})) == pages._solve(pages._dynamic(left, right, {}))
    # Lists beyond CELLS: dropped siblings, which alignment by runs of like siblings lost more for.
    left, right, known = siblings(260), siblings(260), {}
    for node in (*left, *right):
        pages.shape(node, known)
    assert len(left) * len(right) > pages.CELLS
    weigh = lambda pairs, memo: sum(pages._solve(pages._weight(left[i], right[j], memo)) for i, j in pairs if left[i].tag == right[j].tag)
    assert weigh(pages._solve(pages._match(left, right, {})), {}) == weigh(pages._solve(pages._dynamic(left, right, {})), {})


def test_empty_tables(spark, empty):
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    web = spark.createDataFrame([], "page_id long, url string, html string")
    path = str(public_tokenizers.path(corpus_pipeline.VOCABULARY))
    listed = spark.createDataFrame([], "canonical string")
    for frame in (mixing.mix(empty), pii.find_pii(empty), toxicity.score_toxicity(empty, labels), pages.extract_articles(web),
                  lm.score_texts(empty), quality.judge(empty), ngram_join.similar_groups(empty), urls.judge_pages(web, listed),
                  bpe.decode(bpe.encode(empty, path), path), dedup.exact_groups(empty), mixing.draw(empty), quality.keep_good(empty)):
        assert frame.count() == 0


def test_kept_documents_lose_their_common_lines(spark):
    words = [f"w{k}" for k in range(400)]
    own = [" ".join(random.Random(k).sample(words, 80)) for k in range(120)]
    rows = [(k if k % 2 else None, f"{text}\n\n The SAME\tline É \nend {k}", "h", 0) for k, text in enumerate(own)]
    rows += [(500, f"{own[0]}\nthe same line é", "other", 7), (501, "the same line é\n" * 60, "h", 7)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars long").withColumn("row", F.lit(1))
    kept = quality.keep_good(frame.repartition(3))
    assert kept.columns == frame.columns and kept.dtypes == frame.dtypes
    want = [(f"{text}\n\nend {k}", len(f"{text}\n\nend {k}")) for k, text in enumerate(own)] + [(rows[120][1], 7)]
    assert sorted((r["text"], r["n_chars"]) for r in kept.collect()) == sorted(want)


def test_stages_keep_rows_by_their_own_text(spark):
    """Null and shared ids: nothing good is lost to, or replaced by, another row with the id."""
    good = [" ".join(random.Random(k).sample([f"w{j}" for j in range(4_000)], 80)) for k in range(8)]
    first = [(None, "too short", "a"), (None, good[0], "a"), (None, good[1], "b"), (None, good[1].replace(" ", "\n"), "b"),
             (7, "too short too", "a"), (7, good[2], "a"), (7, good[3], "b"), (8, good[3], "b"), (9, good[4], None),
             (None, good[5], "a"), (10, good[5] + " end", "a"), (7, good[6], "a"), (7, good[6] + " end", "a"), (None, good[7], None)]
    frame = spark.createDataFrame(first, "doc_id long, text string, source string").withColumn("_row", F.lit("x")).repartition(4)

    def rows(frame):
        return sorted(((r["doc_id"] or 0), " ".join(r["text"].split())) for r in frame.collect())

    kept = quality.keep_good(frame)
    assert kept.columns == frame.columns
    assert rows(kept) == sorted((k or 0, " ".join(text.split())) for k, text, _ in first if "short" not in text)
    single = dedup.drop_exact_copies(kept)
    assert rows(single) == sorted([(0, good[0]), (0, good[1]), (7, good[2]), (7, good[3]), (9, good[4]), (0, good[5]),
                                   (10, good[5] + " end"), (7, good[6]), (7, good[6] + " end"), (0, good[7])])
    apart = rows(ngram_join.keep_one_of_each(single))
    assert sorted((k, text.removesuffix(" end")) for k, text in apart) == sorted(
        [(0, good[0]), (0, good[1]), (7, good[2]), (7, good[3]), (9, good[4]), (0, good[5]), (7, good[6]), (0, good[7])])
    # A budget of two of everything takes all.
    drawn = rows(mixing.draw(single, budget_share=2.0))
    assert drawn == sorted(2 * rows(single))


def test_row_numbers(spark, docs, folder):
    """Rows of Parquet files are numbered where they lie, others in a copy; each row keeps its number."""
    clashing = docs.withColumns({"_metadata": F.lit("own"), "_row": F.lit("own")})
    clashing.write.parquet(f"{folder}/a b+c%20d")
    table = spark.read.parquet(f"{folder}/a b+c%20d")
    for frame, copied in ((table, False), (table.where("doc_id > 3"), True)):
        rows, name = numbered(frame)
        assert ("llm-numbered" in "".join(rows.inputFiles())) == copied
        assert rows.drop(name).columns == frame.columns and rows.count() == frame.count() == rows.select(name).distinct().count()
        once = sorted(map(str, rows.select(name, "doc_id", "text").collect()))
        assert once == sorted(map(str, rows.repartition(3).select(name, "doc_id", "text").collect()))
        assert rows.where("_metadata = 'own' AND _row = 'own'").count() == frame.count()


def test_drop_rows_keeps_clashing_columns(spark, docs):
    rows = docs.select(F.monotonically_increasing_id().alias("n"), "*").withColumns({"_touched": F.lit(1), "block": F.lit(2), "word": F.lit(3)}).cache()
    dropped = rows.where("doc_id < 10 OR doc_id IS NULL").select(F.col("n").alias("row"))
    kept = drop_rows(rows, "n", dropped)
    assert kept.columns == rows.columns[1:]
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(r["doc_id"] for r in docs.where("doc_id >= 10").collect())
    # A filter that is full lets all rows through to the exact join.
    many = spark.range(300_000)
    assert drop_rows(many, "id", many.where("id % 3 > 0").select(F.col("id").alias("row"))).columns == []
    rest = drop_rows(many.select("id", F.col("id").alias("value")), "id", many.where("id % 3 > 0").select(F.col("id").alias("row")))
    assert rest.selectExpr("count(*) AS n", "max(value % 3) AS most").first().asDict() == {"n": 100_000, "most": 0}
