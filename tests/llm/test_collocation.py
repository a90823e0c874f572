"""Collocations and the phrase graph against plain counting."""

import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from reviewflow.llm import collocation
from tests.llm.brute import LOWER


def pieces(text):
    for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
        found = re.findall(r"[^\x20\x09]+", piece)
        if found:
            yield found


def counted(rows):
    counts = defaultdict(Counter)
    for lang, text in rows:
        for found in pieces(text):
            for size in (1, 2, 3):
                counts["und" if lang is None else lang].update(tuple(found[k:k + size]) for k in range(len(found) - size + 1))
    return counts


def brute(rows, least=10, percent=50, top=2000):
    result = []
    for lang, f in counted(rows).items():
        n = sum(c for gram, c in f.items() if len(gram) == 1)
        candidates = {gram: a for gram, a in f.items() if len(gram) > 1 and a >= least}
        scored = []
        for gram, a in candidates.items():
            if any(len(longer) > len(gram) and 100 * c >= percent * a
                   and any(longer[k:k + len(gram)] == gram for k in range(len(longer) - len(gram) + 1)) for longer, c in candidates.items()):
                continue
            score, k = min((10 ** 6 * a * a // (f[gram[:k]] * f[gram[k:]]), k) for k in range(1, len(gram)))
            scored.append((-score, -a, " ".join(gram).encode(), f[gram[:k]], f[gram[k:]]))
        result += [(lang, rank, phrase.decode(), -a, left, right, n, -score)
                   for rank, (score, a, phrase, left, right) in enumerate(sorted(scored)[:top], 1)]
    return sorted(result)


def rows_of(seed, n=300):
    rng = random.Random(seed)
    words = ["a", "b", "The", "the", "été", "日本", "x1", "new", "york", "city", "über", "zz\x00", "of"]
    rows = [(None, None), ("en", ""), ("en", " \t"), ("de", "..,;"), (None, "one"), ("fr", "solo " * 30), ("und", "a b c\n" * 12)]
    for _ in range(n):
        text = []
        for _ in range(rng.randint(1, 12)):
            text.append(" ".join(rng.choice(words[:rng.randint(2, 13)]) for _ in range(rng.randint(1, 9))))
            if rng.random() < 0.3:
                text.append("this passage always comes as one whole")
        rows.append((rng.choice(["en", "en", "de", None, ""]), "".join(t + rng.choice([". ", ",", "\n", " ", "\t", "!?", "\x0b"]) for t in text)))
    return rows + [rows[20]] * 15


def frame_of(spark, rows):
    frame = spark.createDataFrame(rows, "lang string, text string").repartition(4)
    return frame.withColumns({name: F.lit(1) for name in ("phrase", "node", "next", "n", "a", "f", "part", "rank", "head")})


def found(frame, **options):
    return sorted(tuple(row)[:8] for row in collocation.collocations(frame, **options).collect())


@pytest.mark.parametrize("seed, options", [(1, {}), (2, {"least": 2, "percent": 80}), (3, {"top": 7})])
def test_against_plain_counting(spark, monkeypatch, seed, options):
    monkeypatch.setattr(collocation, "CHUNK", 500)
    rows = rows_of(seed, 120)
    want = brute(rows, **options)
    assert len(want) > 20
    assert found(frame_of(spark, rows), **options) == want


def test_counts_of_the_graph(spark):
    """Node flow plus piece ends gives what counting every length does."""
    rows = rows_of(4)
    counts = {(row["lang"], row["phrase"]): row["f"] for row in collocation.phrase_counts(frame_of(spark, rows), least=3).collect()}
    want = {(lang, " ".join(gram)): c for lang, f in counted(rows).items() for gram, c in f.items() if len(gram) == 1 or c >= 3}
    assert counts == want


def test_paths_are_whole_passages(spark):
    passage = "every word of this long passage comes only here in this very order"
    rows = [("en", f"x{k} y{k}. {passage}, z{k}") for k in range(25)] + [("en", "a b a b a b a b c d. q a b") for _ in range(12)]
    graph = collocation.weighed_edges(collocation.phrase_counts(frame_of(spark, rows)))
    paths = collocation.passages(collocation.unary_paths(graph), graph).collect()
    assert (passage, 25) in {(row["passage"], row["n"]) for row in paths}
    shown = {row["phrase"]: row["passage"] for row in collocation.collocations(frame_of(spark, rows)).collect()}
    assert shown["word of this"] == passage and shown["a b a"] == "a b a b" and shown["q a b"] is None


def test_scores_beyond_64_bits(spark):
    score = spark.range(1).selectExpr(f"{collocation._score('900000000000000', '999999999999999', '900000000000001')} AS s").first()["s"]
    assert score == 10 ** 6 * 900000000000000 ** 2 // (999999999999999 * 900000000000001)


def test_empty_table(spark):
    assert found(spark.createDataFrame([], "lang string, text string")) == []
