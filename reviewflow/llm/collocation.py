"""Phrases whose words keep together, mined from a weighted de Bruijn graph.

A text is cut into pieces and those into words. Two words in a row are a node,
three are an edge from the node of the first two to that of the last two. Only
edges are counted from the texts, with one more kind of row: that a piece ends
after a node, or after a lone word. All shorter counts follow from the graph:

* a node occurs as often as edges leave it, plus the pieces that end with it;
* a word occurs as often as the nodes that start with it, plus the pieces that
  end with it.

Edges are counted in the tasks first and dealt out by their source, so that
edge counts and node flow come from one shuffle; the flow of words is summed
up from the node sums of each task.

A node is unary when one edge brings all its occurrences and one takes them
all. Edges joined by unary nodes are compacted to paths: passages that are
repeated as wholes. Both cuts of an inner edge of a path are known from it, and
no node inside a path is a phrase of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reviewflow.llm.tables import saved
from reviewflow.llm.text import chunks, layout, text_column, word_codes

LEAST = 10
# A phrase inside a longer one that has this share of its occurrences is dropped.
PERCENT = 50
TOP = 2000
NO_LANG = "und"
# Bytes of text whose edges are counted at a time; a single longer text is handled alone.
CHUNK = 8 << 20
# Candidates of a language are ranked in so many parts at most before the best of all parts are.
PARTS = 256

_WORD, _BLANK, _BREAK = 0, 1, 2
_KIND = np.zeros(256, np.uint8)
_KIND[list(b" \t")] = _BLANK
_KIND[list(b".,;:!?\n\x0b\x0c\r")] = _BREAK
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def cut_words(column: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of a column, A-Z in lower case, and which of them continue the piece of the word before."""
    data, places = layout(column)
    if not len(data):
        return pa.array([], pa.large_binary()), np.zeros(0, bool)
    kind = _KIND[data]
    inside = kind == _WORD
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    rows = places[:-1][places[:-1] < len(data)]
    first[rows] |= inside[rows]
    starts = np.flatnonzero(first)
    # A break, or the start of a row, since the word before.
    broken = kind == _BREAK
    broken[rows] = True
    pieces = np.cumsum(broken, dtype=np.int32)[starts]
    letters = _LOWER[data[inside]]
    bounds = np.append(np.cumsum(inside, dtype=np.int64)[starts] - 1, len(letters))
    words = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(letters)])
    follows = np.zeros(len(starts), bool)
    follows[1:] = pieces[1:] == pieces[:-1]
    return words, follows


def _counted(first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs of numbers below 2**31: both parts, how often each pair comes, and the pair of each entry."""
    values, inverse, counts = np.unique(first.astype(np.int64) << 32 | second, return_inverse=True, return_counts=True)
    return values >> 32, values & 0xFFFFFFFF, counts, inverse


def _edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["lang", "node", "next", "n"]

    def rows(lang: str, node: pa.Array, following: pa.Array, counts: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([lang]).take(pa.array(np.zeros(len(counts), np.int32))), node.cast(pa.string()), following, pa.array(counts)], names)

    for batch in batches:
        texts, langs = text_column(batch), batch.column("lang")
        for lang in pc.unique(langs).to_pylist():
            mine = texts.filter(pc.equal(langs, lang))
            for start, end in chunks(mine, CHUNK):
                words, follows = cut_words(mine.slice(start, end - start))
                codes, distinct = word_codes(words)
                if not len(codes):
                    continue
                distinct = distinct.cast(pa.large_binary())
                ends = ~np.append(follows[1:], False)
                last = np.unique(codes[ends], return_counts=True)
                yield rows(lang, distinct.take(pa.array(last[0])), pa.nulls(len(last[0]), pa.string()), last[1])
                seconds = np.flatnonzero(follows)
                if not len(seconds):
                    continue
                one, two, _, node = _counted(codes[seconds - 1], codes[seconds])
                nodes = pc.binary_join_element_wise(distinct.take(pa.array(one)), distinct.take(pa.array(two)), pa.scalar(b" ", pa.large_binary()))
                closing = np.unique(node[ends[seconds]], return_counts=True)
                yield rows(lang, nodes.take(pa.array(closing[0])), pa.nulls(len(closing[0]), pa.string()), closing[1])
                goes_on = np.flatnonzero(~ends[seconds])
                if len(goes_on):
                    source, third, counts, _ = _counted(node[goes_on], codes[seconds[goes_on] + 1])
                    for at in range(0, len(counts), 1 << 16):
                        part = slice(at, at + (1 << 16))
                        yield rows(lang, nodes.take(pa.array(source[part])), distinct.take(pa.array(third[part])).cast(pa.string()), counts[part])


def phrase_counts(docs: DataFrame, lang: str = "lang", least: int = LEAST) -> DataFrame:
    """(lang, phrase, size, f): how often each word occurs, and each phrase of two or three words, if ``least`` times or more.

    Counted inside pieces, overlaps included. A null ``lang`` is ``und``, a null text empty.
    """
    edges = docs.select(F.coalesce(lang, F.lit(NO_LANG)).alias("lang"), "text").mapInArrow(
        _edges, "lang string, node string, next string, n long")
    edges = edges.repartition("lang", "node").groupBy("lang", "node", "next").agg(F.sum("n").alias("n"))
    # The same partitioning serves edges and the flow of their source.
    flow = edges.select("lang", "node", F.explode(F.expr(f"""
        CASE WHEN n >= {least} AND next IS NOT NULL THEN array(struct(node AS phrase, n), struct(concat(node, ' ', next) AS phrase, n))
             ELSE array(struct(node AS phrase, n)) END""")).alias("at")).groupBy("lang", "node", "at.phrase").agg(F.sum("at.n").alias("n"))
    first = "substring_index(node, ' ', 1)"
    counts = flow.select("lang", F.explode(F.expr(f"""
        CASE WHEN phrase <> node THEN array(struct(phrase, n))
             WHEN n >= {least} AND instr(node, ' ') > 0 THEN array(struct(phrase, n), struct({first} AS phrase, n))
             ELSE array(struct({first} AS phrase, n)) END""")).alias("at")).groupBy("lang", "at.phrase").agg(F.sum("at.n").alias("f"))
    return saved(counts.select("lang", "phrase", F.size(F.split("phrase", " ")).alias("size"), "f"), "phrases")


def weighed_edges(counts: DataFrame, least: int = LEAST) -> DataFrame:
    """The phrases of three words with the counts of their nodes and outer words."""
    one, two = (counts.where((F.col("size") == size) & (F.col("f") >= least)) for size in (1, 2))
    edges = counts.where("size = 3").select(
        "lang", "phrase", F.col("f").alias("a"), F.substring_index("phrase", " ", 2).alias("source"),
        F.substring_index("phrase", " ", -2).alias("target"), F.substring_index("phrase", " ", 1).alias("first"),
        F.substring_index("phrase", " ", -1).alias("third"))
    for place, table in (("source", two), ("target", two), ("first", one), ("third", one)):
        edges = edges.join(table.select("lang", F.col("phrase").alias(place), F.col("f").alias(f"f_{place}")), ["lang", place])
    return saved(edges, "edges")


def unary_paths(edges: DataFrame) -> DataFrame:
    """(lang, phrase, head, step): the path of each weighed edge that a unary node joins to another.

    ``head`` is the path's first edge and ``step`` the place of the edge in it,
    from 0. Pointers to the edge before are doubled, so the rounds are as many
    as the longest path has binary digits. A piece that starts or ends at a
    node makes it not unary, so no path is closed.
    """
    into = edges.where("a = f_target").select("lang", F.col("target").alias("node"), F.col("phrase").alias("before"))
    out = edges.where("a = f_source").select("lang", F.col("source").alias("node"), "phrase")
    links = saved(into.join(out, ["lang", "node"]).select("lang", "phrase", "before"), "links")
    heads = links.select("lang", F.col("before").alias("phrase")).join(links, ["lang", "phrase"], "left_anti")
    done = heads.select("lang", "phrase", F.col("phrase").alias("head"), F.lit(0).cast("long").alias("step"))
    state = saved(done.withColumn("open", F.lit(False)).union(
        links.select("lang", "phrase", F.col("before").alias("head"), F.lit(1).cast("long").alias("step"), F.lit(True).alias("open"))), "path-round")
    while not state.where("open").isEmpty():
        ahead = state.select("lang", F.col("phrase").alias("head"), F.col("head").alias("further"), F.col("step").alias("more"), F.col("open").alias("goes_on"))
        moved = state.where("open").join(ahead, ["lang", "head"]).select(
            "lang", "phrase", F.col("further").alias("head"), (F.col("step") + F.col("more")).alias("step"), F.col("goes_on").alias("open"))
        state = saved(state.where("NOT open").unionByName(moved), "path-round")
    return state.drop("open")


def passages(paths: DataFrame, edges: DataFrame) -> DataFrame:
    """(lang, head, passage, n): the words of each path, and how often it occurs."""
    steps = paths.join(edges.select("lang", "phrase", "a"), ["lang", "phrase"])
    words = F.array_sort(F.collect_list(F.struct("step", F.substring_index("phrase", " ", -1).alias("word"))))
    return steps.groupBy("lang", "head").agg(words.alias("words"), F.max("a").alias("n")).select(
        "lang", "head", F.concat_ws(" ", F.substring_index("head", " ", 2), F.col("words.word")).alias("passage"), "n")


def _score(a: str, left: str, right: str) -> str:
    """floor(10**6 a**2 / (left right)), exact for counts below 10**15."""
    wide = "cast({} AS decimal(16,0))".format
    return f"cast(({wide(a)} * {wide(a)} * 1000000) div ({wide(left)} * {wide(right)}) AS long)"


def collocations(docs: DataFrame, lang: str = "lang", least: int = LEAST, percent: int = PERCENT, top: int = TOP) -> DataFrame:
    """The best phrases of two or three words of each language.

    Takes text and the column ``lang``; others play no part. Pieces end at
    ``. , ; : ! ?`` and line breaks, words at blanks and tabs, A-Z count as
    a-z. A phrase occurs ``least`` times or more (a). It is cut after a word
    into parts that occur l and r times; of its cuts the one with the lowest
    floor(10**6 a**2 / (l r)) counts, ties to the first. Phrases inside a longer
    one with at least ``percent`` of their occurrences are dropped.

    Returns lang, rank (from 1), phrase, a, l, r, n (all words of the
    language), score, passage: up to ``top`` rows for each language, highest
    score first, then highest a, then phrase by its bytes. ``passage`` is the
    path that the phrase is an edge of, null for none. A null language is
    ``und``, together with rows that say so. Null and empty texts add nothing;
    languages without such phrases, and an empty table, have no rows; repeated
    rows count each time.
    """
    counts = phrase_counts(docs, lang, least)
    words = counts.where("size = 1")
    totals = words.groupBy("lang").agg(F.sum("f").alias("n"))
    edges = weighed_edges(counts, least)
    paths = unary_paths(edges)

    three = edges.selectExpr(
        "lang", "phrase", "a", f"{_score('a', 'f_first', 'f_target')} AS one", f"{_score('a', 'f_source', 'f_third')} AS two",
        "f_first", "f_target", "f_source", "f_third").selectExpr(
        "lang", "phrase", "a", "if(one <= two, f_first, f_source) AS l", "if(one <= two, f_target, f_third) AS r", "least(one, two) AS score")
    around = edges.select("lang", F.explode(F.array("source", "target")).alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("most"))
    frequent = words.where(F.col("f") >= least)
    two = counts.where("size = 2").select(
        "lang", "phrase", F.col("f").alias("a"), F.substring_index("phrase", " ", 1).alias("first"), F.substring_index("phrase", " ", -1).alias("second"))
    two = two.join(around, ["lang", "phrase"], "left").where(f"most IS NULL OR 100 * most < {percent} * a")
    for place, count in (("first", "l"), ("second", "r")):
        two = two.join(frequent.select("lang", F.col("phrase").alias(place), F.col("f").alias(count)), ["lang", place])
    two = two.selectExpr("lang", "phrase", "a", "l", "r", f"{_score('a', 'l', 'r')} AS score")

    order = [F.desc("score"), F.desc("a"), "phrase"]
    parts = min(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), PARTS)
    dealt = three.union(two).withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(parts)))
    best = dealt.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).where(F.col("rank") <= top)
    best = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    best = saved(best.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score"), "collocations")

    of_best = best.select("lang", "phrase").join(paths, ["lang", "phrase"]).select("lang", "phrase", "head")
    shown = passages(paths.join(of_best.select("lang", "head").distinct(), ["lang", "head"], "left_semi"), edges).drop("n")
    return best.join(of_best.join(shown, ["lang", "head"]).drop("head"), ["lang", "phrase"], "left").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score", "passage")
