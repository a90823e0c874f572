"""Personal data: exact base patterns, and spans found by bootstrapped contexts.

The base patterns give seed entities. The words around a seed induce lexical
patterns; other identifier-like tokens are instances of the patterns around
them. Patterns and instances score each other in rounds over the graph they
form: a pattern by the instances it is found with, an instance by its patterns.
Patterns of high confidence in the end mark tokens that no base pattern knows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewflow.llm.tables import saved
from reviewflow.llm.text import row_sums, layout, text_column

KINDS = ("email", "ip", "card", "phone")
EMAIL, IP, CARD, PHONE = range(4)
ROUNDS = 3
# A pattern needs so many different instances with a score, and this confidence.
LEAST_INSTANCES = 5
CONFIDENCE = 0.9
# Characters beside a span that are searched for context words, and the longest word part used.
REACH, WORD_CHARS = 80, 24

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# A run of digits matches from its start or not at all, so only starts of runs are tried.
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_TOKEN = re.compile(r"[^\x20\x09-\x0D]+")
_DIGIT = re.compile(r"[0-9]")
_EDGE = ".,;:!?'\"()[]{}<>|*#$%&"
# Loose shapes of the four kinds, for tokens that no base pattern takes.
_LOOSE = (
    re.compile(r"[^@]+@[^@]+"),
    re.compile(r"[0-9A-Fa-f]*(?:[.:][0-9A-Fa-f]*){3,}"),
    re.compile(r"(?:[0-9][-.]?){12,19}"),
    re.compile(r"\+?(?:[0-9()][-./()]?){7,15}"),
)
_OCCURRENCES = "row long, start int, end int, kind int, value long, seed boolean, contexts array<string>"
_BASE = "row long, doc_id long, base array<struct<kind:int,start:int,end:int>>, found array<struct<start:int,end:int,kind:int,value:long,seed:boolean,contexts:array<string>>>"


def _luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """As the pattern's leftmost non-overlapping matches, in linear time: from each @ outwards."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            done = domain.end()
            yield start, done
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) by kind and start, in code points."""
    found = [(EMAIL, *span) for span in _emails(text)]
    for match in _IP.finditer(text):
        parts = [part.lstrip("0") for part in match.group().split(".")]
        if all(len(part) <= 3 and int(part or 0) <= 255 for part in parts):
            found.append((IP, *match.span()))
    for match in _CARD.finditer(text):
        digits = match.group().replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and _luhn(digits):
            found.append((CARD, *match.span()))
    for match in _PHONE.finditer(text):
        if 8 <= len(_DIGIT.findall(match.group())) <= 15:
            found.append((PHONE, *match.span()))
    return found


def contexts(text: str, start: int, end: int) -> list[str]:
    """Lexical patterns around a span: one and two words before, one after; digits are all 0."""
    before = re.sub("[0-9]", "0", text[max(start - REACH, 0):start].lower())
    after = re.sub("[0-9]", "0", text[end:end + REACH].lower())
    glued = "" if not before or before[-1].isspace() else "+"
    words = [word[-WORD_CHARS:] for word in before.split()[-2:]]
    near = words[-1] + glued if words else "^"
    far = words[0] if len(words) > 1 else "^"
    following = after.split()[:1]
    return [f"l1 {near}", f"l2 {far} {near}", f"r1 {following[0][:WORD_CHARS] if following else '$'}"]


def _value(kind: int, text: str) -> int:
    plain = text.lower() if kind == EMAIL else re.sub(r"[^0-9A-Za-z.:]" if kind == IP else r"[^0-9]", "", text)
    return xxhash.xxh3_64_intdigest(f"{kind} {plain}") - (1 << 63)


def occurrences(text: str, base: list[tuple[int, int, int]]) -> Iterator[tuple]:
    """Seeds, and tokens with a digit or @ that touch no seed and have the loose shape of a kind."""
    for kind, start, end in base:
        yield start, end, kind, _value(kind, text[start:end]), True, contexts(text, start, end)
    taken = sorted((start, end) for _, start, end in base)
    reached = 0
    for token in _TOKEN.finditer(text):
        word = token.group()
        if not ("@" in word or _DIGIT.search(word)):
            continue
        left = len(word) - len(word.lstrip(_EDGE.replace("(", "")))
        inner = word.strip(_EDGE.replace("(", "").replace(")", ""))
        start = token.start() + left
        while reached < len(taken) and taken[reached][1] <= token.start():
            reached += 1
        if len(inner) > 64 or reached < len(taken) and taken[reached][0] < token.end():
            continue
        kind = next((k for k in (EMAIL, IP, CARD, PHONE) if _LOOSE[k].fullmatch(inner)), None)
        # Other identifier-like tokens count against the patterns they stand in.
        yield start, start + len(inner), -1 if kind is None else kind, _value(-1 if kind is None else kind, inner), False, contexts(
            text, start, start + len(inner))


_MARKED = np.zeros(256, np.uint8)
_MARKED[list(b"0123456789@")] = 1
_BASE_TYPE = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32())]))
_FOUND_TYPE = pa.list_(pa.struct([
    ("start", pa.int32()), ("end", pa.int32()), ("kind", pa.int32()), ("value", pa.int64()), ("seed", pa.bool_()),
    ("contexts", pa.list_(pa.string()))]))


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    row = TaskContext.get().partitionId() << 40
    names = _FOUND_TYPE.value_type.names if hasattr(_FOUND_TYPE.value_type, "names") else [f.name for f in _FOUND_TYPE.value_type]
    for batch in batches:
        column = text_column(batch)
        data, places = layout(column)
        marked = row_sums(_MARKED[data], places) > 0
        base, found = [[] for _ in marked], [[] for _ in marked]
        for k in np.flatnonzero(marked).tolist():
            text = column[k].as_py()
            spans = base_spans(text)
            base[k] = [{"kind": kind, "start": start, "end": end} for kind, start, end in spans]
            found[k] = [dict(zip(names, entry)) for entry in occurrences(text, spans)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(row, row + len(column))), batch.column("doc_id"), pa.array(base, _BASE_TYPE), pa.array(found, _FOUND_TYPE)],
            ["row", "doc_id", "base", "found"])
        row += len(column)


def good_patterns(found: DataFrame, rounds: int = ROUNDS, least: int = LEAST_INSTANCES, confidence: float = CONFIDENCE) -> DataFrame:
    """(context, kind) of the patterns with high confidence after the rounds.

    Copies of a text repeat their edges, so the graph has each pair of a
    context and a value once. A pattern's confidence is the mean score, for its
    kind, of all values found in its context; a value's score is the chance
    that one of its patterns is right, and 1 for seeds.
    """
    edges = saved(
        found.select("kind", "value", "seed", F.explode("contexts").alias("context"))
        .groupBy("context", "kind", "value").agg(F.max("seed").alias("seed")), "edges")
    sizes = edges.groupBy("context").agg(F.count("*").alias("n_values"))
    scores = saved(edges.where("kind >= 0").groupBy("kind", "value").agg(
        F.max(F.col("seed").cast("double")).alias("score")), "instances")
    patterns = None
    for number in range(rounds):
        rated = edges.join(scores, ["kind", "value"]).groupBy("context", "kind").agg(
            F.sum("score").alias("total"), F.count_if(F.col("score") > 0).alias("instances"))
        patterns = saved(rated.join(sizes, "context").withColumn("confidence", F.col("total") / F.col("n_values")).where(
            (F.col("instances") >= least) & (F.col("confidence") >= confidence)).select("context", "kind", "confidence"), "patterns")
        if number + 1 < rounds:
            doubt = edges.join(patterns, ["context", "kind"]).groupBy("kind", "value").agg(
                F.sum(F.log(1.0 - F.least("confidence", F.lit(0.99)))).alias("doubt"))
            scores = saved(scores.join(doubt, ["kind", "value"], "left").select(
                "kind", "value", F.greatest("score", 1 - F.exp(F.coalesce("doubt", F.lit(0.0)))).alias("score")), "instances")
    return patterns.select("context", "kind")


def find_pii(docs: DataFrame, rounds: int = ROUNDS, least: int = LEAST_INSTANCES, confidence: float = CONFIDENCE) -> DataFrame:
    """Spans of personal data in each text.

    Takes doc_id and text. Returns one row per row: doc_id, base and spans,
    arrays of (kind, start, end) by kind and start: kind 0 email, 1 ip, 2 card,
    3 phone, places in code points, the end exclusive. ``spans`` has the base
    ones and those that patterns found. A null or empty text has none; repeated
    rows are found alike, and count once in the graph.
    """
    scanned = saved(docs.select("doc_id", "text").mapInArrow(_scan, _BASE), "scanned")
    found = scanned.select("row", F.explode("found").alias("at")).select("row", "at.*")
    patterns = good_patterns(found, rounds, least, confidence)
    extra = (
        found.where("NOT seed AND kind >= 0").select("row", "kind", "start", "end", F.explode("contexts").alias("context"))
        .join(patterns, ["context", "kind"]).groupBy("row").agg(F.collect_set(F.struct("kind", "start", "end")).alias("extra")))
    spans = F.when(F.col("extra").isNull(), F.col("base")).otherwise(F.array_sort(F.concat("base", "extra")))
    return scanned.select("row", "doc_id", "base").join(extra, "row", "left").select("doc_id", "base", spans.alias("spans"))


def span_text(column: str):
    """Spans as kind:start:end, comma-joined."""
    names = F.array(*[F.lit(kind) for kind in KINDS])
    return F.array_join(F.transform(column, lambda span: F.concat_ws(
        ":", F.element_at(names, span["kind"] + 1), span["start"].cast("string"), span["end"].cast("string"))), ",")
