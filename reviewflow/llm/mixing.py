"""Mixing sources to target weights by weighted fair queueing."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewflow.llm.tables import NO_ID, numbered, repeat_rows, running_total, saved
from reviewflow.llm.text import text_column, word_counts
from reviewflow.operators.sequence import with_sequence

# A document comes at most this many times.
MAX_REPEATS = 2
# All sources together get this share of all words.
BUDGET_SHARE = 1.5
# Weights of the sources by code point, null last, over and over.
WEIGHT_CYCLE = (3, 1, 2)
SEED = 20240613


def _sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays(
            [batch.column("row"), batch.column("doc_id"), batch.column("source"), pa.array(word_counts(text_column(batch)))],
            ["row", "doc_id", "source", "size"])


def cycled_weights(sources: DataFrame, cycle: tuple[int, ...] = WEIGHT_CYCLE) -> DataFrame:
    """Add ``weight``: the cycle over the sources by code point, null last."""
    ordered = with_sequence(sources.withColumn("_null", F.col("source").isNull()), ["_null", "source"])
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in cycle]), ((F.col("seq") - 1) % len(cycle) + 1).cast("int"))
    return ordered.withColumn("weight", weight).drop("_null", "seq")


def share_targets(sources: DataFrame, budget_share: float = BUDGET_SHARE, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """Add ``target`` to rows with source_size and weight.

    The budget is shared by weight; what a source would get beyond its cap is
    shared again among the others until none is above. Each round is one
    aggregate of two sums, and a round without a new capped source is the last.
    """
    cap = F.col("source_size") * max_repeats
    ratio = cap / F.col("weight")
    total, weights = sources.agg(F.sum("source_size"), F.sum("weight")).first()
    if not total:
        return sources.withColumn("target", F.lit(0.0))
    budget, level = total * budget_share, total * budget_share / weights
    capped_before = 0
    while True:
        full = ratio < F.lit(level)
        capped, used, left = sources.agg(
            F.count_if(full), F.coalesce(F.sum(F.when(full, cap)), F.lit(0)),
            F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0.0))).first()
        if capped == capped_before:
            break
        capped_before = capped
        if not left:
            level = float("inf")
            break
        level = (budget - used) / left
    return sources.withColumn("target", F.least(cap.cast("double"), F.col("weight") * level))


def mix(docs: DataFrame, weights=cycled_weights, budget_share: float = BUDGET_SHARE, max_repeats: int = MAX_REPEATS,
        seed: int = SEED, row: str | None = None) -> DataFrame:
    """What a mixture takes of each document.

    Takes doc_id, text and source; ``weights`` adds ``weight`` to the distinct
    sources. Documents of a source are shuffled by a hash and come up to
    ``max_repeats`` times one pass after the other; the virtual finish time of
    an entry is the words of its source up to its end over the source's target.
    Entries sorted by finish time over all sources are taken while their words
    fit the budget (the sum of the targets).

    Returns one row per row: doc_id, size, source_size, target, taken (words,
    repeats counted), repeats. Null or empty texts have size 0 and are not
    taken; a null source is a source; a null id counts as the smallest. ``row``
    names a column of unique row numbers, which decides between rows with one id
    and is passed on as ``row``.
    """
    number = F.col(row) if row else F.lit(0).cast("long")
    sizes = saved(docs.select("doc_id", "text", "source", number.alias("row")).mapInArrow(
        _sizes, "row long, doc_id long, source string, size long"), "sizes")
    totals = saved(sizes.groupBy("source").agg(F.sum("size").alias("source_size")), "sources")
    sources = saved(share_targets(weights(totals), budget_share, max_repeats), "targets")
    numbered = with_sequence(sources.withColumn("_null", F.col("source").isNull()), ["_null", "source"], "queue").drop("_null")
    rows = (
        sizes.withColumnRenamed("source", "_source")
        .join(numbered, F.col("_source").eqNullSafe(F.col("source"))).drop("_source", "source", "weight")
        .withColumn("id", F.coalesce("doc_id", F.lit(NO_ID)))
        .withColumn("shuffled", F.xxhash64(F.lit(seed), F.col("id"), F.col("queue"))))
    queued = saved(running_total(rows, ["queue", "shuffled", "id", "row"], "size", by="queue", label="queues")
                   .withColumnRenamed("total", "upto"), "queued")

    def entry(number):
        finish = (F.lit(number) * F.col("source_size") + F.col("upto")) / F.col("target")
        return F.struct(finish.alias("finish"), F.col("queue"), F.lit(number).cast("long").alias("pass_no"), F.col("shuffled"), F.col("id"))

    entries = (
        queued.where("size > 0 AND target > 0")
        .select("size", F.explode(F.array(*[entry(number) for number in range(max_repeats)])).alias("entry"))
        .select("size", "entry.*"))
    order = ["finish", "queue", "pass_no", "shuffled", "id"]
    budget = sources.agg(F.sum("target")).first()[0] or 0.0
    # One row comes to the driver: the last entry that is taken.
    last = running_total(entries, order, "size", label="finish").where(F.col("total") <= F.lit(budget)).agg(
        F.max(F.struct(*order)).alias("last")).first().last
    line = last and F.struct(*[F.lit(value).cast(entries.schema[name].dataType).alias(name) for name, value in last.asDict().items()])
    taken = sum((F.when(entry(number) <= line, 1).otherwise(0) for number in range(max_repeats)), F.lit(0)) if last else F.lit(0)
    repeats = F.when((F.col("size") > 0) & (F.col("target") > 0), taken).otherwise(0)
    return queued.select(
        "doc_id", "size", "source_size", "target", (F.col("size") * repeats).alias("taken"), repeats.alias("repeats"), *(["row"] if row else []))


def draw(docs: DataFrame, **options) -> DataFrame:
    """The documents a mixture takes, each as often as it is taken, all columns.

    Rows with the same id, source and text are one document; other rows that
    share an id are not.
    """
    docs, row = numbered(docs)
    taken = mix(docs, row=row, **options).where("repeats > 0").select("row", "repeats")
    same = docs.select(F.col(row).alias("row"), "doc_id", "source", F.sha2(F.col("text").cast("binary"), 256).alias("digest"))
    once = same.join(taken, "row").groupBy("doc_id", "source", "digest").agg(F.min("row").alias("row"), F.max("repeats").alias("repeats"))
    return repeat_rows(docs, row, once, "repeats")
