"""Where is a record now? Answered for all ids in one pass."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A record is found by either of its ids.
TRACE_KEYS = ["reviewerID", "asin"]


def _sightings(rows: DataFrame, keys: list[str], payload: str) -> DataFrame:
    """(id, first payload by text order) of every id that occurs in ``rows``."""
    ids = rows.select(F.explode(F.array(*keys)).alias("id"), F.col(payload).alias("payload"))
    return ids.where("id is not null").groupBy("id").agg(F.min("payload").alias("payload"))


def trace_records(ids: DataFrame | None, raw: DataFrame, dlq: DataFrame, keys: list[str] | None = None,
                  payload: str = "raw_json") -> DataFrame:
    """Membership, stage statuses and one payload per id.

    ``ids`` is a one-column frame of ids to trace; None traces every id seen.
    Both sides are reduced to one row per id before they meet.
    """
    keys = keys or TRACE_KEYS
    in_raw = _sightings(raw, keys, payload).select("id", F.col("payload").alias("raw_payload"))
    in_dlq = _sightings(dlq, keys, payload).select("id", F.col("payload").alias("dlq_payload"))
    found = in_raw.withColumn("in_raw", F.lit(True)).join(
        in_dlq.withColumn("in_dlq", F.lit(True)), "id", "full")
    return _stages(found, ids)


def trace_marked(ids: DataFrame | None, rows: DataFrame, rejected: Column, keys: list[str] | None = None,
                 payload: str = "raw_json") -> DataFrame:
    """The same where one frame has all messages and ``rejected`` marks the dead letters: one aggregation, no join."""
    sightings = rows.select(F.explode(F.array(*(keys or TRACE_KEYS))).alias("id"), F.col(payload).alias("payload"), rejected.alias("rejected"))
    found = sightings.where("id is not null").groupBy("id").agg(
        F.min("payload").alias("raw_payload"), F.lit(True).alias("in_raw"),
        F.min(F.when(F.col("rejected"), F.col("payload"))).alias("dlq_payload"), F.max("rejected").alias("in_dlq"))
    return _stages(found, ids)


def _stages(found: DataFrame, ids: DataFrame | None) -> DataFrame:
    if ids is not None:
        wanted = ids.select(F.col(ids.columns[0]).alias("id")).where("id is not null").distinct()
        found = wanted.join(found, "id", "left")
    raw_seen, rejected = F.coalesce("in_raw", F.lit(False)), F.coalesce("in_dlq", F.lit(False))

    def stage(waiting: str, blocked: str, passed: str):
        return F.when(~raw_seen, waiting).when(rejected, blocked).otherwise(passed)

    return found.select(
        "id", raw_seen.alias("in_raw"), rejected.alias("in_dlq"),
        F.when(raw_seen, "received").otherwise("missing").alias("ingestion"),
        stage("waiting", "rejected", "clean").alias("bronze"),
        stage("waiting", "blocked", "stored").alias("silver"),
        F.when(raw_seen & ~rejected, "pending").otherwise("not ready").alias("gold"),
        F.coalesce("dlq_payload", "raw_payload").alias("payload"))
