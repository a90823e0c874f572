"""Dimensions that maintain themselves: one aggregate per key, brought up to date from new loads only.

Maximum, minimum and count can be merged, so the state of a dimension and the
aggregate of the new loads give the state of all. A version of the states has
all tables and the names of the loads in them, and gets its name by one
rename: a run that dies changes nothing, and its repetition reads the same
loads. A load merged from others is known by the loads it stands for. One that
mixes known and new loads cannot be told apart, so the states are then built
anew; as loads are merged again only when as much new data has come, this
happens about as often as the table doubles.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from reviewflow.plans import dims
from reviewflow.plans.staging import stage_reviews
from reviewflow.sources.folders import delete, publish, subfolders
from reviewflow.sources.loads import base_loads, live_loads, read_loads

# Newest versions that stay, so that a reader of the one before can finish.
KEEP = 2


# Table -> (aggregate of staged rows, aggregate of such aggregates).
STATES: dict[str, tuple[Callable[[DataFrame], DataFrame], Callable[[DataFrame], DataFrame]]] = {
    "current_products": (dims.current_products, dims.current_products),
    "current_stores": (dims.current_stores, dims.current_stores),
    "dim_users": (dims.dim_users, dims.merge_users),
    "dim_payments": (dims.dim_payments, dims.dim_payments),
    "dim_date": (dims.dim_date, DataFrame.distinct),
}


def _versions(spark: SparkSession, root: str) -> list[int]:
    return sorted(int(name.removeprefix("state=")) for name in subfolders(spark, root) if name.startswith("state="))


def known_loads(spark: SparkSession, root: str) -> set[str]:
    """The loads, as the stream wrote them, in the newest version of the states."""
    done = _versions(spark, root)
    return {row.value for row in spark.read.text(f"{root}/state={done[-1]}/loads").collect()} if done else set()


def new_loads(spark: SparkSession, silver: str, root: str) -> tuple[list[str], bool]:
    """The loads to read, and whether they add to the newest states (or make them anew)."""
    known = known_loads(spark, root)
    stands_for = {name: base_loads(spark, silver, name) for name in live_loads(spark, silver)}
    mixed = any(known & bases and bases - known for bases in stands_for.values())
    if not known or mixed or known - set().union(*stands_for.values()):
        return sorted(stands_for), False
    return sorted(name for name, bases in stands_for.items() if not bases & known), True


def refresh_states(spark: SparkSession, silver: str, root: str) -> dict[str, DataFrame]:
    """All states as of the live loads of ``silver``; ``root`` is their folder. Without any load there are none."""
    names, adds = new_loads(spark, silver, root)
    done = _versions(spark, root)
    if names:
        staged_rows = stage_reviews(read_loads(spark, silver, names))
        staged = f"{root}/_staged/{uuid.uuid4().hex}"
        for table, (build, merge) in STATES.items():
            state = build(staged_rows)
            if adds:
                state = merge(spark.read.parquet(f"{root}/state={done[-1]}/{table}").unionByName(state))
            state.write.parquet(f"{staged}/{table}")
        loads = set().union(known_loads(spark, root) if adds else set(), *(base_loads(spark, silver, name) for name in names))
        spark.createDataFrame([(name,) for name in sorted(loads)], "value string").coalesce(1).write.text(f"{staged}/loads")
        number = (done[-1] if done else 0) + 1
        if not publish(spark, staged, f"{root}/state={number}"):
            raise RuntimeError(f"another run has published state {number} of {root}")
        done.append(number)
        for old in done[:-KEEP]:
            delete(spark, f"{root}/state={old}")
    return {table: spark.read.parquet(f"{root}/state={done[-1]}/{table}") for table in STATES} if done else {}
