"""Decisions on some rows of a table, without a shuffle of the others."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewflow.llm.tables import new_names
from reviewflow.llm.urls import bloom_filter, bloom_flag


def set_apart(docs: DataFrame, name: str, touched: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows of ``docs`` whose number (column ``name``) is surely not in ``touched.row``, and the others.

    A Bloom filter of bounded size tells, so the first are never shuffled. It
    lets some of them through to the others, more the more rows are touched,
    which an exact join has to sort out.
    """
    flag, = new_names(docs, "touched")
    flagged = bloom_flag(docs, name, bloom_filter(touched, "row"), flag)
    return flagged.where(~F.col(flag)).select(docs.columns), flagged.where(F.col(flag)).select(docs.columns)


def drop_rows(docs: DataFrame, name: str, dropped: DataFrame) -> DataFrame:
    """``docs`` without the rows whose number (column ``name``) is in ``dropped.row``, and without that column."""
    clear, others = set_apart(docs, name, dropped)
    stays = others.join(dropped.select(F.col("row").alias(name)), name, "left_anti").select(docs.columns)
    return clear.union(stays).drop(name)
