"""Keyword search over a whole row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


def row_text(df: DataFrame, string_only: bool = False, null_text: str | None = None) -> Column | None:
    """The columns joined by one blank; None if there are none.

    ``null_text=None`` lets a NULL in any column make the whole text NULL; a
    string takes the NULL's place instead.
    """
    names = [f.name for f in df.schema if not string_only or isinstance(f.dataType, StringType)]
    parts: list[Column] = []
    for name in names:
        text = F.col(f"`{name}`").cast("string")
        parts += [F.lit(" "), text if null_text is None else F.coalesce(text, F.lit(null_text))]
    return F.concat(*parts[1:]) if parts else None


def row_matches(df: DataFrame, keyword: str, string_only: bool = False, null_text: str | None = None) -> Column:
    """Case-insensitive regex over the ``row_text``; a NULL text vetoes the row."""
    text = row_text(df, string_only, null_text)
    return F.lit(True) if text is None else text.rlike(f"(?i){keyword}")


def search_rows(df: DataFrame, keyword: str, string_only: bool = False, null_text: str | None = None) -> DataFrame:
    """Rows that match ``keyword``; an empty keyword keeps every row."""
    if not keyword:
        return df
    return df.where(row_matches(df, keyword, string_only, null_text))
