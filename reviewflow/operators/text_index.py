"""Which files of a large folder may hold a row that matches a keyword?

For each file the index has a blocked Bloom filter (see ``file_index``) of the
trigrams of its rows' searched text. A keyword is a regular expression; what
every match must contain is read off its plain letters. Files that lack a
trigram of it are not read, the rows of the others go through the search
itself, so the result is the same as without the index. An expression without
plain letters, or one that uses more than the common constructs, reads all.
"""

from __future__ import annotations

from collections.abc import Callable
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewflow.functions.bloom import bits_of, block_of
from reviewflow.functions.search import row_text, search_rows
from reviewflow.operators.file_index import filters_of, new_files, own_path, read_index, update_index

# Words of a file's filter: 128 KB, for some 100,000 different trigrams a file.
BLOCKS = 1 << 14
LENGTH = 3
# A substring is looked for from the start of its text, so long texts are cut into pieces of this many places first.
PIECE = 256
# An expression whose branches multiply to more than this keeps what is known outside of them.
MOST_BRANCHES = 16

_LOWER = str.maketrans(ascii_uppercase, ascii_lowercase)


class _Unknown(Exception):
    """The expression uses something that is not looked into."""


def required_texts(keyword: str) -> list[list[str]] | None:
    """Branches of a regular expression: a match contains all texts of one of them, but for the case of A-Z.

    None if a match need not contain anything of three letters or more.
    """
    try:
        branches, end = _branches(keyword, 0)
    except _Unknown:
        return None
    if end < len(keyword):
        return None
    found = [[text for text in branch if len(text) >= LENGTH] for branch in branches]
    return found if all(found) else None


def _branches(keyword: str, at: int) -> tuple[list[list[str]], int]:
    """The branches from ``at`` on, up to the end of the group."""
    found: list[list[str]] = []
    while True:
        branch, at = _sequence(keyword, at)
        found += branch
        if at == len(keyword) or keyword[at] == ")":
            return found, at
        at += 1


def _sequence(keyword: str, at: int) -> tuple[list[list[str]], int]:
    """What stands between two bars; several branches where a group has them."""
    found, run = [[]], ""

    def close() -> str:
        for branch in found:
            branch.append(run)
        return ""

    while at < len(keyword) and keyword[at] not in "|)":
        letter, inner, plain = keyword[at], None, None
        if letter == "(":
            if keyword[at + 1:at + 2] == "?":
                raise _Unknown
            inner, at = _branches(keyword, at + 1)
            if at == len(keyword):
                raise _Unknown
        elif letter == "[":
            at = _class_end(keyword, at)
        elif letter == "\\":
            at += 1
            plain = keyword[at:at + 1]
            if not plain or plain.isalnum():
                if plain not in tuple("dDwWsSbB"):
                    raise _Unknown
                plain = None
        elif letter in "*+?{":
            raise _Unknown
        elif letter not in ".^$":
            plain = letter
        at, least = _quantifier(keyword, at + 1)
        if plain is not None and least == 1:
            run += plain.translate(_LOWER)
            continue
        if plain is not None and least > 1:
            run += plain.translate(_LOWER)
        run = close()
        if inner is not None and least and len(found) * len(inner) <= MOST_BRANCHES:
            found = [[*before, *after] for before in found for after in inner]
    close()
    return found, at


def _class_end(keyword: str, at: int) -> int:
    """The bracket that closes a plain character class."""
    first = at + 1 + (keyword[at + 1:at + 2] == "^")
    end = keyword.find("]", first)
    if end <= first or any(text in keyword[first:end] for text in ("[", "\\", "&&")):
        raise _Unknown
    return end


def _quantifier(keyword: str, at: int) -> tuple[int, int]:
    """Where the next item begins, and how often this one is there at least: never, once, or more (2)."""
    sign = keyword[at:at + 1]
    if not sign or sign not in "*+?{":
        return at, 1
    if sign == "{":
        end = keyword.find("}", at)
        least = keyword[at + 1:max(end, 0)].split(",")[0]
        if not (least.isascii() and least.isdigit()):
            raise _Unknown
        at, least = end, min(int(least), 1) * 2
    else:
        least = 2 if sign == "+" else 0
    at += 1
    return at + (keyword[at:at + 1] in ("?", "+")), least


def trigrams(texts: DataFrame) -> DataFrame:
    """All three letters in a row of ``text``, A-Z in lower case, as ``id`` beside the other columns; NULL where there are none.

    A row for each place and plain substrings: lambdas over arrays of letters are interpreted and took ten times as long.
    """
    rest = [name for name in texts.columns if name != "text"]
    lower = texts.withColumn("text", F.translate("text", ascii_uppercase, ascii_lowercase))
    for step, length in ((PIECE, PIECE + LENGTH - 1), (1, LENGTH)):
        last = F.greatest(F.length("text") - LENGTH + 1, F.lit(1))
        placed = lower.select(*rest, "text", F.explode_outer(F.sequence(F.lit(1), last, F.lit(step))).alias("place"))
        lower = placed.select(*rest, F.substring("text", F.col("place"), F.lit(length)).alias("text"))
    return lower.select(*rest, F.when(F.length("text") == LENGTH, F.col("text")).alias("id"))


def text_filters(rows: DataFrame, string_only: bool = False, null_text: str | None = None, blocks: int = BLOCKS) -> DataFrame:
    """(path, block, word) of the files that ``rows`` are read from; a file without text has one empty word."""
    text = row_text(rows, string_only, null_text)
    texts = rows.select(own_path().alias("path"), (F.lit(None).cast("string") if text is None else text).alias("text"))
    return filters_of(trigrams(texts), blocks)


def update_text_index(spark: SparkSession, index: str, folder: str, read: Callable[[list[str]], DataFrame],
                      string_only: bool = False, null_text: str | None = None, pattern: str | None = None,
                      blocks: int = BLOCKS) -> list[str]:
    """Index the files of ``folder`` that are not in ``index`` yet, and return them; see ``file_index.update_index``."""
    return update_index(
        spark, index, folder, read, pattern=pattern, make=lambda rows: text_filters(rows, string_only, null_text, blocks))


def matching_files(index: DataFrame, keyword: str, blocks: int = BLOCKS) -> list[str]:
    """The indexed files that may hold a match."""
    branches = required_texts(keyword) if keyword else None
    if branches is None:
        hits = index
    else:
        needed = [sorted({text[i:i + LENGTH] for text in branch for i in range(len(text) - LENGTH + 1)}) for branch in branches]
        wanted = index.sparkSession.createDataFrame(
            [(number, len(three), text) for number, three in enumerate(needed) for text in three], "branch int, needed int, id string")
        wanted = wanted.select("branch", "needed", "id", block_of(F.col("id"), blocks).alias("block"), bits_of(F.col("id")).alias("bits"))
        # A file that was indexed twice has each word twice.
        hits = index.join(wanted, "block").where(F.col("word").bitwiseAND(F.col("bits")) == F.col("bits")).groupBy(
            "path", "branch", "needed").agg(F.count_distinct("id").alias("there")).where("there = needed")
    return [row.path for row in hits.select("path").distinct().orderBy("path").collect()]


def search_files(spark: SparkSession, index: str, folder: str, read: Callable[[list[str]], DataFrame], keyword: str,
                 string_only: bool = False, null_text: str | None = None, pattern: str | None = None,
                 blocks: int = BLOCKS) -> DataFrame:
    """``search_rows`` over all files of ``folder``, reading those that may hold a match and those not indexed yet.

    ``string_only``, ``null_text`` and ``blocks`` must be those of the index.
    ``read`` of no files must give an empty frame.
    """
    files = matching_files(read_index(spark, index), keyword, blocks) + new_files(spark, index, folder, pattern)
    return search_rows(read(files), keyword, string_only, null_text)
