"""Bits of a blocked Bloom filter: each key sets some bits of one 64-bit word."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

KEY_BITS = 5


def block_of(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(F.lit("block"), key), F.lit(blocks)).cast("int")


def bits_of(key: Column) -> Column:
    """Six bits of a second hash name each bit of the word."""
    digest = F.xxhash64(F.lit("bits"), key)
    word = F.lit(0).cast("long")
    for number in range(KEY_BITS):
        place = F.shiftrightunsigned(digest, 6 * number).bitwiseAND(F.lit(63)).cast("int")
        word = word.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), place))
    return word
