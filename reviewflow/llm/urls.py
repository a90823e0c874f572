"""URL filter: a blocked Bloom filter in front of an exact join, and rules by host and path.

Built-in functions only; nothing here runs Python on the executors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewflow.llm.tables import ascii_lower

# Blocks of 64 bits: 65,536 blocks are 0.5 MB of bits, whatever the list's length.
# A longer list only lets more addresses through to the exact join.
BLOOM_BLOCKS = 1 << 16
BLOOM_BITS = 4

# (host, path, verdict): a rule fits its host and all subdomains when the path starts with the rule's.
RULES = (
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
)


def _rest(url: Column) -> Column:
    """What follows the first ://, else null."""
    place = F.instr(url, "://")
    return F.when(place > 0, F.substring(url, place + 3, F.length(url)))


def host_of(url: Column) -> Column:
    """From the first :// up to /, ?, # or the end, A-Z in lower case; empty without ://."""
    return ascii_lower(F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*", 0), F.lit("")))


def path_of(url: Column) -> Column:
    """From the end of the host up to ?, # or the end; empty without ://."""
    return F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical(url: Column) -> Column:
    """Host without www. or m., path without closing slashes, query without the fragment; the scheme does not count."""
    host = F.regexp_replace(host_of(url), r"^(www|m)\.", "")
    path = F.regexp_replace(path_of(url), r"/+$", "")
    query = F.coalesce(F.regexp_extract(_rest(url), r"^[^?#]*(\?[^#]*)", 1), F.lit(""))
    return F.concat(host, path, query)


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits and its verdict, else nulls."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule_host, rule_path, rule_verdict in sorted(rules, key=lambda r: (len(r[0]) + len(r[1]), r)):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        rule = F.when(fits, rule_host + rule_path).otherwise(rule)
        verdict = F.when(fits, rule_verdict).otherwise(verdict)
    return rule, verdict


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(1)), F.lit(blocks))


def _bits(key: Column, bits: int) -> Column:
    """A 64-bit word with the bits of a key: six bits of a second hash choose each."""
    digest, word = F.xxhash64(key, F.lit(2)), F.lit(0).cast("long")
    one = F.lit(1).cast("long")
    for number in range(bits):
        place = F.shiftrightunsigned(digest, 6 * number).bitwiseAND(F.lit(63)).cast("int")
        word = word.bitwiseOR(F.call_function("shiftleft", one, place))
    return word


def bloom_filter(listed: DataFrame, key: str, blocks: int = BLOOM_BLOCKS, bits: int = BLOOM_BITS) -> DataFrame:
    """One row (block, word) for each block in use; at most ``blocks`` rows of 16 bytes."""
    column = F.col(key)
    return listed.groupBy(_block(column, blocks).alias("block")).agg(F.bit_or(_bits(column, bits)).alias("word"))


def bloom_passes(df: DataFrame, key: str, bloom: DataFrame, blocks: int = BLOOM_BLOCKS, bits: int = BLOOM_BITS) -> DataFrame:
    """The rows whose key may be in the filter, which is broadcast: it is bounded by its blocks."""
    mask = _bits(F.col(key), bits)
    rows = df.withColumn("_block", _block(F.col(key), blocks)).join(F.broadcast(bloom.withColumnRenamed("block", "_block")), "_block")
    return rows.where(F.col("word").bitwiseAND(mask) == mask).select(*df.columns)


def bloom_flag(df: DataFrame, key: str, bloom: DataFrame, flag: str, blocks: int = BLOOM_BLOCKS, bits: int = BLOOM_BITS) -> DataFrame:
    """Add ``flag``: whether the key may be in the filter. Columns named ``flag`` and more are used on the way."""
    block, word = f"{flag}_block", f"{flag}_word"
    found = df.withColumn(block, _block(F.col(key), blocks)).join(
        F.broadcast(bloom.select(F.col("block").alias(block), F.col("word").alias(word))), block, "left")
    mask = _bits(F.col(key), bits)
    return found.withColumn(flag, F.coalesce(F.col(word).bitwiseAND(mask) == mask, F.lit(False))).drop(block, word)


def listed_pages(pages: DataFrame, listed: DataFrame, blocks: int = BLOOM_BLOCKS, bits: int = BLOOM_BITS) -> DataFrame:
    """Add ``canonical`` and ``listed``: whether the canonical address is in ``listed.canonical``.

    The filter, bounded by its blocks, is broadcast; only addresses that pass
    it are shuffled to the exact join, which removes false positives.
    """
    names = distinct_keys(listed)
    probe = pages.withColumn("canonical", canonical(F.col("url")))
    probe = probe.withColumn("block", _block(F.col("canonical"), blocks))
    passed = probe.join(F.broadcast(bloom_filter(names, "canonical", blocks, bits)), "block", "left")
    mask = _bits(F.col("canonical"), bits)
    passed = passed.withColumn("possible", F.coalesce(F.col("word").bitwiseAND(mask) == mask, F.lit(False))).drop("block", "word")
    exact = names.withColumn("listed", F.lit(True)).hint("shuffle_hash")
    hits = passed.where("possible").join(exact, "canonical", "left").withColumn("listed", F.coalesce("listed", F.lit(False)))
    misses = passed.where("NOT possible").withColumn("listed", F.lit(False))
    return hits.unionByName(misses).drop("possible")


def distinct_keys(listed: DataFrame) -> DataFrame:
    return listed.where("canonical IS NOT NULL AND canonical <> ''").select("canonical").distinct()


def judge_pages(pages: DataFrame, listed: DataFrame, rules=RULES, blocks: int = BLOOM_BLOCKS) -> DataFrame:
    """Verdict on each page's address.

    Takes page_id and url; ``listed`` has a column ``canonical`` of addresses to
    block. The longest rule that fits decides; without one a listed address is
    blocked and any other allowed.

    Returns one row per row: page_id, host, path, canonical, rule, verdict. A
    null url or one without :// has an empty host and path, no rule and is
    allowed. Repeated rows are judged alike. An empty list blocks nothing.
    """
    pages = pages.select("page_id", "url")
    found = listed_pages(pages, listed, blocks).withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    method = F.when(F.col("listed"), "block").otherwise("allow")
    return found.select("page_id", "host", "path", "canonical", rule.alias("rule"), F.coalesce(verdict, method).alias("verdict"))
