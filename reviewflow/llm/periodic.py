"""Runs of repeated words inside documents, by an enhanced suffix array.

A run of period q is a stretch whose words equal those q places further on, as
long as it can be made. At its right end stands exactly one branching tandem: a
word string w of length q, twice in a row, after which the text does not go on
like w. Both copies start suffixes whose common prefix is w and no more, so
they lie in one LCP interval of depth q, in two of its children. For every
interval the suffixes of all children but the largest are tested: suffix i
gives a tandem when the suffix at i + depth or i - depth lies in the interval
too, which the inverse suffix array tells. Rotating a tandem to the left gives
its run. There is no tree: intervals and children are found for all places at
once, by descending tables of range minima over the LCP values.

A run of exponent E holds E copies of w, so an interval of fewer than E
suffixes cannot end one. Suffixes that share a prefix with fewer than E - 1
others are therefore left unsorted among themselves; the LCP values between
them may be too large, which never joins more than these few suffixes.

Many documents are worked on at once; a word of one document never equals a
word of another.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewflow.llm.text import chunks, row_numbers, split_words, text_column, word_codes

MIN_LENGTH = 6
MIN_EXPONENT = 4
# Bytes of text handled at a time inside a task; a single longer text is handled alone.
CHUNK = 1 << 20


def _sorted_suffixes(codes: np.ndarray, rows: np.ndarray, ends: np.ndarray, least: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Suffix array by prefix doubling, and the ranks by the first 1, 2, 4, ... words.

    Ranks are places in the suffix array, the same for suffixes that agree.
    Groups of fewer than ``least`` suffixes are not sorted any further.
    """
    n = len(codes)
    keys = rows.astype(np.int64) << 32 | codes
    order = np.argsort(keys, kind="stable")
    rank = np.empty(n, np.int32)
    active, ordered = np.arange(n), keys[order]
    levels, width = [], 1
    while True:
        heads = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
        sizes = np.diff(np.append(heads, len(active)))
        rank[order[active]] = np.repeat(active[heads], sizes)
        levels.append(rank.copy())
        active = active[np.repeat(sizes >= least, sizes)]
        if not len(active):
            return order, levels
        suffixes = order[active]
        beyond = suffixes + width
        following = np.where(beyond < ends[suffixes], rank[np.minimum(beyond, n - 1)], -1)
        ordered = rank[suffixes].astype(np.int64) * (n + 1) + following + 1
        again = np.argsort(ordered, kind="stable")
        order[active], ordered = suffixes[again], ordered[again]
        width *= 2


def _common_prefixes(left: np.ndarray, right: np.ndarray, ends: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
    """How many words the suffixes at ``left`` and ``right``, of one row, have in common."""
    n, common = len(ends), np.zeros(len(left), np.int32)
    stop = ends[left]
    for level in range(len(levels) - 1, -1, -1):
        a, b = left + common, right + common
        same = (levels[level][np.minimum(a, n - 1)] == levels[level][np.minimum(b, n - 1)]) & (np.maximum(a, b) < stop)
        common[same] += 1 << level
    return common


class _Minima:
    """Tables of range minima of values, and how far from a place all values reach a bound."""

    def __init__(self, values: np.ndarray, widest: int) -> None:
        self.n = len(values)
        self.tables = [values]
        while (1 << len(self.tables)) <= widest:
            table, step = self.tables[-1], 1 << len(self.tables) - 1
            self.tables.append(np.minimum(table, np.concatenate([table[step:], np.zeros(min(step, self.n), table.dtype)])))

    def after(self, places: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """The last place from which back to ``places``, itself left out, no value is below the bound."""
        at = places.copy()
        for level in range(len(self.tables) - 1, -1, -1):
            inside = at + 1 < self.n
            reach = np.where(inside, self.tables[level][np.minimum(at + 1, self.n - 1)], 0)
            at[reach >= bounds] += 1 << level
        return at

    def before(self, places: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """The first place from which on to ``places``, itself left out, no value is below the bound."""
        at = places.copy()
        for level in range(len(self.tables) - 1, -1, -1):
            start = at - (1 << level)
            reach = np.where(start >= 0, self.tables[level][np.maximum(start, 0)], 0)
            at[reach >= bounds] -= 1 << level
        return at


def _small_children(lcp: np.ndarray, widest: int, limits: np.ndarray, least: int) -> tuple[np.ndarray, ...]:
    """The children of all LCP intervals but each interval's largest: (first, last, depth, interval first, interval last)."""
    bounds = np.flatnonzero((lcp > 0) & (lcp <= limits))
    minima = _Minima(lcp, widest)
    depth = lcp[bounds]
    first = minima.before(bounds, depth) - 1
    last = minima.after(bounds, depth)
    wide = last - first + 1 >= least
    bounds, depth, first, last = bounds[wide], depth[wide], first[wide], last[wide]
    # Each bound opens a child; the child before an interval's first bound starts with the interval.
    order = np.lexsort((bounds, last, first))
    bounds, depth, first, last = bounds[order], depth[order], first[order], last[order]
    opening = np.concatenate([[True], (first[1:] != first[:-1]) | (last[1:] != last[:-1])]) if len(bounds) else np.zeros(0, bool)
    number = np.cumsum(opening) - 1
    child_last = np.append(bounds[1:] - 1, 0)[:len(bounds)]
    closing = np.append(opening[1:], True)[:len(bounds)]
    child_last[closing] = last[closing]
    heads = np.flatnonzero(opening)
    starts = np.concatenate([first[heads], bounds])
    stops = np.concatenate([bounds[heads] - 1, child_last])
    number = np.concatenate([number[heads], number])
    depth, first, last = (np.concatenate([part[heads], part]) for part in (depth, first, last))
    by_size = np.lexsort((stops - starts, number))
    largest = np.zeros(len(number), bool)
    if len(number):
        largest[by_size[np.append(np.flatnonzero(np.diff(number[by_size])), len(number) - 1)]] = True
    return tuple(part[~largest] for part in (starts, stops, depth, first, last))


def _spread(starts: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All places of the ranges, and the range of each."""
    sizes = stops - starts + 1
    which = np.repeat(np.arange(len(starts)), sizes)
    return np.arange(len(which)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + starts[which], which


def _branching_tandems(codes: np.ndarray, rows: np.ndarray, starts: np.ndarray, ends: np.ndarray, exponent: int) -> tuple[np.ndarray, np.ndarray]:
    """(start, period) of the branching tandems before which the text repeats the period ``exponent`` - 2 times more."""
    order, levels = _sorted_suffixes(codes, rows, ends, exponent)
    # Only suffixes whose first word is frequent enough; they are groups next to each other.
    sizes = np.bincount(levels[0], minlength=len(codes))
    groups = levels[0][order]
    used = np.flatnonzero(sizes[groups] >= exponent)
    none = np.zeros(0, np.int64)
    if not len(used):
        return none, none
    suffixes, groups = order[used], groups[used]
    lcp = np.zeros(len(used), np.int32)
    inner = np.flatnonzero(groups[1:] == groups[:-1]) + 1
    lcp[inner] = _common_prefixes(suffixes[inner - 1], suffixes[inner], ends, levels)
    limits = (ends - starts)[suffixes] // exponent
    inverse = np.full(len(codes), -1, np.int64)
    inverse[suffixes] = np.arange(len(suffixes))
    child_first, child_last, depths, firsts, lasts = _small_children(lcp, int(sizes.max()), limits, exponent)
    found: list[np.ndarray] = []
    # So many suffixes are tested at a time that memory stays bounded.
    upto = np.cumsum(child_last - child_first + 1)
    cut = 0
    while cut < len(upto):
        stop = max(int(np.searchsorted(upto, (upto[cut - 1] if cut else 0) + (1 << 20), "right")), cut + 1)
        places, which = _spread(child_first[cut:stop], child_last[cut:stop])
        which += cut
        at, depth, first, last = suffixes[places], depths[which].astype(np.int64), firsts[which], lasts[which]
        low, high = starts[at], ends[at]

        def inside(positions: np.ndarray) -> np.ndarray:
            place = np.where((positions >= low) & (positions < high), inverse[np.clip(positions, 0, len(codes) - 1)], -1)
            return np.where((place >= first) & (place <= last), place, -1)

        for step, start in ((depth, at), (-depth, at - depth)):
            other = inside(at + step)
            good = (other >= 0) & ((other < child_first[which]) | (other > child_last[which]))
            for copies in range(1, exponent - 1):
                good &= inside(start - copies * depth) >= 0
            found.append(np.stack([start[good], depth[good]]))
        cut = stop
    if not found:
        return none, none
    pairs = np.unique(np.concatenate(found, axis=1), axis=1)
    return pairs[0], pairs[1]


def _rotated(codes: np.ndarray, start: int, period: int, low: int) -> int:
    """How far left a tandem can be rotated."""
    block = 32
    while start > low:
        stop = max(low, start - block)
        differ = np.flatnonzero(codes[stop:start] != codes[stop + period:start + period])
        if len(differ):
            return stop + int(differ[-1]) + 1
        start, block = stop, block * 2
    return start


def find_periods(codes: np.ndarray, bounds: np.ndarray, min_length: int = MIN_LENGTH, exponent: int = MIN_EXPONENT) -> np.ndarray:
    """All runs of rows of word numbers: columns row, start, length, period; by row, start, period."""
    found: list[tuple[int, int, int, int]] = []
    if len(codes):
        rows = row_numbers(bounds)
        lengths = np.diff(bounds)
        starts, ends = np.repeat(bounds[:-1], lengths), np.repeat(bounds[1:], lengths)
        begin, period = _branching_tandems(codes, rows, starts, ends, exponent)
        order = np.lexsort((period, begin + 2 * period))
        last_end, same_end = -1, []
        for at, width in zip(begin[order].tolist(), period[order].tolist()):
            end = at + 2 * width
            if end != last_end:
                last_end, same_end = end, []
            # A power of a shorter period is that period's run.
            if any(width % shorter == 0 and at >= first for first, shorter in same_end):
                continue
            low = int(starts[at])
            first = _rotated(codes, at, width, low)
            same_end.append((first, width))
            if end - first >= max(min_length, exponent * width):
                found.append((int(rows[at]), first - low, end - first, width))
    found.sort(key=lambda run: (run[0], run[1], run[3]))
    return np.array(found, np.int64).reshape(-1, 4)


def _collapsed(words: pa.Array, bounds: np.ndarray, runs: np.ndarray) -> pa.Array:
    """The words of each row joined by blanks, without those that a run repeats after its first period."""
    depth = np.zeros(len(words) + 1, np.int64)
    begin = bounds[runs[:, 0]] + runs[:, 1]
    np.add.at(depth, begin + runs[:, 3], 1)
    np.add.at(depth, begin + runs[:, 2], -1)
    keep = np.cumsum(depth[:-1]) == 0
    kept = np.concatenate([[0], np.cumsum(keep)])[bounds]
    if not keep.all():
        words = words.filter(pa.array(keep))
    return pc.binary_join(pa.LargeListArray.from_arrays(pa.array(kept, pa.int64()), words.cast(pa.large_string())), pa.scalar(" ", pa.large_string()))


def _search(min_length: int, exponent: int):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = text_column(batch)
            for start, end in chunks(column, CHUNK):
                words, bounds = split_words(column.slice(start, end - start))
                codes, _ = word_codes(words)
                runs = find_periods(codes, bounds, min_length, exponent)
                lists = pa.ListArray.from_arrays(
                    pa.array(np.searchsorted(runs[:, 0], np.arange(end - start + 1)), pa.int32()),
                    pa.StructArray.from_arrays([pa.array(runs[:, k]) for k in (1, 2, 3)], ["start", "length", "period"]))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(start, end - start), pa.array(np.diff(bounds)), lists,
                     _collapsed(words, bounds, runs).cast(pa.string())], ["doc_id", "n_words", "runs", "collapsed"])
    return search


def find_runs(docs: DataFrame, min_length: int = MIN_LENGTH, exponent: int = MIN_EXPONENT) -> DataFrame:
    """Runs of repeated words, and each text without the repetitions.

    Takes doc_id and text; other columns, whatever their names, are not looked
    at. Words are cut at ASCII white space and compared as they are. A run is a
    stretch of words with smallest period ``period``, at least ``min_length``
    long and ``exponent`` (2 or more) times its period, that cannot be made
    longer on either side.

    Returns one row per row: doc_id, n_words, runs (start, length and period, by
    start, then period; overlapping runs of different periods all come),
    collapsed (the words joined by one blank, without those that any run holds
    after its first period). A null, empty or blank text has no words, no runs
    and an empty ``collapsed``; an empty table gives no rows; repeated rows and
    null ids are searched like any other. A text of any length is searched
    whole, in memory in proportion to its words times the logarithm of their number.
    """
    if exponent < 2:
        raise ValueError("a run holds its period twice at least")
    return docs.select("doc_id", "text").mapInArrow(
        _search(min_length, exponent),
        "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string")


def greatest_run(runs: str) -> F.Column:
    """The run with the greatest exact length / period of a column of runs; ties: smallest start, then period. Null for none."""
    return F.expr(f"""aggregate({runs}, cast(null AS struct<start:long,length:long,period:long>), (best, run) ->
        CASE WHEN best IS NULL OR run.length * best.period > best.length * run.period THEN run ELSE best END)""")


def plant_periods(docs: DataFrame) -> DataFrame:
    """``docs`` with text made periodic in a tenth of the rows, from a word on that the crc32 of the id determines.

    With h the crc32 of the decimal doc_id and g = h div 10, a text of n > 0
    words whose h is divisible by ten repeats, from word a = g % n on, its next
    1 + (n - a) div (3 + g % 8) words. Other texts, and those without an id, stay.
    """
    h = "crc32(cast(cast(doc_id AS string) AS binary))"
    planted = f"""transform(array(regexp_extract_all(text, '([^\\\\x20\\\\x09-\\\\x0D]+)', 1)), w -> CASE WHEN size(w) = 0 THEN text ELSE
        array_join(transform(w, (word, i) -> CASE WHEN i < ({h} div 10) % size(w) THEN word ELSE w[cast(
            ({h} div 10) % size(w) + (i - ({h} div 10) % size(w)) % (1 + (size(w) - ({h} div 10) % size(w)) div (3 + ({h} div 10) % 8)) AS int)]
        END), ' ') END)[0]"""
    return docs.withColumn("text", F.expr(f"CASE WHEN {h} % 10 = 0 THEN {planted} ELSE text END"))
