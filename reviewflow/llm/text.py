"""Vectorised text helpers that run inside tasks, on Arrow columns.

Words are maximal runs without the six ASCII white-space characters (blank and
x09 to x0D). UTF-8 never uses these bytes inside another character, so words
are cut on the bytes of a whole column at once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

WHITE_SPACE = b"\x20\x09\x0a\x0b\x0c\x0d"
WORD = r"[^\x20\x09-\x0D]+"

# Bytes of text handled at a time inside a task; a single longer text is handled alone.
CHUNK_BYTES = 4 << 20

_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[list(WHITE_SPACE)] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def text_column(batch: pa.RecordBatch, name: str = "text") -> pa.Array:
    """The column as large_string; a null text is an empty one."""
    return pc.fill_null(batch.column(name).cast(pa.large_string()), "")


def layout(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a large_string or large_binary column, and where each row starts (n + 1 values, from 0)."""
    _, offsets, data = column.buffers()
    places = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8)
    if not len(column) or places[-1] == places[0]:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[places[0]:places[-1]], places - places[0]


def chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes, or of one row."""
    _, places = layout(column)
    start = 0
    while start < len(column):
        end = int(np.searchsorted(places, places[start] + limit, "right")) - 1
        end = min(max(end, start + 1), len(column))
        yield start, end
        start = end


def split_words(column: pa.Array, lower: bool = False) -> tuple[pa.Array, np.ndarray]:
    """All words of a column as one binary array, and the first word of each row (n + 1 values)."""
    data, places = layout(column)
    if not len(data):
        return pa.array([], pa.large_binary()), np.zeros(len(places), np.int64)
    inside = ~_IS_SPACE[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    rows = places[:-1][places[:-1] < len(data)]
    first[rows] |= inside[rows]
    starts = np.flatnonzero(first)
    letters = data[inside]
    if lower:
        letters = _LOWER[letters]
    kept = np.cumsum(inside)
    word_places = np.empty(len(starts) + 1, np.int64)
    word_places[:-1] = kept[starts] - 1
    word_places[-1] = len(letters)
    words = pa.Array.from_buffers(
        pa.large_binary(), len(starts), [None, pa.py_buffer(word_places), pa.py_buffer(np.ascontiguousarray(letters))])
    return words, np.searchsorted(starts, places)


def word_codes(words: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """A number for each word, and the distinct words in order of these numbers."""
    encoded = words.dictionary_encode()
    return encoded.indices.to_numpy(zero_copy_only=False), encoded.dictionary


def word_hashes(distinct: pa.Array) -> np.ndarray:
    """64-bit hash of each word."""
    digest = xxhash.xxh3_64_intdigest
    return np.fromiter((digest(word) for word in distinct.to_pylist()), np.uint64, len(distinct))


def mix(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly, one to one."""
    values = values ^ (values >> np.uint64(33))
    values = values * np.uint64(0xFF51AFD7ED558CCD)
    values = values ^ (values >> np.uint64(33))
    values = values * np.uint64(0xC4CEB9FE1A85EC53)
    return values ^ (values >> np.uint64(33))


def word_counts(column: pa.Array) -> np.ndarray:
    """Number of words of each row, without building them."""
    counts = [np.zeros(0, np.int64)]
    for start, end in chunks(column):
        data, places = layout(column.slice(start, end - start))
        inside = ~_IS_SPACE[data]
        first = inside.copy()
        first[1:] &= ~inside[:-1]
        rows = places[:-1][places[:-1] < len(data)]
        first[rows] |= inside[rows]
        counts.append(np.diff(np.searchsorted(np.flatnonzero(first), places)))
    return np.concatenate(counts)


def row_sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of the values of each row; ``bounds`` has the first value of each row (n + 1 values)."""
    total = np.concatenate([np.zeros(1, values.dtype if values.dtype.kind == "f" else np.int64), np.cumsum(values)])
    return total[bounds[1:]] - total[bounds[:-1]]


def row_numbers(bounds: np.ndarray) -> np.ndarray:
    """The row of each value."""
    return np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
