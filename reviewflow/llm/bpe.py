"""Byte-level BPE encoding and decoding.

A text is cut into pieces by the pattern of the vocabulary's own tokenizer, and
each piece is encoded on its own: the neighbouring pair with the lowest rank is
joined, the leftmost first, until no pair has a rank. Pieces repeat, so only
distinct ones are encoded.

The most frequent distinct words are encoded by Spark's higher-order functions,
as a fold over their bytes with the ranks as a scalar subquery; the README tells why
the others are not. Those are encoded by the same merges in numpy, all distinct
words of a block of text at once.
"""

from __future__ import annotations

import base64
import heapq
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewflow.llm.tables import saved
from reviewflow.session import let_go
from reviewflow.llm.text import chunks, layout, text_column, word_codes

# Distinct words whose encoding is folded in Spark and sent to all tasks (about 0.5 MB).
FOLDED_WORDS = 1 << 14
# Longer pieces (in bytes) are merged one at a time, with a heap.
WIDEST = 64
# The ranks are in so many small maps, by a hash of the token: Spark searches a map from its start.
RANK_MAPS = 1 << 16
NO_RANK = 1 << 30
HELD_WORDS = 60_000
# Bytes of text or ids handled at a time; a single longer row is handled alone.
CHUNK = 1 << 20

_SPACE, _LETTER, _NUMBER, _OTHER = 0, 1, 2, 3
# White space as Unicode defines it.
_SPACES = "\t\n\x0b\x0c\r \x85\xa0                　"


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def character_classes() -> np.ndarray:
    """White space, letter, number or other, of each code point."""
    names = {"L": _LETTER, "N": _NUMBER}
    table = np.fromiter((names.get(unicodedata.category(chr(point))[0], _OTHER) for point in range(0x110000)), np.uint8, 0x110000)
    table[[ord(space) for space in _SPACES]] = _SPACE
    return table


def merge_table(ranks: dict[bytes, int]) -> dict:
    """Ranks of the pairs of tokens that join to a token, as plain data for the tasks."""
    pairs = {}
    for token, rank in ranks.items():
        for cut in range(1, len(token)):
            left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
            if left is not None and right is not None:
                pairs[left << 20 | right] = rank
    keys = np.array(sorted(pairs), np.int64)
    return {
        "byte_ids": np.array([ranks[bytes([value])] for value in range(256)], np.int64),
        "keys": keys, "ranks": np.array([pairs[key] for key in keys.tolist()], np.int64), "by_pair": pairs}


class Merges:
    """Ranked merges of many words at once."""

    def __init__(self, table: dict) -> None:
        self.byte_ids, self.keys, self.ranks, self.by_pair = (table[name] for name in ("byte_ids", "keys", "ranks", "by_pair"))
        every = np.arange(256)
        self.of_bytes = self.rank(np.repeat(self.byte_ids[every], 256), np.tile(self.byte_ids[every], 256)).reshape(256, 256)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left << 20 | right
        place = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[place] == key, self.ranks[place], NO_RANK)

    def encode_long(self, word: bytes) -> list[int]:
        """Joins by rank and place with a heap; for pieces of any length."""
        ids = self.byte_ids[np.frombuffer(word, np.uint8)].tolist()
        after, before = list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1))
        find = self.by_pair.get
        heap = [(rank, place) for place in range(len(ids) - 1) if (rank := find(ids[place] << 20 | ids[place + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            rank, place = heapq.heappop(heap)
            right = after[place]
            if ids[place] < 0 or right >= len(ids) or find(ids[place] << 20 | ids[right]) != rank:
                continue
            ids[place], ids[right] = rank, -1
            after[place] = after[right]
            if after[place] < len(ids):
                before[after[place]] = place
                if (new := find(rank << 20 | ids[after[place]])) is not None:
                    heapq.heappush(heap, (new, place))
            if before[place] >= 0 and (new := find(ids[before[place]] << 20 | rank)) is not None:
                heapq.heappush(heap, (new, before[place]))
        return [token for token in ids if token >= 0]

    def encode(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words on end, and where each word's start (n + 1 values)."""
        data, places = layout(words)
        lengths = np.diff(places)
        counts = np.zeros(len(words), np.int64)
        done: list[tuple[np.ndarray, np.ndarray]] = []
        least = 0
        for width in (8, 12, 16, 32, WIDEST):
            rows = np.flatnonzero((lengths > least) & (lengths <= width))
            least = width
            # Matrices of at most 2 MB, of which a round holds several.
            step = (1 << 18) // width
            for start in range(0, len(rows), step):
                part = rows[start:start + step]
                done.append((part, self._encode_matrix(data, places[part], lengths[part], width)))
        for row in np.flatnonzero(lengths > WIDEST):
            ids = np.array(self.encode_long(data[places[row]:places[row + 1]].tobytes()), np.int64)
            done.append((np.array([row]), ids[None, :]))
        for rows, ids in done:
            counts[rows] = (ids >= 0).sum(1)
        bounds = np.concatenate([[0], np.cumsum(counts)])
        flat = np.empty(bounds[-1], np.int64)
        for rows, ids in done:
            inside = ids >= 0
            flat[(bounds[rows][:, None] + np.arange(ids.shape[1]))[inside]] = ids[inside]
        return flat, bounds

    def _encode_matrix(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, width: int) -> np.ndarray:
        """One word a row; ids to the left, -1 beyond the end. Each round joins one pair of every unfinished word."""
        columns = np.arange(width)
        inside = columns < lengths[:, None]
        letters = data[np.minimum(starts[:, None] + columns, len(data) - 1)]
        ids = np.where(inside, self.byte_ids[letters], -1)
        ranks = np.full((len(starts), width), NO_RANK, np.int64)
        ranks[:, :-1] = np.where(inside[:, 1:], self.of_bytes[letters[:, :-1], letters[:, 1:]], NO_RANK)
        result = ids.copy()
        rows = np.arange(len(starts))
        while True:
            place = ranks.argmin(1)
            best = ranks[np.arange(len(rows)), place]
            going = best < NO_RANK
            if not going.all():
                result[rows[~going]] = ids[~going]
                ids, ranks, rows, place, best = ids[going], ranks[going], rows[going], place[going], best[going]
            if not len(rows):
                return result
            at = np.arange(len(rows))
            ids[at, place] = best
            source = columns + (columns > place[:, None])
            closed = source >= width
            source[closed] = width - 1
            ids = np.take_along_axis(ids, source, 1)
            ids[closed] = -1
            source = columns + (columns >= place[:, None])
            closed = source >= width
            source[closed] = width - 1
            ranks = np.take_along_axis(ranks, source, 1)
            ranks[closed] = NO_RANK
            right = ids[at, np.minimum(place + 1, width - 1)]
            ranks[at, place] = np.where((place + 1 < width) & (right >= 0), self.rank(best, np.maximum(right, 0)), NO_RANK)
            has_left = place > 0
            left = ids[at, np.maximum(place - 1, 0)]
            again = np.where(has_left, self.rank(left, best), ranks[at, place])
            ranks[at, np.maximum(place - 1, 0)] = again


def cut_pieces(column: pa.Array, classes: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """The pieces of all rows as one binary array, and the first piece of each row (n + 1 values).

    A piece is an English contraction, or a run of letters, of numbers or of
    other characters with the blank before it, or white space; the last white
    space before another run is a piece of its own unless it is a blank.
    """
    data, places = layout(column)
    if not len(data):
        return pa.array([], pa.large_binary()), np.zeros(len(places), np.int64)
    points = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
    byte_at = np.flatnonzero((data & 0xC0) != 0x80)
    rows = np.searchsorted(byte_at, places)
    kind = classes[points]
    opens = np.zeros(len(points) + 1, bool)
    opens[rows] = True
    first = opens[:-1].copy()
    starts = first.copy()
    starts[1:] |= kind[1:] != kind[:-1]
    run = np.flatnonzero((kind[1:] != _SPACE) & (kind[:-1] == _SPACE) & ~first[1:]) + 1
    starts[run - 1] = True
    starts[run] = points[run - 1] != 32
    quotes = np.flatnonzero((points == 39) & starts)
    row_end = np.append(rows[1:], len(points))
    last = row_end[np.searchsorted(rows[:-1], quotes, "right") - 1] if len(quotes) else quotes
    text = [points, np.append(points[1:], 0), np.append(points[2:], [0, 0])[:len(points)]]
    one = np.isin(text[1][quotes], [ord(c) for c in "stmd"]) & (quotes + 1 < last)
    two = np.zeros(len(quotes), bool)
    for a, b in ("re", "ve", "ll"):
        two |= (text[1][quotes] == ord(a)) & (text[2][quotes] == ord(b))
    two &= quotes + 2 < last
    for found, length in ((quotes[one], 2), (quotes[two], 3)):
        limit = last[one] if length == 2 else last[two]
        starts[found + 1] = False
        more = found + length
        more = more[(more < limit)]
        more = more[kind[more] == _LETTER]
        starts[more] = True
    begins = np.flatnonzero(starts)
    piece_places = np.append(byte_at[begins], len(data)).astype(np.int64)
    pieces = pa.Array.from_buffers(pa.large_binary(), len(begins), [None, pa.py_buffer(piece_places), pa.py_buffer(np.ascontiguousarray(data))])
    return pieces, np.searchsorted(begins, rows)


def _count_words(classes):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, int] = {}
        for batch in batches:
            column = text_column(batch)
            for start, end in chunks(column, CHUNK):
                codes, distinct = word_codes(cut_pieces(column.slice(start, end - start), classes.value)[0])
                for word, n in zip(distinct.to_pylist(), np.bincount(codes, minlength=len(distinct)).tolist()):
                    held[word] = held.get(word, 0) + n
                if len(held) > HELD_WORDS:
                    yield pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.binary()), pa.array(held.values(), pa.int64())], ["word", "n"])
                    held = {}
            pa.default_memory_pool().release_unused()
        yield pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.binary()), pa.array(held.values(), pa.int64())], ["word", "n"])
    return count


def fold_words(words: DataFrame, ranks: dict[bytes, int]) -> DataFrame:
    """Add ``ids`` to the distinct words of a frame, by Spark's higher-order functions only.

    A word is an array of hexadecimal pieces, at first its bytes. The fold takes
    as many steps as the word has bytes; a step looks up the rank of each
    neighbouring pair and joins the leftmost with the lowest.
    """
    maps: list[dict[str, int]] = [{} for _ in range(RANK_MAPS)]
    for token, rank in ranks.items():
        name = token.hex().upper()
        maps[zlib.crc32(name.encode()) % RANK_MAPS][name] = rank
    # One row that the plan only refers to: as a literal, megabytes would stand in each text of a plan that the driver keeps.
    one = pa.array([[list(ranks_of.items()) for ranks_of in maps]], pa.list_(pa.map_(pa.string(), pa.int32())))
    table = words.sparkSession.createDataFrame(pa.table({"ranks": one}))
    rows = words.select("word", F.hex("word").alias("letters"), table.scalar().alias("ranks"))

    def rank(name: str) -> str:
        return f"try_element_at(ranks[cast(crc32(cast({name} as binary)) % {RANK_MAPS} as int)], {name})"

    steps = "greatest(length(letters) div 2, 1)"
    pair = rank("concat(parts[i - 1], parts[i])")
    joined = """CASE WHEN best >= {none} THEN parts ELSE concat(
        slice(parts, 1, place - 1), array(concat(parts[place - 1], parts[place])), slice(parts, place + 2, size(parts))) END"""
    joined = joined.format(none=NO_RANK).replace("best", "array_min(found)").replace(
        "place", "cast(array_position(found, array_min(found)) as int)")
    step = f"""CASE WHEN size(parts) < 2 THEN parts ELSE aggregate(
        array(transform(sequence(1, size(parts) - 1), i -> coalesce({pair}, {NO_RANK}))), parts, (parts, found) -> {joined}) END"""
    folded = f"""aggregate(sequence(1, {steps}), transform(sequence(1, {steps}), i -> substring(letters, 2 * i - 1, 2)),
        (parts, step) -> {step}, parts -> transform(parts, part -> {rank("part")}))"""
    return rows.select("word", F.expr(folded).alias("ids"))


def frequent_words(docs: DataFrame, ranks: dict[bytes, int], classes, limit: int = FOLDED_WORDS) -> dict[bytes, list[int]]:
    """Ids of the most frequent words; bounded by ``limit``."""
    counts = docs.select("text").mapInArrow(_count_words(classes), "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
    let_go(docs.sparkSession)
    words = saved(counts.where(f"length(word) BETWEEN 1 AND {WIDEST}").orderBy(F.desc("n"), "word").limit(limit).select("word"), "words")
    found = fold_words(words.repartition("word"), ranks).toArrow()
    let_go(docs.sparkSession)
    return dict(zip(found.column("word").to_pylist(), found.column("ids").to_pylist()))


def _encode(shared):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes, table, folded = shared.value
        merges = Merges(table)
        for batch in batches:
            column = text_column(batch)
            for start, end in chunks(column, CHUNK):
                pieces, rows = cut_pieces(column.slice(start, end - start), classes)
                codes, distinct = word_codes(pieces)
                known = [folded.get(word) for word in distinct.to_pylist()]
                new = np.array([ids is None for ids in known], bool)
                flat, bounds = merges.encode(distinct.filter(pa.array(new)))
                lengths = np.array([0 if ids is None else len(ids) for ids in known], np.int64)
                lengths[new] = np.diff(bounds)
                begin = np.zeros(len(known), np.int64)
                begin[new] = bounds[:-1]
                begin[~new] = len(flat) + np.concatenate([[0], np.cumsum(lengths[~new])])[:-1]
                flat = np.concatenate([flat, np.array([i for ids in known if ids is not None for i in ids], np.int64)])
                each = lengths[codes]
                upto = np.concatenate([[0], np.cumsum(each)])
                ids = flat[np.repeat(begin[codes] - upto[:-1], each) + np.arange(upto[-1])].astype("<u4")
                places = (upto[rows] * 4).astype(np.int64)
                part = batch.slice(start, end - start)
                binary = pa.Array.from_buffers(pa.large_binary(), len(part), [None, pa.py_buffer(places), pa.py_buffer(ids)])
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(np.diff(upto[rows])), binary.cast(pa.binary())], ["doc_id", "n_tokens", "ids"])
    return encode


def _encoder(docs: DataFrame, path: str):
    """What the tasks need to encode: classes of characters, merges, and the ids of the folded words."""
    spark: SparkSession = docs.sparkSession
    ranks = load_ranks(path)
    classes = character_classes()
    folded = frequent_words(docs, ranks, spark.sparkContext.broadcast(classes))
    return spark.sparkContext.broadcast((classes, merge_table(ranks), folded))


def encode(docs: DataFrame, path: str) -> DataFrame:
    """Token ids of each text.

    Takes doc_id and text; ``path`` has a vocabulary, a base64 token and its
    rank on each line. Returns one row per row: doc_id, n_tokens, ids (32-bit
    little-endian integers on end). A null or empty text has no tokens. No
    special tokens: their names are ordinary text. Repeated rows and null ids
    are encoded like any other, an empty table gives no rows, and other columns,
    whatever their names, are not looked at. A very long text is encoded whole.
    """
    return docs.select("doc_id", "text").mapInArrow(_encode(_encoder(docs, path)), "doc_id long, n_tokens long, ids binary")


def _decode(pieces):
    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = pa.array(pieces.value, pa.large_binary())
        for batch in batches:
            column = batch.column("ids").cast(pa.large_binary())
            for start, end in chunks(column, CHUNK):
                data, places = layout(column.slice(start, end - start))
                found = words.take(pa.array(np.frombuffer(data.tobytes(), "<u4").astype(np.int64)))
                data, word_places = layout(found)
                text_places = word_places[places // 4].astype(np.int64)
                texts = pa.Array.from_buffers(
                    pa.large_binary(), end - start, [None, pa.py_buffer(text_places), pa.py_buffer(np.ascontiguousarray(data))])
                yield pa.RecordBatch.from_arrays(
                    [*batch.slice(start, end - start).columns, texts.cast(pa.binary())], [*batch.schema.names, "decoded"])
            pa.default_memory_pool().release_unused()
    return decode


def _pieces(path: str) -> list[bytes]:
    ranks = load_ranks(path)
    pieces = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        pieces[rank] = token
    return pieces


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """Add ``decoded``: the bytes of the pieces of ``ids`` (not null) on end."""
    schema = ", ".join(f"`{name}` {kind}" for name, kind in encoded.dtypes) + ", decoded binary"
    return encoded.mapInArrow(_decode(encoded.sparkSession.sparkContext.broadcast(_pieces(path))), schema)


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """``decode(encode(docs))`` in one pass: a task needs one Python worker instead of two with all tables."""
    encoding, decoding = _encode(_encoder(docs, path)), _decode(docs.sparkSession.sparkContext.broadcast(_pieces(path)))
    return docs.select("doc_id", "text").mapInArrow(
        lambda batches: decoding(encoding(batches)), "doc_id long, n_tokens long, ids binary, decoded binary")


def token_digests(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, and SHA-256 of the ids and of the decoded text, of each row of ``docs``; see ``encode``."""
    return round_trip(docs, path).select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
