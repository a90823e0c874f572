"""Quality rules from a document and from lines that many documents share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewflow.llm.rows import set_apart
from reviewflow.llm.tables import numbered, saved
from reviewflow.llm.text import (chunks, layout, row_numbers, row_sums, split_words, text_column,
                                 word_codes, word_hashes)

MIN_WORDS = 50
# A line is removed when it is in more different documents of a host than this
# number, and than this share of the host's documents.
LINE_DOCS = 50
LINE_SHARE = 0.01
# A document is depleted when more than this share of its words goes.
MAX_REMOVED = 0.5

# Bytes of text measured at a time; a single longer text is measured alone.
CHUNK = 1 << 20

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_MEASURED = ("row long, doc_id long, host string, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
             "n_repeat_words long, content long, lines array<struct<line:long,words:long>>")


def _keys(codes: np.ndarray, more: np.ndarray) -> np.ndarray:
    """A number for each distinct pair."""
    pairs = (codes.astype(np.int64) << 32) | more.astype(np.int64)
    return np.unique(pairs, return_inverse=True)[1]


def repeated_words(codes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Per row, the words in three-word windows that the row holds twice or more."""
    n = len(codes)
    if n < 3:
        return np.zeros(len(bounds) - 1, np.int64)
    rows = row_numbers(bounds)
    whole = rows[:-2] == rows[2:]
    at = np.flatnonzero(whole)
    windows = _keys(_keys(_keys(codes[at], codes[at + 1]), codes[at + 2]), rows[at])
    repeated = at[np.bincount(windows)[windows] > 1] if len(at) else at
    inside = np.zeros(n, np.int64)
    for shift in range(3):
        inside[repeated + shift] = 1
    return row_sums(inside, bounds)


def _normal_lines(lines: list[bytes]) -> pa.Array:
    """The lines with blanks made one, in lower case."""
    normal = pa.array([b" ".join(line.split()) for line in lines], pa.large_binary())
    return pc.utf8_lower(normal.cast(pa.large_string())).cast(pa.large_binary())


def _measure_chunk(rows: pa.Array, ids: pa.Array, hosts: pa.Array, column: pa.Array) -> pa.RecordBatch:
    n = len(column)
    data, places = layout(column)
    words, bounds = split_words(column)
    codes, _ = word_codes(words)
    continued = np.concatenate([[0], np.cumsum(layout(words)[0] >> 6 == 2, dtype=np.int32)])
    letters = layout(words)[1]
    points = np.diff(letters) - np.diff(continued[letters])
    symbols = np.concatenate([[0], np.cumsum(_SYMBOL[data], dtype=np.int32)])
    # Lines: cut at each \n and at the end of each row.
    cuts = np.flatnonzero(data == 10)
    n_lines = np.diff(np.searchsorted(cuts, places)) + 1
    starts = np.sort(np.concatenate([cuts + 1, places[:-1]]), kind="stable")
    line_bounds = np.concatenate([[0], np.cumsum(n_lines)])
    ends = np.empty_like(starts)
    ends[:-1] = starts[1:] - 1
    ends[line_bounds[1:] - 1] = places[1:]
    buffer = data.tobytes()
    lines, line_rows = [buffer[a:b] for a, b in zip(starts.tolist(), ends.tolist())], row_numbers(line_bounds)
    # Line breaks separate words, so each word is inside one line.
    per_line = np.array([len(line.split()) for line in lines], np.int64)
    used = np.flatnonzero(per_line > 0)
    exact = pa.array([lines[k] for k in used.tolist()], pa.large_binary())
    exact_codes, _ = word_codes(exact)
    first = np.unique(_keys(exact_codes, line_rows[used]), return_index=True)[1] if len(used) else used
    duplicated = np.ones(len(used), np.int64)
    duplicated[first] = 0
    duplicates = np.bincount(line_rows[used], duplicated, n).astype(np.int64)
    normal_codes, distinct = word_codes(_normal_lines([lines[k] for k in used.tolist()]))
    hashes = word_hashes(distinct).view(np.int64)
    pairs = _keys(line_rows[used], normal_codes) if len(used) else used
    _, head, where = np.unique(pairs, return_index=True, return_inverse=True) if len(used) else (used, used, used)
    line_words = np.bincount(where, per_line[used], len(head)).astype(np.int64)
    order = np.argsort(line_rows[used][head], kind="stable")
    list_bounds = np.searchsorted(line_rows[used][head][order], np.arange(n + 1)).astype(np.int32)
    entries = pa.StructArray.from_arrays(
        [pa.array(hashes[normal_codes[head][order]] if len(used) else [], pa.int64()), pa.array(line_words[order])], ["line", "words"])
    digest = xxhash.xxh3_64_intdigest
    content = np.fromiter((digest(buffer[a:b]) for a, b in zip(places[:-1].tolist(), places[1:].tolist())), np.uint64, n)
    return pa.RecordBatch.from_arrays([
        rows, ids, hosts, pa.array(np.diff(bounds)), pa.array(row_sums(points, bounds)),
        pa.array(symbols[places[1:]] - symbols[places[:-1]]), pa.array(duplicates),
        pa.array(repeated_words(codes, bounds)), pa.array(content.view(np.int64)),
        pa.ListArray.from_arrays(pa.array(list_bounds), entries)],
        ["row", "doc_id", "host", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "content", "lines"])


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        column = text_column(batch)
        for start, end in chunks(column, CHUNK):
            part = batch.slice(start, end - start)
            yield _measure_chunk(part.column("row"), part.column("doc_id"), part.column("host"), column.slice(start, end - start))


def judge(docs: DataFrame, host: str = "source", line_docs: int = LINE_DOCS, line_share: float = LINE_SHARE,
          max_removed: float = MAX_REMOVED, min_words: int = MIN_WORDS, row: str | None = None) -> DataFrame:
    """Measures and verdict of each document.

    Takes doc_id, text and the column ``host``. Lines (blanks made one, in
    lower case) are hashed; for each host and line the different documents are
    counted, copies with the same text as one, so that groups of copies, which
    deduplication handles, do not turn their lines into boilerplate. Lines
    beyond both limits are removed, and documents that lose more than
    ``max_removed`` of their words by this, or fall below ``min_words``, are rejected.

    Returns one row per row: doc_id, n_words, word_chars, n_symbols,
    n_dup_lines, n_repeat_words, removed_words, base_failed, kept. A null text
    is empty and fails; a null host is a host of its own; repeated rows are
    judged alike. ``row`` names a column of unique row numbers, which is passed
    on as ``row``, with ``gone_lines``: hashes of the removed lines, null for none.
    """
    number = F.col(row) if row else F.monotonically_increasing_id()
    texts = docs.select("doc_id", "text", F.col(host).alias("host"), number.alias("row"))
    measured = saved(texts.mapInArrow(_measure, _MEASURED), "measured")
    keyed = measured.withColumn("host", F.concat(F.when(F.col("host").isNull(), "-").otherwise("+"), F.coalesce("host", F.lit(""))))
    seen = keyed.select("host", "content", F.explode("lines.line").alias("line")).distinct()
    hosts = keyed.groupBy("host").agg(F.count("*").alias("host_docs"))
    common = (
        seen.groupBy("host", "line").agg(F.count("*").alias("n_docs")).where(F.col("n_docs") > line_docs)
        .join(hosts, "host").where(F.col("n_docs") > line_share * F.col("host_docs")).select("host", "line"))
    removed = (
        keyed.select("row", "host", F.explode("lines").alias("at"))
        .select("row", "host", "at.*").join(common, ["host", "line"])
        .groupBy("row").agg(F.sum("words").alias("removed_words"), *([F.collect_set("line").alias("gone_lines")] if row else [])))
    rows = measured.join(removed, "row", "left")
    gone = F.coalesce("removed_words", F.lit(0))
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    depleted = (gone > max_removed * F.col("n_words")) | ((gone > 0) & (F.col("n_words") - gone < min_words))
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", gone.alias("removed_words"),
        failed.alias("base_failed"), (~failed & ~depleted).alias("kept"), *(["row", "gone_lines"] if row else []))


def _remove_lines(gone: str):
    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.schema.names
            columns = dict(zip(names, batch.columns))
            lists = columns.pop(gone)
            changed = np.flatnonzero(lists.is_valid().to_numpy(zero_copy_only=False)).tolist()
            if changed:
                texts = columns["text"].to_pylist()
                counts = columns["n_chars"].to_pylist() if "n_chars" in columns else None
                for k in changed:
                    lines = texts[k].encode().split(b"\n")
                    hashes = word_hashes(_normal_lines(lines)).view(np.int64)
                    stays = ~np.isin(hashes, lists[k].values.to_numpy()) | np.array([not line.split() for line in lines])
                    texts[k] = b"\n".join(line for line, good in zip(lines, stays.tolist()) if good).decode()
                    if counts:
                        counts[k] = len(texts[k])
                columns["text"] = pa.array(texts, columns["text"].type)
                if counts:
                    columns["n_chars"] = pa.array(counts, columns["n_chars"].type)
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))
    return remove


def keep_good(docs: DataFrame, **options) -> DataFrame:
    """The documents that pass without the lines to remove, all columns; a column n_chars is brought up to date."""
    docs, row = numbered(docs)
    gone, stays = f"{row}_gone_lines", f"{row}_stays"
    touched = saved(judge(docs, row=row, **options).where("NOT kept OR gone_lines IS NOT NULL").select("row", "kept", "gone_lines"), "touched")
    clear, others = set_apart(docs, row, touched)
    decided = others.join(touched.select(F.col("row").alias(row), F.col("kept").alias(stays), F.col("gone_lines").alias(gone)), row, "left")
    changed = decided.where(F.coalesce(F.col(stays), F.lit(True))).drop(row, stays).mapInArrow(_remove_lines(gone), docs.drop(row).schema)
    return clear.drop(row).union(changed)
