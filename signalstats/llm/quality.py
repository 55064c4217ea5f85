"""Quality rules: per-document figures and the cross-document frequency of lines."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signalstats.llm import common
from signalstats.llm.common import LOWER, Words, joined, mix, ngrams, per_text, pieces, signed, stored, windows

_SYMBOLS = np.isin(np.arange(256), list(b"#*$%&|<>"))
_FIGURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_SCHEMA = (
    "doc_id bigint, host bigint, text_hash bigint, "
    + ", ".join(f"{name} bigint" for name in _FIGURES)
    + ", lines array<struct<h:bigint,words:bigint>>"
)


def covered(begins: np.ndarray, length: int, total: int) -> np.ndarray:
    """Which of ``total`` words lie in one of the windows of ``length`` words."""
    edges = np.zeros(total + 1, np.int32)
    np.add.at(edges, begins, 1)
    np.add.at(edges, begins + length, -1)
    return np.cumsum(edges[:-1]) > 0


def repeated(keys: np.ndarray) -> np.ndarray:
    """Which keys occur more than once."""
    ordered = np.sort(keys)
    return np.isin(keys, ordered[1:][ordered[1:] == ordered[:-1]])


def _line_rows(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of every line with a word: text, number of words, hash of the line as it is,
    hash of its key."""
    feeds = np.flatnonzero(words.raw == 0x0A)
    text_of_word = np.repeat(np.arange(len(words.counts)), words.counts)
    line_of_word = np.searchsorted(feeds, words.starts) + text_of_word
    new = np.flatnonzero(np.diff(line_of_word, prepend=-1))
    last = np.append(new[1:], len(words)) - 1
    text = text_of_word[new]
    begin, end = words.starts[new], words.ends[last]
    before = np.searchsorted(feeds, begin)
    whole_begin = np.maximum(words.offsets[text], np.append(-1, feeds)[before] + 1)
    whole_end = np.minimum(words.offsets[text + 1], np.append(feeds, len(words.raw))[before])
    return (
        text,
        last - new + 1,
        common.range_hashes(words.raw, whole_begin, whole_end),
        common.range_hashes(LOWER[words.raw], begin, end),
    )


def _figures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for piece in pieces(batches, "text"):
        words = Words(piece.column("text"))
        n = piece.num_rows
        number = mix(np.arange(1, n + 1, dtype=np.uint64))
        visible = words.inside & ((words.raw & 0xC0) != 0x80)
        text, at = windows(words.first, 8)
        again = repeated(joined(ngrams(words.hashes(), 8)[at], number[text]))
        repeat_words = per_text(covered(at[again], 8, len(words)), words.first)
        text, size, whole, key = _line_rows(words)
        distinct = np.unique(joined(whole, number[text]), return_index=True)[1]
        dup_lines = np.bincount(text, minlength=n) - np.bincount(text[distinct], minlength=n)
        order = np.lexsort((key, text))
        text, size, key = text[order], size[order], key[order]
        new = np.flatnonzero((np.diff(text, prepend=-1) != 0) | np.append(True, key[1:] != key[:-1])[: len(key)])
        total = np.add.reduceat(size, new) if len(new) else size
        offsets = np.append(0, np.cumsum(np.bincount(text[new], minlength=n))).astype(np.int32)
        lines = pa.ListArray.from_arrays(
            offsets, pa.StructArray.from_arrays([signed(key[new]), total.astype(np.int64)], ["h", "words"])
        )
        figures = [
            words.counts,
            per_text(visible, words.offsets),
            per_text(_SYMBOLS[words.raw], words.offsets),
            dup_lines,
            repeat_words,
        ]
        columns = [piece.column(c) for c in ("doc_id", "host", "text_hash")]
        columns += [pa.array(np.asarray(f, np.int64)) for f in figures]
        yield pa.RecordBatch.from_arrays(
            [*columns, lines], ["doc_id", "host", "text_hash", *_FIGURES, "lines"]
        )


def quality_rules(
    docs: DataFrame,
    min_words: int = 20,
    max_repeat_percent: int = 30,
    max_docs: int = 10,
    max_permille: int = 1,
    min_left_percent: int = 50,
) -> DataFrame:
    """One row per row of ``docs`` (``doc_id, source, text``): ``doc_id, n_words,
    word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, n_removed_words,
    kept``.

    Base rules: fewer than ``min_words`` words, or more than ``max_repeat_percent`` %
    of the words in 8-word windows that the text repeats.

    Line frequency: a line's key is the line without blanks at both ends, in lower
    case. Of each host (``source``) the documents that hold a key are counted, copies
    of one text once: a copied document is not boilerplate. Lines above the limit,
    ``max_docs`` documents and ``max_permille`` per mille of the host's documents,
    are removed; a document that keeps fewer than ``min_left_percent`` % of its words
    is depleted and not kept.

    Null or empty text: no words, fails the base rules. Null source: the host ''.
    Repeated rows and rows without ``doc_id`` are judged like all others, row by row.
    Other columns are not used.

    Texts are read once and never shuffled; a row of figures and line hashes per
    document is written, and the hashes are counted with map-side combining.
    """
    host = F.coalesce(F.col("source"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("long"), F.xxhash64(host).alias("host"), F.xxhash64("text").alias("text_hash"), "text"
    )
    figures = stored(
        rows.mapInArrow(_figures, _SCHEMA).withColumn("row", F.monotonically_increasing_id()), "quality"
    )
    lines = figures.select("row", "host", "text_hash", F.explode("lines").alias("l")).select(
        "row", "host", "text_hash", "l.*"
    )
    hosts = figures.select("host", "text_hash").distinct().groupBy("host").agg(F.count("*").alias("docs"))
    # Written, so that the join below reads two plain shuffles, which can be split.
    frequent = stored(
        lines.select("host", "h", "text_hash")
        .distinct()
        .groupBy("host", "h")
        .agg(F.count("*").alias("n"))
        .where(F.col("n") > max_docs)
        .join(hosts, "host")
        .where(F.col("n") * 1000 > F.col("docs") * max_permille)
        .select("host", "h"),
        "frequent-host-lines",
    )
    removed = lines.join(frequent, ["host", "h"]).groupBy("row").agg(F.sum("words").alias("n_removed_words"))
    base_failed = (F.col("n_words") < min_words) | (
        100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words")
    )
    left = F.col("n_words") - F.col("n_removed_words")
    return (
        figures.drop("lines", "host", "text_hash")
        .join(removed, "row", "left")
        .withColumn("n_removed_words", F.coalesce("n_removed_words", F.lit(0).cast("long")))
        .withColumn("base_failed", base_failed)
        .withColumn("kept", ~base_failed & (100 * left >= min_left_percent * F.col("n_words")))
        .select("doc_id", *_FIGURES, "base_failed", "n_removed_words", "kept")
    )
