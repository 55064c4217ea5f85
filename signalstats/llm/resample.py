"""Importance resampling towards a target text: hashed n-grams, bit-sliced weights, draws by noise."""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from signalstats.llm.common import NON_ALPHANUMERIC, Words, pieces, stored

#: Documents whose planes are held at a time.
_GROUP = 512
_LONG_WORD = 64
#: Rows get their number by the task that wrote them (the upper bits) and their place in it.
_TASK_SHIFT = 33


def _crc_table() -> np.ndarray:
    """CRC-32 of every byte, by the rule of the reflected polynomial."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1)
    return table


_CRC = _crc_table()


def crc32_ranges(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, before: np.ndarray | None = None) -> np.ndarray:
    """CRC-32 of byte ranges; ``before`` are those of the bytes to which each is appended."""
    size = ends - starts
    crc = ~(np.zeros(len(size), np.uint32) if before is None else before)
    live, at = np.flatnonzero(size), 0
    while len(live) and at < _LONG_WORD:
        now = crc[live]
        crc[live] = _CRC[(now ^ raw[starts[live] + at]) & 255] ^ (now >> 8)
        at += 1
        live = live[size[live] > at]
    for i in live:
        crc[i] = ~np.uint32(zlib.crc32(raw[starts[i] + at : ends[i]].tobytes(), int(~crc[i])))
    return ~crc


def _features(piece: pa.RecordBatch, ngram: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words of every text; text and bucket of every run of 1 to ``ngram`` of its words."""
    words = Words(piece.column("text"), NON_ALPHANUMERIC, lower=True)
    space, last = np.frombuffer(b" ", np.uint8), np.repeat(words.first[1:], words.counts)
    first = np.arange(len(words))
    text = np.repeat(np.arange(piece.num_rows), words.counts)
    crc = crc32_ranges(words.raw, words.starts, words.ends)
    owners, found = [text], [crc % np.uint32(buckets)]
    for length in range(2, ngram + 1):
        longer = first + length <= last[first]
        first, crc = first[longer], crc[longer]
        begin = np.zeros(len(first), np.int64)
        crc = crc32_ranges(space, begin, begin + 1, crc)
        crc = crc32_ranges(words.raw, words.starts[first + length - 1], words.ends[first + length - 1], crc)
        owners.append(text[first])
        found.append(crc % np.uint32(buckets))
    return words.counts, np.concatenate(owners), np.concatenate(found).astype(np.int64)


def bucket_counts(texts: DataFrame, ngram: int = 1, buckets: int = 10_000) -> np.ndarray:
    """Features of all texts per bucket: each task sums up its own rows, so that at most
    ``buckets`` rows leave it, and as many reach the driver."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for piece in pieces(batches, "text"):
            total += np.bincount(_features(piece, ngram, buckets)[2], minlength=buckets)
        own = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(total[own])], ["bucket", "n"])

    sums = texts.select("text").mapInArrow(count, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))
    counts = np.zeros(buckets, np.int64)
    for bucket, n in sums.collect():
        counts[bucket] = n
    return counts


def gains(target: np.ndarray, source: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of a bucket's smoothed shares, rounded down."""
    more_source, more_target = float(source.sum() + len(source)), float(target.sum() + len(target))
    return np.array(
        [
            math.floor(1000 * math.log((t + 1) * more_source / ((s + 1) * more_target)))
            for t, s in zip(target.tolist(), source.tolist(), strict=True)
        ],
        np.int64,
    )


def _planes(row: np.ndarray, column: np.ndarray, value: np.ndarray, rows: int, columns: int, bits: int) -> np.ndarray:
    """Bit ``i`` of the value of a row and column as bit ``column`` of plane ``[i, row]``;
    pairs are distinct and in order."""
    width = (columns + 63) // 64
    planes = np.zeros((bits, rows * width), np.uint64)
    place, mark = row * width + column // 64, np.uint64(1) << (column % 64).astype(np.uint64)
    for i in range(bits):
        chosen = value >> i & 1 == 1
        at = place[chosen]
        if len(at):
            new = np.flatnonzero(np.diff(at, prepend=-1))
            planes[i, at[new]] = np.bitwise_or.reduceat(mark[chosen], new)
    return planes.reshape(bits, rows, width)


def sliced_sums(text: np.ndarray, bucket: np.ndarray, texts: int, worth: np.ndarray) -> np.ndarray:
    """Sum of ``worth[bucket]`` over the features of each text, without a product.

    Bit ``i`` of all bucket counts of a text is a plane, and so is bit ``j`` of all
    worths, in two's complement: the sum is ``2**(i + j)`` times the set bits that planes
    ``i`` and ``j`` share, over all pairs of planes, the sign plane counting negative.
    """
    buckets = len(worth)
    key, count = np.unique(text * buckets + bucket, return_counts=True)
    row, column = np.divmod(key, buckets)
    size = int(max(worth.max(), -worth.min() - 1)).bit_length() + 1
    everywhere = np.arange(buckets)
    worths = _planes(np.zeros(buckets, np.int64), everywhere, worth & ((1 << size) - 1), 1, buckets, size)
    total = np.zeros(texts, np.int64)
    for begin in range(0, texts, _GROUP):
        end = min(begin + _GROUP, texts)
        low, high = np.searchsorted(row, [begin, end])
        if low == high:
            continue
        bits = int(count[low:high].max()).bit_length()
        counts = _planes(row[low:high] - begin, column[low:high], count[low:high], end - begin, buckets, bits)
        for i in range(bits):
            some = np.flatnonzero(counts[i].any(axis=1))
            plane = counts[i, some]
            for j in range(size):
                shared = np.bitwise_count(plane & worths[j]).sum(axis=1, dtype=np.int64)
                total[begin + some] += -(shared << (i + j)) if j == size - 1 else shared << (i + j)
    return total


def resample(
    docs: DataFrame,
    target: DataFrame,
    percent: int = 10,
    ngram: int = 1,
    buckets: int = 10_000,
    min_words: int = 20,
    seed: int = 2024,
) -> DataFrame:
    """One row per row of ``docs`` (``doc_id, text``): ``doc_id, n_words, n_features, weight,
    score, rank``; the ``percent`` of the documents that look most like ``target`` (``text``)
    and are lucky are drawn, without replacement.

    Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text with A-Z in lower case,
    features all runs of 1 to ``ngram`` words; a feature's bucket is its CRC-32 modulo
    ``buckets``. A bucket's gain compares its share of all target texts with that of all
    documents; ``weight`` is the floored mean gain of a document's features, ``score`` the
    weight and Gumbel noise made from ``seed`` and ``doc_id``. ``rank`` counts the drawn
    documents, highest score first, ties to the smaller ``doc_id``; others have none. Those
    below ``min_words`` words take no part.

    Null or empty text: no features, weight 0. Rows without ``doc_id`` share one noise, that
    of an empty id, and rank last among equals; rows with the same id and score rank in
    any order. An empty table gives an empty one; an empty target favours rare buckets.
    Other columns are not used.

    Texts are read twice and never shuffled. Per bucket sums, at most ``buckets`` rows, and
    the count of each score (a whole number; gains and noise keep within some 10^5 values)
    reach the driver. Only rows that can be drawn are ranked: a score's rows by their id
    with a row per id and task, the rows of one id and task by themselves, so copies of one
    row, however many, do not meet.
    """
    rows = docs.selectExpr("cast(doc_id AS bigint) AS doc_id", "text")
    worth = gains(bucket_counts(target, ngram, buckets), bucket_counts(rows, ngram, buckets))
    known = rows.sparkSession.sparkContext.broadcast(worth)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "text"):
            n = piece.num_rows
            words, text, bucket = _features(piece, ngram, buckets)
            size = np.bincount(text, minlength=n)
            weight = sliced_sums(text, bucket, n, known.value) // np.maximum(size, 1)
            yield pa.RecordBatch.from_arrays(
                [piece.column("doc_id"), *(pa.array(x, pa.int64()) for x in (words, size, weight))],
                ["doc_id", "n_words", "n_features", "weight"],
            )

    text_of_id = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text_of_id, 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))
    scored = stored(
        rows.mapInArrow(weigh, "doc_id bigint, n_words bigint, n_features bigint, weight bigint")
        .withColumn("score", F.col("weight") + noise)
        .withColumn("row", F.monotonically_increasing_id()),
        "scores",
    )
    return _ranked(scored, F.col("n_words") >= min_words, percent)


def _ranked(scored: DataFrame, able, percent: int) -> DataFrame:
    """``scored`` with ``rank``, without ``row``."""
    spark = scored.sparkSession
    columns = [c for c in scored.columns if c != "row"]
    levels = sorted(((s, n) for s, n in scored.where(able).groupBy("score").count().collect()), reverse=True)
    drawn = sum(n for _, n in levels) * percent // 100
    above, before = [], 0
    for score, n in levels:
        if before >= drawn:
            break
        above.append((score, before))
        before += n
    if not above:
        return scored.select(*columns, F.lit(None).cast("bigint").alias("rank"))
    # Cells of equal score, id and writing task hold no more rows than that task wrote.
    cell = [F.col("score"), F.col("doc_id"), F.shiftright("row", _TASK_SHIFT).alias("task")]
    chosen = able & (F.col("score") >= above[-1][0])
    rows = scored.where(chosen)
    cells = rows.groupBy(*cell).agg(F.count("*").alias("n"))
    by_id = Window.partitionBy("score").orderBy(F.col("doc_id").asc_nulls_last(), "task")
    starts = (
        cells.withColumn("start", F.sum("n").over(by_id) - F.col("n"))
        .join(F.broadcast(spark.createDataFrame(above, "score bigint, above bigint")), "score")
        .select(
            F.col("score").alias("__score"),
            F.col("doc_id").alias("__id"),
            F.col("task").alias("__task"),
            (F.col("above") + F.col("start")).alias("__start"),
        )
    )
    rank = F.col("__start") + F.row_number().over(Window.partitionBy("score", "doc_id", "__task").orderBy("row"))
    same = (
        (F.col("score") == F.col("__score"))
        & F.col("doc_id").eqNullSafe(F.col("__id"))
        & (F.shiftright("row", _TASK_SHIFT) == F.col("__task"))
    )
    ranked = (
        rows.join(starts, same)
        .withColumn("rank", rank.cast("bigint"))
        .select(*columns, F.when(F.col("rank") <= drawn, F.col("rank")).alias("rank"))
    )
    return scored.where(~chosen).select(*columns, F.lit(None).cast("bigint").alias("rank")).unionByName(ranked)
