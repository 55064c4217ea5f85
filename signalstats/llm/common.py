"""Stored tables, words and n-gram hashes that the operators share.

Words are byte ranges of an Arrow text buffer. Everything below works on whole
NumPy arrays of one piece of a batch; no Python object exists per word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from signalstats.sources.scratch import new_folder, remove

#: Bytes of text that one step of an Arrow function works on; longer texts are a step of their own.
PIECE_BYTES = 2_000_000

_A = np.uint64(0x9E3779B97F4A7C15)
_B = np.uint64(0xC2B2AE3D27D4EB4F)
_MULTIPLIER = 0x9FB21C651E98DF25
_INVERSE = pow(_MULTIPLIER, -1, 2**64)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written below the shared folder and read again: later steps neither
    compute it twice nor depend on executors that may be lost."""
    spark = df.sparkSession
    path = new_folder(spark, f"llm-{name}")
    df.write.option("compression", "zstd").parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table.stored_path = path
    return table


def dropped(*tables: DataFrame) -> None:
    """Delete tables of :func:`stored` that nothing reads any more."""
    for table in tables:
        remove(table.sparkSession, table.stored_path)


def byte_table(*ranges: tuple[int, int]) -> np.ndarray:
    """Boolean table over the 256 bytes, true within the (inclusive) ranges."""
    table = np.zeros(256, dtype=bool)
    for low, high in ranges:
        table[low : high + 1] = True
    return table


#: Gaps between the words ``[^\x20\x09-\x0D]+``.
SPACES = byte_table((0x09, 0x0D), (0x20, 0x20))
#: Gaps between the words ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` of a text in lower case.
NON_ALPHANUMERIC = byte_table((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


def pieces(batches: Iterator[pa.RecordBatch], column: str, limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Row ranges of the batches with at most ``limit`` bytes in ``column``, or one row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        offsets = text_bytes(batch.column(column))[1]
        row = 0
        while row < batch.num_rows:
            end = int(np.searchsorted(offsets, offsets[row] + limit, side="right")) - 1
            end = min(max(end, row + 1), batch.num_rows)
            yield batch.slice(row, end - row)
            row = end


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts, one after another, and where each begins; nulls are empty."""
    texts = texts.fill_null("")
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    _, where, data = texts.buffers()
    offsets = np.frombuffer(where, kind)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


class Words:
    """Words of an array of texts.

    ``starts`` and ``ends`` are byte positions in ``raw``; the words of text ``i``
    are numbers ``first[i]`` to ``first[i + 1] - 1``.
    """

    def __init__(self, texts: pa.Array, gaps: np.ndarray = SPACES, lower: bool = False) -> None:
        raw, self.offsets = text_bytes(texts)
        self.raw = LOWER[raw] if lower else raw
        inside = ~gaps[self.raw]
        begins, closes = inside.copy(), inside.copy()
        begins[1:] &= ~inside[:-1]
        closes[:-1] &= ~inside[1:]
        edges = self.offsets[1:-1]
        left = edges[edges < len(raw)]
        begins[left] = inside[left]
        right = edges[edges > 0] - 1
        closes[right] = inside[right]
        self.inside = inside
        self.starts = np.flatnonzero(begins)
        self.ends = np.flatnonzero(closes) + 1
        self.first = np.searchsorted(self.starts, self.offsets)
        self.counts = np.diff(self.first)

    def __len__(self) -> int:
        return len(self.starts)

    def hashes(self, seed: int = 0) -> np.ndarray:
        """A 64-bit hash of each word."""
        return range_hashes(self.raw, self.starts, self.ends, seed)


def prefix_sums(raw: np.ndarray, seed: int = 0) -> np.ndarray:
    """Sums from which the hash of any byte range follows, see :func:`range_hash`."""
    ahead = powers(len(raw) + 1)[0]
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_bytes_to_random(seed)[raw] * ahead[: len(raw)], out=sums[1:])
    return sums


def range_hash(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte ranges, equal for equal bytes."""
    back = powers(len(sums))[1]
    return mix((sums[ends] - sums[starts]) * back[starts])


def range_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    return range_hash(prefix_sums(raw, seed), starts, ends)


_random: dict[int, np.ndarray] = {}
_power: list[np.ndarray] = []


def _bytes_to_random(seed: int) -> np.ndarray:
    if seed not in _random:
        _random[seed] = mix(np.arange(1, 257, dtype=np.uint64) * _A + np.uint64(seed) * _B)
    return _random[seed]


def powers(count: int) -> list[np.ndarray]:
    """Powers of the multiplier and of its inverse, modulo 2**64."""
    if not _power or len(_power[0]) < count:
        count = max(count, PIECE_BYTES + 1)
        _power[:] = [
            np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(count - 1, x, np.uint64))])
            for x in (_MULTIPLIER, _INVERSE)
        ]
    return _power


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit numbers over all others; one to one."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def joined(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Hashes of sequences from the hashes of their two parts."""
    return mix(left * _A + mix(right + _B))


def ngrams(words: np.ndarray, length: int) -> np.ndarray:
    """Hash of the ``length`` words from each position on, text ends not regarded."""
    if len(words) < length:
        return np.zeros(0, np.uint64)
    power, size, result, done = words, 1, None, 0
    while True:
        if length & size:
            if result is None:
                result = power
            else:
                n = len(words) - (done + size) + 1
                result = joined(result[:n], power[done : done + n])
            done += size
        if size * 2 > length:
            return result
        power = joined(power[:-size], power[size:])
        size *= 2


def leftmost_smallest(hashes: np.ndarray, width: int) -> np.ndarray:
    """For each position the leftmost smallest of the ``width`` hashes from there on."""
    at, size = np.arange(len(hashes)), 1
    while size * 2 <= width:
        at = np.where(hashes[at[:-size]] <= hashes[at[size:]], at[:-size], at[size:])
        size *= 2
    shift = width - size
    if not shift:
        return at
    return np.where(hashes[at[:-shift]] <= hashes[at[shift:]], at[:-shift], at[shift:])


def spans(counts: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each of ``counts[i]`` consecutive numbers from ``begins[i]`` on: ``i`` and the number."""
    owner = np.repeat(np.arange(len(counts)), counts)
    shift = begins - (np.cumsum(counts) - counts)
    return owner, np.arange(len(owner)) + np.repeat(shift, counts)


def windows(first: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Text and first word of every run of ``length`` words inside one text."""
    return spans(np.maximum(np.diff(first) - length + 1, 0), first[:-1])


def per_text(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sum of the values of each text."""
    sums = np.cumsum(values)
    sums = np.concatenate([np.zeros(1, sums.dtype), sums])
    return sums[first[1:]] - sums[first[:-1]]


def signed(x: np.ndarray) -> np.ndarray:
    """64-bit hashes as Spark's BIGINT."""
    return x.view(np.int64)
