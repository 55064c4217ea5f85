"""Benchmark decontamination by Wu-Manber search for many word patterns at once."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from signalstats.llm import common
from signalstats.llm.common import NON_ALPHANUMERIC, Words, pieces, spans

#: Benchmark text (bytes) that one broadcast index holds at most; more makes more indexes.
INDEX_BYTES = 4_000_000
#: Window starts that one cursor of the search walks over.
_STRETCH = 256
_COUNT, _HITS, _ITEMS = "__count", "__hits", "__items"
_FOUND = pa.schema(
    [
        (_COUNT, pa.int64()),
        (_HITS, pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))),
        (_ITEMS, pa.list_(pa.string())),
    ]
)
_SPAN = T.StructType([T.StructField("start", T.LongType()), T.StructField("length", T.LongType())])


class _Patterns:
    """Index of all patterns of ``length`` words.

    A block is the last ``size`` words of a stretch of text. ``shifts`` tells for
    every block inside a pattern how far the window may move on without missing an
    occurrence; other blocks allow the largest move. A block with shift 0 ends at
    least one pattern: those patterns are its bucket.
    """

    def __init__(self, rows: np.ndarray, owners: np.ndarray, base: int) -> None:
        self.length = rows.shape[1]
        self.size = min(2, self.length)
        self.base = base
        self.rows, number = np.unique(rows, axis=0, return_inverse=True)
        pairs = np.unique(np.stack([number.ravel(), owners], axis=1), axis=0)
        self.owners = pairs[:, 1]
        self.owned = np.searchsorted(pairs[:, 0], np.arange(len(self.rows) + 1))
        blocks, moves = [], []
        for end in range(self.size, self.length + 1):
            blocks.append(self.block([self.rows[:, end - self.size + j] for j in range(self.size)]))
            moves.append(np.full(len(self.rows), self.length - end))
        block, move = np.concatenate(blocks), np.concatenate(moves)
        order = np.lexsort((move, block))
        self.blocks, least = np.unique(block[order], return_index=True)
        self.shifts = move[order][least]
        self.most = self.length - self.size + 1
        self.by_suffix = np.argsort(blocks[-1], kind="stable")
        self.suffixes = blocks[-1][self.by_suffix]

    def block(self, codes: list[np.ndarray]) -> np.ndarray:
        return codes[0] if self.size == 1 else codes[0] * self.base + codes[1]

    def search(self, code: Callable, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First word and pattern of every occurrence; ``code`` gives the codes of word numbers."""
        starts = np.maximum(np.diff(first) - self.length + 1, 0)
        stretches = -(-starts // _STRETCH)
        text, number = spans(stretches, np.zeros(len(starts), np.int64))
        at = first[text] + number * _STRETCH
        stop = np.minimum(at + _STRETCH, first[text] + starts[text])
        found = []
        while len(at):
            end = at + self.length - self.size
            block = self.block([code(end + j) for j in range(self.size)])
            place = np.minimum(np.searchsorted(self.blocks, block), len(self.blocks) - 1)
            shift = np.where(self.blocks[place] == block, self.shifts[place], self.most)
            hit = shift == 0
            if hit.any():
                found.append((at[hit], block[hit]))
            at = at + np.maximum(shift, 1)
            going = at < stop
            at, stop = at[going], stop[going]
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        at = np.concatenate([f[0] for f in found])
        block = np.concatenate([f[1] for f in found])
        low, high = (np.searchsorted(self.suffixes, block, side) for side in ("left", "right"))
        candidate, place = spans(high - low, low)
        at, pattern = at[candidate], self.by_suffix[place]
        # Words from the front confirm or end the comparison, candidates dwindling.
        for j in range(self.length):
            same = code(at + j) == self.rows[pattern, j]
            at, pattern = at[same], pattern[same]
        return at, pattern


class _Index:
    """Patterns of a list of items, one index per pattern length."""

    def __init__(self, items: list[tuple[str, str | None]], length: int) -> None:
        words = Words(pa.array([text for _, text in items], pa.large_string()), NON_ALPHANUMERIC, lower=True)
        hashes = words.hashes()
        self.vocabulary = np.unique(hashes)
        self.names = [name for name, _ in items]
        codes = np.searchsorted(self.vocabulary, hashes)
        rows: dict[int, tuple[list, list]] = {}
        for i, n in enumerate(words.counts.tolist()):
            if n:
                own = codes[words.first[i] : words.first[i + 1]]
                size = min(n, length)
                sets = rows.setdefault(size, ([], []))
                sets[0].append(np.lib.stride_tricks.sliding_window_view(own, size))
                sets[1].append(np.full(n - size + 1, i))
        base = len(self.vocabulary) + 1
        self.patterns = [_Patterns(np.concatenate(r), np.concatenate(o), base) for r, o in rows.values()]

    def search(self, words: Words) -> Iterator[tuple[_Patterns, np.ndarray, np.ndarray]]:
        sums = common.prefix_sums(words.raw)
        unknown = len(self.vocabulary)

        def code(number: np.ndarray) -> np.ndarray:
            # Words are hashed where the search looks at them; most it never sees.
            hashes = common.range_hash(sums, words.starts[number], words.ends[number])
            place = np.minimum(np.searchsorted(self.vocabulary, hashes), unknown - 1)
            return np.where(self.vocabulary[place] == hashes, place, unknown)

        for patterns in self.patterns:
            yield patterns, *patterns.search(code, words.first)


def _finder(index, more: bool) -> Callable:
    """Function that adds what one index finds; ``more``: to what the ones before found."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = index.value
        for piece in pieces(batches, "text"):
            words = Words(piece.column("text"), NON_ALPHANUMERIC, lower=True)
            n = piece.num_rows
            edges = np.zeros(len(words) + 1, np.int64)
            owned = [np.zeros((0, 2), np.int64)]
            for patterns, at, pattern in known.search(words):
                np.add.at(edges, at, 1)
                np.add.at(edges, at + patterns.length, -1)
                which, place = spans(patterns.owned[pattern + 1] - patterns.owned[pattern], patterns.owned[pattern])
                text = np.searchsorted(words.first, at, side="right") - 1
                owned.append(np.unique(np.stack([text[which], patterns.owners[place]], axis=1), axis=0))
            hit = np.append(np.cumsum(edges[:-1]) > 0, False)
            # Runs of hit words, cut where a text ends.
            text_first = np.zeros(len(words) + 1, bool)
            text_first[words.first] = True
            begin = np.flatnonzero(hit & (text_first | ~np.append(False, hit[:-1])))
            end = np.flatnonzero(hit[:-1] & (text_first[1:] | ~hit[1:])) + 1
            text = np.searchsorted(words.first, begin, side="right") - 1
            spans_of = _lists(
                text, n, pa.StructArray.from_arrays([begin - words.first[text], end - begin], ["start", "length"])
            )
            pairs = np.unique(np.concatenate(owned), axis=0)
            items_of = _lists(pairs[:, 0], n, pa.array([known.names[i] for i in pairs[:, 1]], pa.string()))
            own = piece
            if more:
                spans_of, items_of = _appended(piece.column(_HITS), spans_of), _appended(piece.column(_ITEMS), items_of)
                own = piece.select(piece.schema.names[: -len(_FOUND)])
            yield pa.RecordBatch.from_arrays(
                [*own.columns, pa.array(words.counts, pa.int64()), spans_of, items_of],
                schema=pa.schema([*own.schema, *_FOUND]),
            )

    return find


def _lists(owner: np.ndarray, n: int, values: pa.Array) -> pa.ListArray:
    offsets = np.append(0, np.cumsum(np.bincount(owner, minlength=n))).astype(np.int32)
    return pa.ListArray.from_arrays(offsets, values)


def _appended(left: pa.ListArray, right: pa.ListArray) -> pa.ListArray:
    """Both lists of every row as one."""
    sizes = [x.value_lengths().fill_null(0).to_numpy() for x in (left, right)]
    owner = np.concatenate([np.repeat(np.arange(len(s)), s) for s in sizes])
    values = pa.concat_arrays([left.flatten().cast(right.type.value_type), right.flatten()])
    order = np.argsort(owner, kind="stable")
    return _lists(owner, len(left), values.take(pa.array(order)))


def find_benchmark(
    docs: DataFrame, benchmark: DataFrame, length: int = 13, index_bytes: int = INDEX_BYTES
) -> DataFrame:
    """All columns of ``docs`` and ``n_words, n_hit, hits, items, contaminated``.

    Words are runs of ASCII letters and digits and of other characters beyond ASCII,
    A-Z in lower case. A pattern is each run of ``length`` words of an item, or the
    whole item if it has fewer. ``hits`` are the word ranges ``(start, length)`` that
    occurrences of patterns cover, ``n_hit`` their words, ``items`` the sorted ids
    (as strings) of the items that occur. Contaminated: at least a twentieth of the
    words is hit.

    Null or empty text or item: no words, nothing hit. An item without id counts as
    ''; items with one id are one. Rows of ``docs`` are judged one by one, so
    repeated rows and missing ids do not matter. Columns of ``docs`` that have the
    name of a result column are replaced.

    Wu-Manber: of the block of two words that ends a window, a shift table tells how
    far the window can move on; only blocks that end patterns lead to a bucket of
    patterns, which are then compared word by word. Documents are neither shuffled nor
    joined. The benchmark is dealt to indexes of about ``index_bytes`` of text; each is
    broadcast, and the documents pass through one after another, so no broadcast grows
    with the benchmark.
    """
    spark = docs.sparkSession
    # Repeated items are one, so an index holds no more than its share of different texts.
    named = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("id"), "text")
    items = named.where(F.col("text").isNotNull()).distinct()
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-total // index_bytes))
    names = ("n_words", "n_hit", "hits", "items", "contaminated")
    found = docs.drop(*names)
    plain = found.schema
    schema = T.StructType(
        [
            *plain,
            T.StructField(_COUNT, T.LongType()),
            T.StructField(_HITS, T.ArrayType(_SPAN)),
            T.StructField(_ITEMS, T.ArrayType(T.StringType())),
        ]
    )
    for block in range(blocks):
        own = items.where(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == block).collect()
        index = spark.sparkContext.broadcast(_Index([tuple(r) for r in own], length))
        found = found.mapInArrow(_finder(index, block > 0), schema)
    return (
        found.withColumn("n_words", F.col(_COUNT))
        .withColumn("hits", _merged() if blocks > 1 else F.col(_HITS))
        .withColumn("n_hit", F.aggregate("hits", F.lit(0).cast("long"), lambda a, x: a + x.length))
        .withColumn("items", F.array_sort(F.array_distinct(_ITEMS)))
        .withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))
        .select(*plain.names, *names)
    )


def _merged() -> Column:
    """Hits of several indexes as disjoint ranges."""
    return F.aggregate(
        F.array_sort(_HITS),
        F.array().cast("array<struct<start:bigint,length:bigint>>"),
        lambda a, x: F.when(
            (F.size(a) > 0) & (x.start <= F.element_at(a, -1).start + F.element_at(a, -1).length),
            F.concat(
                F.slice(a, 1, F.greatest(F.size(a) - 1, F.lit(0))),
                F.array(
                    F.struct(
                        F.element_at(a, -1).start.alias("start"),
                        F.greatest(
                            F.element_at(a, -1).length, x.start + x.length - F.element_at(a, -1).start
                        ).alias("length"),
                    )
                ),
            ),
        ).otherwise(F.array_append(a, x)),
    )
