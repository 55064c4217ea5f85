"""Sequence packing: best fit, then a local search that swaps documents between underfull bins.

Only the lengths of the pieces matter for where they go, and there are no more lengths
than tokens in a sequence. So the search works on classes of bins with the same content,
each with the number of such bins, whatever the number of documents; which document takes
which place is settled afterwards by numbers that Spark gives to the pieces of a length.
"""

from __future__ import annotations

import bisect
import functools
import itertools
import os
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from signalstats.llm.common import pieces, range_hashes, spans, stored, text_bytes

#: Chunks of text whose tokens a Python worker remembers at least, and at most twice.
_REMEMBERED = 1 << 18
#: Bytes of text in one step of a worker, whose arrays grow with it.
_STEP_BYTES = 500_000
#: Chunks that are tokenized as one text.
_JOINED = 500

# -- tokens -------------------------------------------------------------------


class _ChunkTokens:
    """Token ids of chunks of text, remembered in arrays: no Python object exists per chunk.

    Texts and ids of the remembered chunks lie one after another in the order in which they
    came. Sorted hashes lead to them, and the bytes decide whether a chunk is the same. When
    there are too many, those that were asked for last are kept.
    """

    def __init__(self, path: str) -> None:
        # One task has one core: the library's own threads would take others'.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        added = self._tokenizer.get_added_tokens_decoder()
        #: Bytes of text that a token stands for: one per character of its byte-level form.
        self._size = np.zeros(self._tokenizer.get_vocab_size() + 1, np.int64)
        for token, i in self._tokenizer.get_vocab().items():
            self._size[i] = len(str(added[i].content).encode()) if i in added else len(token)
        #: Hashes in order, and the number of the chunk that each belongs to.
        self._keys, self._numbers = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        #: Of each chunk: when it was asked for last, where its text and its ids begin and end.
        self._used = np.zeros(0, np.int64)
        self._texts, self._text_edges = np.zeros(0, np.uint8), np.zeros(1, np.int64)
        self._ids, self._id_edges = np.zeros(0, np.uint32), np.zeros(1, np.int64)
        self._time = 0

    def _encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after another, and how many each has."""
        found = self._tokenizer.encode_batch_fast([t.decode("utf-8", "replace") for t in texts], add_special_tokens=False)
        ids = [x.ids for x in found]
        size = np.array([len(x) for x in ids], np.int64)
        return np.fromiter(itertools.chain.from_iterable(ids), np.uint32, int(size.sum())), size

    def _encode_joined(self, texts: bytes, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same for chunks that are independent of each other even when joined, so they
        cost one call for many; the tokens' sizes tell them apart."""
        flat, sizes = [], []
        for at in range(0, len(ends), _JOINED):
            begin = int(ends[at - 1]) if at else 0
            part = ends[at : at + _JOINED] - begin
            text = texts[begin : begin + int(part[-1])]
            ids, size = self._encode([text])
            upto = np.cumsum(self._size[ids])
            last = np.searchsorted(upto, part)
            if last[-1] < len(upto) and (upto[last] == part).all():
                size = np.diff(last, prepend=-1)
            else:  # not a token per byte: some other kind of vocabulary
                edges = [0, *part.tolist()]
                ids, size = self._encode([text[s:e] for s, e in itertools.pairwise(edges)])
            flat.append(ids)
            sizes.append(size)
        if not flat:
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        return np.concatenate(flat), np.concatenate(sizes)

    def _find(self, raw: np.ndarray, starts: np.ndarray, size: np.ndarray, keys: np.ndarray) -> np.ndarray:
        """Numbers of the chunks, -1 for one that is not remembered."""
        found = np.full(len(keys), -1)
        if not len(self._keys):
            return found
        at = np.minimum(np.searchsorted(self._keys, keys), len(self._keys) - 1)
        number = self._numbers[at]
        begin = self._text_edges[number]
        like = np.flatnonzero((self._keys[at] == keys) & (self._text_edges[number + 1] - begin == size))
        owner, here = spans(size[like], starts[like])
        there = spans(size[like], begin[like])[1]
        found[like] = number[like]
        found[like[owner[raw[here] != self._texts[there]]]] = -1
        return found

    def _learn(self, raw: np.ndarray, starts: np.ndarray, size: np.ndarray, keys: np.ndarray) -> np.ndarray:
        """Numbers of chunks that are new; their keys are in order."""
        # What begins with a blank and ends where a chunk can end may be joined.
        alone = (raw[starts] != 0x20) | ~_word_ends(raw)[starts + size - 1]
        order = np.argsort(alone, kind="stable")
        starts, size, many = starts[order], size[order], len(order) - int(alone.sum())
        texts = raw[spans(size, starts)[1]]
        ends = np.cumsum(size)
        plain = texts.tobytes()
        ids, count = self._encode_joined(plain, ends[:many])
        edges = zip((ends - size)[many:].tolist(), ends[many:].tolist(), strict=True)
        more, count_more = self._encode([plain[s:e] for s, e in edges])
        known = len(self._used)
        numbers = np.empty(len(order), np.int64)
        numbers[order] = known + np.arange(len(order))
        self._texts = np.concatenate([self._texts, texts])
        self._text_edges = np.append(self._text_edges, self._text_edges[-1] + ends)
        self._ids = np.concatenate([self._ids, ids, more])
        self._id_edges = np.append(self._id_edges, self._id_edges[-1] + np.cumsum(np.append(count, count_more)))
        self._used = np.append(self._used, np.zeros(len(order), np.int64))
        place = np.searchsorted(self._keys, keys)
        self._keys = np.insert(self._keys, place, keys)
        self._numbers = np.insert(self._numbers, place, numbers)
        return numbers

    def _forget(self) -> None:
        """Keep the chunks that were asked for last."""
        keep = np.zeros(len(self._used), bool)
        keep[np.argsort(self._used, kind="stable")[-_REMEMBERED:]] = True
        left = keep[self._numbers]
        self._keys, self._numbers = self._keys[left], (np.cumsum(keep) - 1)[self._numbers[left]]
        self._used = self._used[keep]
        size = np.diff(self._text_edges)
        self._texts = self._texts[np.repeat(keep, size)]
        self._text_edges = np.append(0, np.cumsum(size[keep]))
        size = np.diff(self._id_edges)
        self._ids = self._ids[np.repeat(keep, size)]
        self._id_edges = np.append(0, np.cumsum(size[keep]))

    def of(
        self, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, keys: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct chunks, one after another, and how many each has. The chunks are
        byte ranges of ``raw``, none of them empty, with their hashes in order."""
        numbers = self._find(raw, starts, ends - starts, keys)
        new = np.flatnonzero(numbers < 0)
        if len(new):
            numbers[new] = self._learn(raw, starts[new], (ends - starts)[new], keys[new])
        self._time += 1
        self._used[numbers] = self._time
        begin = self._id_edges[numbers]
        size = self._id_edges[numbers + 1] - begin
        ids = self._ids[spans(size, begin)[1]]
        if len(self._used) > 2 * _REMEMBERED:
            self._forget()
        return ids, size


_chunk_tokens = functools.cache(_ChunkTokens)


def _word_ends(raw: np.ndarray) -> np.ndarray:
    """Where a blank that follows begins a new word: bytes that are visible, or the last of
    a longer character, unless its lead byte could begin a kind of blank."""
    ends = (raw > 0x20) & (raw < 0x7F)
    wide = raw >= 0x80
    if wide.any():
        blank = np.zeros(len(raw), bool)
        blank[1:] = raw[:-1] == 0xC2
        blank[2:] |= (raw[:-2] >= 0xE1) & (raw[:-2] <= 0xE3)
        ends |= wide & ~blank
    return ends


def _chunk_starts(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where texts and chunks begin: at a blank that follows something visible. There a
    byte-level tokenizer always begins a new word, whatever comes before or after."""
    cut = np.zeros(len(raw) + 1, bool)
    cut[1:-1] = _word_ends(raw)[:-1] & (raw[1:] == 0x20)
    cut[offsets[:-1]] = True
    cut[len(raw)] = False
    return np.flatnonzero(cut)


def token_ids(texts: pa.Array, path: str) -> tuple[np.ndarray, np.ndarray]:
    """Token ids of all texts, one after another, and where each begins; null is empty.

    Equal chunks of the texts are tokenized once, and remembered for later batches.
    """
    raw, offsets = text_bytes(texts)
    if not len(raw):
        return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)
    starts = _chunk_starts(raw, offsets)
    ends = np.append(starts[1:], len(raw))
    keys, example, which = np.unique(range_hashes(raw, starts, ends), return_index=True, return_inverse=True)
    flat, size = _chunk_tokens(path).of(raw, starts[example], ends[example], keys)
    begin = np.cumsum(size) - size
    _, at = spans(size[which], begin[which])
    edges = np.append(0, np.cumsum(size[which]))
    return flat[at], edges[np.searchsorted(starts, offsets)]


def token_pieces(
    docs: DataFrame, tokenizer: str, capacity: int = 1024, end_id: int = 2, with_ids: bool = False
) -> DataFrame:
    """Rows ``doc_id, piece, start, length, ids_crc32`` (and ``ids``) from ``doc_id, text``.

    A document is the ids of its text and then ``end_id``. One of more than ``capacity``
    ids is cut into pieces of that length; the first takes what is left over. Null or
    empty text is the end id alone. ``ids_crc32`` is the CRC-32 of the ids as unsigned
    little-endian 32-bit numbers. ``tokenizer`` is a file of the ``tokenizers`` library
    with a byte-level pre-tokenizer, at the same place on every executor.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text", _STEP_BYTES):
            ids, edges = token_ids(batch.column("text"), tokenizer)
            n = batch.num_rows
            size = np.diff(edges) + 1
            closed = np.insert(ids, edges[1:], np.uint32(end_id))
            begin = np.cumsum(size) - size
            count = -(-size // capacity)
            owner, number = spans(count, np.zeros(n, np.int64))
            head = size - (count - 1) * capacity
            start = np.where(number == 0, 0, head[owner] + (number - 1) * capacity)
            length = np.where(number == 0, head[owner], capacity)
            at = begin[owner] + start
            plain = memoryview(closed.astype("<u4").tobytes())
            crc = [zlib.crc32(plain[4 * s : 4 * (s + k)]) for s, k in zip(at.tolist(), length.tolist(), strict=True)]
            ids_of = batch.column("doc_id").take(pa.array(owner))
            arrays = [ids_of, pa.array(number, pa.int32()), *(pa.array(x, pa.int64()) for x in (start, length, crc))]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                bounds = np.append(at, len(closed)).astype(np.int32)
                arrays.append(pa.ListArray.from_arrays(bounds, pa.array(closed.astype(np.int32))))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(arrays, names)

    schema = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
    rows = docs.selectExpr("cast(doc_id AS bigint) AS doc_id", "text")
    return rows.mapInArrow(cut, schema + ", ids array<int>" * with_ids)


# -- bins -----------------------------------------------------------------------

#: The lengths in a bin, longest first.
Content = tuple[int, ...]


def best_fit(counts: dict[int, int], capacity: int) -> Counter[Content]:
    """Bins (content and number of bins) of best fit by falling length.

    All pieces of a length go at once into the bins with the least room that takes them.
    Every step uses up a length or a class of bins, so there are at most about two
    classes per length.
    """
    by_room: dict[int, list[list]] = {}
    rooms: list[int] = []

    def put(content: Content, room: int, bins: int) -> None:
        if room not in by_room:
            by_room[room] = []
            bisect.insort(rooms, room)
        by_room[room].append([content, bins])

    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            at = bisect.bisect_left(rooms, length)
            if at == len(rooms):
                # New bins, filled as far as they go with pieces of this length.
                each = capacity // length
                bins, rest = divmod(left, each)
                if bins:
                    put((length,) * each, capacity - each * length, bins)
                if rest:
                    put((length,) * rest, capacity - rest * length, 1)
                break
            room = rooms[at]
            content, bins = by_room[room].pop()
            if not by_room[room]:
                del by_room[room]
                rooms.pop(at)
            each = min(room // length, -(-left // bins))
            full = min(left // each, bins)
            put(content + (length,) * each, room - each * length, full)
            left -= full * each
            if full < bins:
                rest, left = left, 0
                if rest:
                    put(content + (length,) * rest, room - rest * length, 1)
                if bins - full - bool(rest):
                    put(content, room, bins - full - bool(rest))
    result: Counter[Content] = Counter()
    for classes in by_room.values():
        for content, bins in classes:
            result[content] += bins
    return result


def _takes(content: Content) -> dict[int, tuple[Content, ...]]:
    """What one or two pieces of a bin come to, and which they are: singles first."""
    found: dict[int, tuple[Content, ...]] = {}
    for i, x in enumerate(content):
        found.setdefault(x, ((x,),))
    for i, x in enumerate(content):
        if i and content[i - 1] == x and i > 1 and content[i - 2] == x:
            continue
        for y in content[i + 1 :]:
            pair = (x, y)
            if x + y not in found:
                found[x + y] = (pair,)
            elif len(found[x + y]) == 1 and len(found[x + y][0]) == 1:
                found[x + y] += (pair,)
    return found


def _without(content: Content, out: Content, into: Content) -> Content:
    left = list(content)
    for x in out:
        left.remove(x)
    return tuple(sorted((*left, *into), reverse=True))


def local_search(bins: Counter[Content], capacity: int, max_steps: int = 10_000) -> Counter[Content]:
    """Fewer bins by moves, one-for-one and two-for-one exchanges between underfull ones.

    The emptiest bins give, fuller ones take. An exchange sends more tokens to the fuller
    bin than come back, as many more as its room allows, which always increases the sum of
    the squared fills; a bin that has given everything is gone. The search ends when no
    exchange is left, when the bins are as few as their tokens allow, or after
    ``max_steps`` exchanges, each of whole classes of bins; all pieces stay packed at any
    time.
    """
    bins = Counter(bins)
    fewest = -(-sum(sum(c) * n for c, n in bins.items()) // capacity)
    memo: dict[Content, dict] = {}

    def takes(content: Content) -> dict:
        if content not in memo:
            if len(memo) > 20_000:
                memo.clear()
            memo[content] = _takes(content)
        return memo[content]

    stuck: set[Content] = set()
    for _ in range(max_steps):
        if bins.total() <= fewest:
            break
        givers = [c for c in bins if sum(c) < capacity and c not in stuck]
        if not givers:
            break
        giver = min(givers, key=lambda c: (sum(c), c))
        fill = sum(giver)
        offers = sorted(takes(giver))
        best = None
        for taker in sorted((c for c in bins if fill <= sum(c) < capacity), key=lambda c: (-sum(c), c)):
            if taker == giver and bins[giver] < 2:
                continue
            room = capacity - sum(taker)
            if best is not None and best[0] >= room:
                continue
            step = _best_exchange(takes(taker), offers, takes(giver), room, best[0] if best else 0)
            if step is not None:
                best = (*step, taker)
                # A bin that becomes full is as good as it gets.
                if step[0] == room:
                    break
        if best is None:
            stuck.add(giver)
            continue
        _, out, into, taker = best
        many = bins[giver] // 2 if taker == giver else min(bins[giver], bins[taker])
        for content, change in ((giver, -many), (taker, -many)):
            bins[content] += change
        for content in (_without(taker, out, into), _without(giver, into, out)):
            if content:
                bins[content] += many
        for content in (giver, taker):
            if not bins[content]:
                del bins[content]
        stuck.clear()
    return bins


def _best_exchange(
    taker: dict, offers: list[int], giver: dict, room: int, more_than: int
) -> tuple[int, Content, Content] | None:
    """The exchange that adds most to the taker, within its room: what it adds, what goes
    back and what comes."""
    best = None
    for back, backs in [(0, ((),)), *taker.items()]:
        at = bisect.bisect_right(offers, room + back)
        while at and offers[at - 1] - back > more_than:
            coming = giver[offers[at - 1]]
            # Two pieces are never exchanged for two.
            ways = ((b, c) for b in backs for c in coming if len(b) + len(c) < 4)
            pair = min(ways, default=None, key=lambda p: len(p[0]) + len(p[1]))
            if pair:
                more_than = offers[at - 1] - back
                best = (more_than, *pair)
                break
            at -= 1
    return best


def _places(bins: Counter[Content]) -> list[np.ndarray]:
    """Rows ``(length, first, sequence, offset, each)``: pieces of a length with numbers from
    ``first`` on go to the bins from ``sequence`` on, ``each`` to a bin, beginning at ``offset``."""
    rows, taken, sequence = [], Counter(), 0
    for content, n in sorted(bins.items()):
        offset = 0
        for length, each in sorted(Counter(content).items(), reverse=True):
            rows.append((length, taken[length], sequence, offset, each))
            taken[length] += n * each
            offset += length * each
        sequence += n
    columns = zip(*sorted(rows), strict=True) if rows else [()] * 5
    return [np.array(c, np.int64) for c in columns]


# -- documents to places --------------------------------------------------------


def pack(pieces_of: DataFrame, capacity: int = 1024, max_steps: int = 10_000) -> DataFrame:
    """``pieces_of`` with ``sequence_id`` and ``offset``; columns of these names are replaced.

    ``length`` (1 to ``capacity``) is the only column that is looked at; rows with the same
    or no id are rows like others. Every row gets a place of its own, the places of a
    sequence leave no gap, and sequences hold at most ``capacity`` tokens. An empty table
    gives an empty one; a length outside the bounds, or none, is refused.

    At most ``capacity`` counts reach the driver, and the places, a row for every
    length of a class of bins, go back to the tasks. Pieces of a length are numbered
    within the task that wrote them, with a row per task and length to put these numbers
    one after another: a length that a third of all pieces have meets in no task.

    The pieces are stored as they come, without a Python step of this function: a task that
    makes them in Python would keep two workers, and in time each would hold the tokenizer
    and its remembered chunks.
    """
    spark = pieces_of.sparkSession
    plain = pieces_of.drop("sequence_id", "offset")
    schema = plain.schema
    bad = F.raise_error(F.lit(f"a piece has 1 to {capacity} tokens"))
    length = F.when(F.col("length").between(1, capacity), F.col("length")).otherwise(bad)
    # The number of the row has its task in the upper bits.
    rows = plain.withColumn("length", length).withColumn("__row", F.monotonically_increasing_id())
    written = stored(rows, "pieces").withColumn("__task", F.shiftright("__row", 33))
    cells = stored(written.groupBy("length", "__task").agg(F.count("*").alias("n")), "piece-counts")
    counts = {r.length: r.n for r in cells.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    places = _places(local_search(best_fit(counts, capacity), capacity, max_steps))
    known = spark.sparkContext.broadcast(places)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        length, first, sequence, offset, each = known.value
        for batch in batches:
            own = batch.column("length").to_numpy().astype(np.int64)
            number = batch.column("__number").to_numpy()
            # Ranges of a length are in order, so the last that begins at or before holds it.
            low = np.searchsorted(length, own)
            high = np.searchsorted(length, own, side="right")
            while (high - low > 1).any():
                middle = (low + high) // 2
                right = (first[middle] <= number) & (high - low > 1)
                low, high = np.where(right, middle, low), np.where(right, high, np.where(high - low > 1, middle, high))
            extra, copy = np.divmod(number - first[low], each[low])
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[:-1],
                    pa.array(sequence[low] + extra),
                    pa.array(offset[low] + copy * own),
                ],
                [*batch.schema.names[:-1], "sequence_id", "offset"],
            )

    within = F.row_number().over(Window.partitionBy("length", "__task").orderBy("__row")) - 1
    numbered = written.withColumn("__number", within)
    before = F.sum("n").over(Window.partitionBy("length").orderBy("__task")) - F.col("n")
    # A row per task and length grows with the table, so it is not broadcast.
    starts = cells.select(
        F.col("length").alias("__length"), F.col("__task").alias("__by"), before.alias("__before")
    ).hint("merge")
    same = (F.col("length") == F.col("__length")) & (F.col("__task") == F.col("__by"))
    found = numbered.join(starts, same).select(
        *plain.columns, (F.col("__number") + F.col("__before")).alias("__number")
    )
    extra = [T.StructField(x, T.LongType()) for x in ("sequence_id", "offset")]
    return found.mapInArrow(place, T.StructType([*schema, *extra]))


def sequences(packed: DataFrame) -> DataFrame:
    """``sequence_id, ids``: the packed sequences themselves, from rows with ``ids``. A
    sequence is one row of at most the capacity, so no group is larger."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda p: p.ids)).alias("ids"))
