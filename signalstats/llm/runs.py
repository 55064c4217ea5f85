"""Periodic runs: stretches in which the same words come again and again.

Every word of a run of period ``q`` that holds at least ``k`` periods occurs at least
``k`` times in it. So a word that occurs less often in its segment is in no run there,
and splits the segment; the parts are judged anew until nothing splits any more. Few
segments of ordinary text survive, and they alone are scanned for equal words at a lag.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from signalstats.llm.common import Words, joined, pieces, powers, spans

#: Blocks that are compared at a time.
_BLOCKS = 1 << 20
_RUN = "array<struct<start:bigint,length:bigint,period:bigint>>"


def segments(hashes: np.ndarray, first: np.ndarray, times: int, shortest: int) -> tuple[np.ndarray, np.ndarray]:
    """Begins and ends of the word ranges of at least ``shortest`` words, inside one text
    each, in which every word occurs at least ``times`` times."""
    begin, end = first[:-1], first[1:]
    stable = [(begin[:0], end[:0])]
    while True:
        long = end - begin >= shortest
        begin, end = begin[long], end[long]
        if not len(begin):
            found = (np.concatenate(x) for x in zip(*stable, strict=True))
            begin, end = found
            order = np.argsort(begin)
            return begin[order], end[order]
        owner, at = spans(end - begin, begin)
        key = joined(owner.astype(np.uint64), hashes[at])
        order = np.argsort(key)
        ordered = key[order]
        new = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1]))
        size = np.diff(np.append(new, len(key)))
        rare = np.empty(len(key), bool)
        rare[order] = np.repeat(size < times, size)
        split = np.zeros(len(begin), bool)
        split[owner[rare]] = True
        stable.append((begin[~split], end[~split]))
        live = split[owner] & ~rare
        at, owner = at[live], owner[live]
        if not len(at):
            begin = end = at
            continue
        new = np.append(True, (np.diff(at) != 1) | (np.diff(owner) != 0))
        begin, end = at[new], at[np.append(new[1:], True)] + 1


def _repeated_blocks(hashes: np.ndarray, begin: np.ndarray, end: np.ndarray, times: int) -> Iterator[tuple]:
    """``(segment, lag, places)`` where the words of a segment, cut into blocks of ``lag``
    words, show ``times - 1`` equal blocks in a row: any run of that period has such.

    A segment of ``m`` words has ``m / lag`` blocks, ``m log m`` over all lags.
    """
    ahead, back = powers(len(hashes) + 1)
    sums = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(hashes * ahead[: len(hashes)], out=sums[1:])
    # A lag per row: (segment, lag), as many blocks as can begin a row of equal ones.
    segment, lag = spans((end - begin) // times, np.ones(len(begin), np.int64))
    count = (end - begin)[segment] // lag - (times - 2)
    edges = np.append(0, np.cumsum(count))
    row = 0
    while row < len(lag):
        stop = max(int(np.searchsorted(edges, edges[row] + _BLOCKS, side="right")) - 1, row + 1)
        which, block = spans(count[row:stop], np.zeros(stop - row, np.int64))
        which += row
        q = lag[which]
        at = begin[segment[which]] + block * q
        same = np.ones(len(at), bool)
        for i in range(times - 2):
            left = at[same] + i * q[same]
            middle, right = left + q[same], left + 2 * q[same]
            equal = (sums[middle] - sums[left]) * back[left] == (sums[right] - sums[middle]) * back[middle]
            same[np.flatnonzero(same)[~equal]] = False
        which, at = which[same], at[same]
        change = np.append(np.flatnonzero(np.diff(which, prepend=-1)), len(which))
        for low, high in zip(change[:-1], change[1:], strict=True):
            yield int(segment[which[low]]), int(lag[which[low]]), at[low:high]
        row = stop


def find_runs(hashes: np.ndarray, first: np.ndarray, times: int = 4, shortest: int = 6) -> np.ndarray:
    """Rows ``(start, end, period)`` of all runs, by start and period; words and texts as in
    :class:`~signalstats.llm.common.Words`, equal hashes are equal words."""
    begin, end = segments(hashes, first, times, shortest)
    found: list[tuple[int, int, int]] = []
    known: set[tuple[int, int]] = set()
    current, own = -1, []
    for segment, lag, places in _repeated_blocks(hashes, begin, end, times):
        if segment != current:
            current, own = segment, []
        # Inside a run of a period that divides this lag, the lag shows nothing new.
        divides = sorted((s, e) for s, e, q in own if lag % q == 0)
        if divides:
            starts, ends = np.array(divides).T
            reach = np.append(-1, np.maximum.accumulate(ends))[np.searchsorted(starts, places, side="right")]
            places = places[reach < places + (times - 1) * lag]
        if not len(places):
            continue
        low, high = int(begin[segment]), int(end[segment])
        equal = np.zeros(high - low - lag + 2, bool)
        equal[1:-1] = hashes[low : high - lag] == hashes[low + lag : high]
        change = np.flatnonzero(equal[1:] != equal[:-1])
        start, stop = change[::2] + low, change[1::2] + low + lag
        enough = stop - start >= max(shortest, times * lag)
        for s, e in zip(start[enough].tolist(), stop[enough].tolist(), strict=True):
            if (s, e) not in known:  # else a shorter period explains the same stretch
                known.add((s, e))
                own.append((s, e, lag))
                found.append((s, e, lag))
    return np.array(sorted(found, key=lambda r: (r[0], r[2])), np.int64).reshape(-1, 3)


def periodic_runs(docs: DataFrame, times: int = 4, min_words: int = 6) -> DataFrame:
    """One row per row of ``docs`` (``doc_id, text``): ``doc_id, text, n_words, runs``.

    A run is a stretch of consecutive words (between blanks, ``[^\\x20\\x09-\\x0D]+``) with
    smallest period ``q`` - words ``q`` apart are identical - of at least ``min_words``
    words and ``times`` periods, which no neighbouring word extends keeping that period.
    ``runs`` lists ``start`` (word number from 0), ``length`` and ``period`` by start, then
    period; runs may overlap and lie in one another. ``text`` holds the words, joined by
    one space, without those that some run holds after its first ``period`` words.

    Null or empty text and blanks alone: no words, empty text, no runs. Repeated rows and
    shared or missing ids are rows like others; other columns are not used; an empty table
    gives an empty one. ``times`` and ``min_words`` are 3 and 1 at least.

    Rows do not meet, so nothing is shuffled. A text is scanned whole, in memory that
    grows with it alone: recursive splitting sorts the words of the segments that the last
    round has split, and the lag scan looks at ``m log m`` blocks of a segment of ``m``
    words. Words are compared by 64-bit hashes.
    """
    if times < 3 or min_words < 1:
        raise ValueError("a run needs at least three periods and a word")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "text"):
            words = Words(piece.column("text"))
            n = piece.num_rows
            runs = find_runs(words.hashes(), words.first, times, min_words)
            start, end, period = runs.T
            edges = np.zeros(len(words) + 1, np.int64)
            np.add.at(edges, start + period, 1)
            np.add.at(edges, end, -1)
            lost = np.cumsum(edges[:-1]) > 0
            texts = []
            for i in range(n):
                own = words.raw[words.offsets[i] : words.offsets[i + 1]].tobytes().split()
                gone = lost[words.first[i] : words.first[i + 1]]
                texts.append(b" ".join(compress(own, ~gone) if gone.any() else own))
            owner = np.searchsorted(words.first, start, side="right") - 1
            offsets = np.append(0, np.cumsum(np.bincount(owner, minlength=n))).astype(np.int32)
            listed = pa.StructArray.from_arrays(
                [start - words.first[owner], end - start, period], ["start", "length", "period"]
            )
            yield pa.RecordBatch.from_arrays(
                [
                    piece.column("doc_id"),
                    pa.array(texts, pa.binary()).cast(pa.string()),
                    pa.array(words.counts, pa.int64()),
                    pa.ListArray.from_arrays(offsets, listed),
                ],
                ["doc_id", "text", "n_words", "runs"],
            )

    rows = docs.selectExpr("cast(doc_id AS bigint) AS doc_id", "text")
    return rows.mapInArrow(scan, f"doc_id bigint, text string, n_words bigint, runs {_RUN}")
