"""Substring dedup: word windows that occur more than once are removed everywhere."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from signalstats.llm.common import Words, joined, leftmost_smallest, mix, ngrams, pieces, signed, spans, windows
from signalstats.llm.quality import covered

#: Rows that a task compares among themselves before it sends what is left to others.
_CHUNK = 500_000
#: Bits of a reference that count the windows of a run; the others are the first word's number.
_RUN_BITS = 16
#: What a row stands for: an occurrence not met again so far, a mark that the task
#: has met its key more often, or a finding that needs no further comparison.
_OPEN, _MET, _SETTLED = 0, 1, 2
_RUN = 60


def _groups(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which keys are the first of their value, and which values occur more than once."""
    order = np.argsort(keys, kind="stable")
    new = np.append(True, keys[order][1:] != keys[order][:-1])[: len(keys)]
    first, many = np.zeros(len(keys), bool), np.zeros(len(keys), bool)
    first[order[new]] = True
    group = np.cumsum(new) - 1
    many[order] = np.bincount(group, minlength=1)[group] > 1 if len(keys) else many
    return first, many


def _first_level(length: int, base: int):
    """Rows ``(key, a, b, ref, kind)``: each window of ``length`` words is represented by
    the smallest hash of ``base`` words in it; ``ref`` holds the run of windows that
    share it. Equal windows have equal representatives, so a window whose
    representative occurs once occurs once."""

    def level(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for piece in pieces(batches, "text"):
            words = Words(piece.column("text"))
            text, at = windows(words.first, length)
            if not len(at):
                continue
            hashes = ngrams(words.hashes(), base)
            anchor = leftmost_smallest(hashes, length - base + 1)[at]
            new = np.flatnonzero(np.diff(anchor, prepend=-1))
            run = np.diff(np.append(new, len(at)))
            own = text[new]
            a, b = (piece.column(c).to_numpy() for c in "ab")
            held.append((hashes[anchor[new]], a[own], b[own], (at[new] - words.first[own]) << _RUN_BITS | run))
            size += len(new)
            if size >= _CHUNK:
                yield _compared(held)
                held, size = [], 0
        if held:
            yield _compared(held)

    return level


def _compared(held: list[tuple]) -> pa.RecordBatch:
    key, a, b, ref = (np.concatenate(x) for x in zip(*held, strict=True))
    first, many = _groups(key)
    met = first & many
    nothing = np.zeros(int(met.sum()), np.int64)
    # Findings carry a key of their own, to spread them.
    own = mix(a.view(np.uint64) ^ mix(ref.view(np.uint64)))
    return pa.RecordBatch.from_arrays(
        [
            signed(np.concatenate([np.where(many, own, key), key[met]])),
            *(np.concatenate([x, nothing]) for x in (a, b, ref)),
            np.concatenate([np.where(many, _SETTLED, _OPEN), nothing + _MET]).astype(np.int32),
        ],
        ["key", "a", "b", "ref", "kind"],
    )


def _second_level(length: int, base: int):
    """Rows ``(key, a, b, ref, kind, mask, hashes)``: runs of windows of ``length`` words
    that the first level left, with their full hashes. Of a text that has copies all is
    known; its windows only count for other texts."""

    def level(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for piece in pieces(_with_list(batches, "refs"), "text"):
            words = Words(piece.column("text"))
            refs = piece.column("refs")
            owner = np.repeat(np.arange(piece.num_rows), refs.value_lengths().to_numpy())
            ref = refs.flatten().to_numpy()
            which, at = spans(ref & ((1 << _RUN_BITS) - 1), words.first[owner] + (ref >> _RUN_BITS))
            order = np.argsort(at)
            at, text = at[order], owner[which][order]
            hashed = words.hashes()
            hashes = ngrams(hashed, base)
            key = hashes[leftmost_smallest(hashes, length - base + 1)[at]]
            a, b, copied = (piece.column(c).to_numpy(zero_copy_only=False) for c in ("a", "b", "copied"))
            held.append((key, ngrams(hashed, length)[at], a[text], b[text], at - words.first[text], copied[text]))
            size += len(at)
            if size >= _CHUNK:
                yield from _runs(held)
                held, size = [], 0
        if held:
            yield from _runs(held)

    return level


def _runs(held: list[tuple]) -> Iterator[pa.RecordBatch]:
    key, window, a, b, ref, copied = (np.concatenate(x) for x in zip(*held, strict=True))
    first, many = _groups(joined(key, window))
    known = first & (many | copied)
    for chosen, kind in ((many & ~copied, _SETTLED), (known, _MET), (~many & ~copied, _OPEN)):
        k, h, i, j, r = (x[chosen] for x in (key, window, a, b, ref))
        if not len(k):
            continue
        other = (i[1:] != i[:-1]) | (j[1:] != j[:-1]) | (r[1:] != r[:-1] + 1)
        new = np.append(True, other | ((k[1:] != k[:-1]) & (kind != _SETTLED)))
        begin = np.flatnonzero(new)
        within = np.arange(len(k)) - np.repeat(begin, np.diff(np.append(begin, len(k))))
        begin = np.flatnonzero(within % _RUN == 0)
        run = np.diff(np.append(begin, len(k)))
        own = mix(i[begin].view(np.uint64) ^ mix(r[begin].view(np.uint64))) if kind == _SETTLED else k[begin]
        offsets = np.append(0, np.cumsum(run if kind != _SETTLED else np.zeros(len(run)))).astype(np.int32)
        yield pa.RecordBatch.from_arrays(
            [
                signed(own),
                i[begin],
                j[begin],
                r[begin],
                np.full(len(begin), kind, np.int32),
                (1 << run) - 1 if kind == _SETTLED else np.zeros(len(begin), np.int64),
                pa.ListArray.from_arrays(offsets, pa.array(signed(h if kind != _SETTLED else h[:0]))),
            ],
            ["key", "a", "b", "ref", "kind", "mask", "hashes"],
        )


def _with_list(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield batch.filter(batch.column(column).is_valid())


def _removed(length: int):
    """Rows ``(doc_id, text, n_words, n_removed)`` without the windows that ``found`` lists; a
    text that has copies has no other windows."""

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "text"):
            words = Words(piece.column("text"))
            found = piece.column("found")
            owner = np.repeat(np.arange(piece.num_rows), found.value_lengths().fill_null(0).to_numpy())
            ref, mask = (found.flatten().field(i).to_numpy() for i in (0, 1))
            begin = words.first[owner] + ref
            starts = [begin[mask >> bit & 1 == 1] + bit for bit in range(_RUN)]
            lost = covered(np.concatenate(starts), length, len(words))
            copied = piece.column("copied").fill_null(False).to_numpy(zero_copy_only=False)
            lost |= np.repeat(copied & (words.counts >= length), words.counts)
            texts = []
            for i in range(piece.num_rows):
                own = words.raw[words.offsets[i] : words.offsets[i + 1]].tobytes().split()
                gone = lost[words.first[i] : words.first[i + 1]]
                texts.append(b" ".join(compress(own, ~gone) if gone.any() else own))
            n_lost = np.add.reduceat(np.append(lost, 0), words.first[:-1]) * (words.counts > 0)
            yield pa.RecordBatch.from_arrays(
                [
                    piece.column("doc_id"),
                    pa.array(texts, pa.binary()).cast(pa.string()),
                    pa.array(words.counts, pa.int64()),
                    pa.array(n_lost, pa.int64()),
                ],
                ["doc_id", "text", "n_words", "n_removed"],
            )

    return remove


def _met_again(by: list[str]) -> Column:
    """Occurrences of the key that the tasks together have met; at least two if it repeats."""
    weight = F.when(F.col("kind") == _OPEN, 1).when(F.col("kind") == _MET, 2).otherwise(0)
    return F.sum(weight).over(Window.partitionBy(*by))


def substring_dedup(docs: DataFrame, min_words: int = 35) -> DataFrame:
    """One row per row of ``docs`` (``doc_id, text``): ``doc_id, text, n_words, n_removed``.

    A window is ``min_words`` consecutive words of one document. Every word in a
    window whose words also start anywhere else, in the same document too, is
    removed; windows are judged on the input. ``text`` holds the words that are left,
    joined by one space.

    Null or empty text: no words, empty text. A text that occurs in several rows loses all
    windows, as each is the other's repeat; so do repeated rows. ``doc_id`` is passed on and
    not looked at: it may be missing or shared. Other columns are not used.

    Level-wise doubling: the first level compares windows of half the length and goes
    on with those alone that repeat; they are extended to twice that length, here
    ``min_words``, where the search ends: longer repeats consist of these. At the
    first level a window of ``min_words`` is represented by the smallest hash of half
    its length inside it, so one row in about ten words is shuffled instead of each.

    Texts are told apart by 128 bits of hash, and copies of one text are one text from the
    second level on, so time grows in line with their number. A task compares its own rows
    first and sends one row per key for what it has met more than once, so what repeats
    arrives once per task, however many copies there are. At the second level windows meet
    by their whole hash, so those over the edge of a frequent passage, each with words of its
    own, are spread over all tasks. The text is shuffled once, by its hash.
    """
    if not 2 <= min_words < 2**_RUN_BITS:
        raise ValueError(f"a window has 2 to {2**_RUN_BITS - 1} words")
    base = (min_words + 1) // 2
    plain = F.coalesce("text", F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64(plain).alias("a"),
        F.xxhash64(F.lit(7), plain).alias("b"),
        "text",
    )
    copied = rows.groupBy("a", "b").count().where("count > 1").select("a", "b", F.lit(True).alias("copied"))

    candidates = (
        rows.select("a", "b", "text")
        .mapInArrow(_first_level(min_words, base), "key bigint, a bigint, b bigint, ref bigint, kind int")
        .repartition("key")
        .withColumn("n", _met_again(["key"]))
        .where((F.col("kind") == _SETTLED) | ((F.col("kind") == _OPEN) & (F.col("n") > 1)))
        .groupBy("a", "b")
        .agg(F.collect_set("ref").alias("refs"))
        .join(copied, ["a", "b"], "left")
        .withColumn("copied", F.coalesce("copied", F.lit(False)))
    )
    found = (
        rows.join(candidates, ["a", "b"], "left")
        # A task that runs again must compare the same rows with each other.
        .sortWithinPartitions("a", "b")
        # With the id, so that this shuffle of the texts serves the last join too.
        .select("doc_id", "a", "b", "text", "refs", "copied")
        .mapInArrow(
            _second_level(min_words, base),
            "key bigint, a bigint, b bigint, ref bigint, kind int, mask bigint, hashes array<bigint>",
        )
        # Equal windows have the key and the whole hash in common, so a frequent key is split.
        .select("key", "a", "b", "ref", "kind", "mask", F.posexplode_outer("hashes").alias("offset", "hash"))
        .repartition("key", "hash")
        .withColumn("n", _met_again(["key", "hash"]))
        .where((F.col("kind") == _SETTLED) | ((F.col("kind") == _OPEN) & (F.col("n") > 1)))
        .select(
            "a",
            "b",
            (F.col("ref") + F.coalesce("offset", F.lit(0))).alias("ref"),
            F.when(F.col("kind") == _SETTLED, F.col("mask")).otherwise(1).alias("mask"),
        )
        .groupBy("a", "b")
        .agg(F.collect_list(F.struct("ref", "mask")).alias("found"))
    )
    known = found.join(copied, ["a", "b"], "full")
    return rows.join(known, ["a", "b"], "left").select("doc_id", "text", "found", "copied").mapInArrow(
        _removed(min_words), "doc_id bigint, text string, n_words bigint, n_removed bigint"
    )
